"""Which features a map layer draws, and how: predicates over feature tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: every so many metres a contour line is an index line.
INDEX_M = 100


def index_contours(contours: DataFrame, index: bool = True) -> DataFrame:
    """Contour lines whose elevation_m is a multiple of INDEX_M, or the others."""
    on = F.col("elevation_m") % INDEX_M == 0
    return contours.where(on if index else ~on)


def of_routes(features: DataFrame, *route_ids: str) -> DataFrame:
    return features.where(F.col("route_id") == route_ids[0] if len(route_ids) == 1 else F.col("route_id").isin(*route_ids))


def matched(value: Column, cases: dict[str, str], default: str) -> Column:
    """What the cases give a value; the default for others and for null."""
    out = F.lit(default)
    for k, v in cases.items():
        out = F.when(value == k, v).otherwise(out)
    return out


def label(*names: str) -> Column:
    """The first of some columns that is there, or an empty label."""
    return F.coalesce(*[F.col(n) for n in names], F.lit(""))
