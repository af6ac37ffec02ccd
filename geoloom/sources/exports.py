"""Reports and GeoJSON out: JSON lines with sorted keys, feature collections, reports.

Features are written by tasks as a table of JSON texts; only a report of fixed size, or a collection that is
asked for as one document, comes to one file.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .records import point_features


def sorted_json(rows: DataFrame, *keys: str) -> DataFrame:
    """value: a compact JSON text of each row with its keys in order; nulls are written."""
    names = sorted(keys or rows.columns)
    return rows.select(F.to_json(F.struct(*names), {"ignoreNullFields": "false"}).alias("value"))


def write_json_lines(rows: DataFrame, path: str, *keys: str) -> None:
    sorted_json(rows, *keys).write.text(path)


def distinct_points(rows: DataFrame, key: str, order: str = "ord") -> DataFrame:
    """The first row (by order) of each key; rows without a key go."""
    some = rows.where(F.coalesce(F.col(key), F.lit("")) != "")
    return some.groupBy(key).agg(F.min_by(F.struct("*"), order).alias("_r")).select("_r.*")


def map_points(rows: DataFrame, *properties: str) -> DataFrame:
    """ord and feature of resolved rows (ord, status, place_id, lat, lon, ...), one for each place."""
    return point_features(distinct_points(rows.where(F.col("status") == "resolved"), "place_id"), *properties)


def line_features(lines: DataFrame, *properties: str) -> DataFrame:
    """GeoJSON line features of rows (ord, coordinates)."""
    shape = F.struct(F.lit("LineString").alias("type"), "coordinates")
    return lines.select("ord", F.to_json(F.struct(F.lit("Feature").alias("type"), shape.alias("geometry"), F.struct(*properties).alias("properties")), {"ignoreNullFields": "false"}).alias("feature"))


def collection(features: DataFrame, order: Column | str = "ord") -> DataFrame:
    """One row: a FeatureCollection text.  For exports that a map reads whole; larger ones stay tables of features."""
    own = features.agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(F.col(order) if isinstance(order, str) else order, "feature"))), lambda s: s.feature), ",").alias("body"))
    return own.select(F.concat(F.lit('{"type":"FeatureCollection","features":['), F.coalesce("body", F.lit("")), F.lit("]}")).alias("value"))


def write_report(report: DataFrame, path: str) -> dict:
    """Writes the one row of a report as a JSON document with sorted keys, in place of an earlier one, and returns it."""
    row = report.first().asDict(recursive=True)
    with open(f"{path}.new", "w", encoding="utf-8") as f:
        json.dump(row, f, ensure_ascii=False, sort_keys=True, indent=2, default=str)
        f.write("\n")
    os.replace(f"{path}.new", path)
    return row


def report_text(row: dict, title: str) -> str:
    """A report as a Markdown table."""
    lines = [f"# {title}", "", "| | |", "|---|---|", *[f"| {k} | {v} |" for k, v in sorted(row.items())]]
    return "\n".join(lines) + "\n"
