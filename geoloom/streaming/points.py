"""Elevation of a stream of points: a stream-static join, without state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.elevation import with_fallback


def located(points: DataFrame, cells: DataFrame, fine: dict, coarse: dict) -> DataFrame:
    """The streaming form of with_fallback: each micro-batch joins the cells as they are then."""
    return with_fallback(points, cells, fine, coarse)


def start(points: DataFrame, cells: DataFrame, fine: dict, coarse: dict, path: str, checkpoint: str) -> StreamingQuery:
    """Writes located points to Parquet, exactly once, as they arrive."""
    return located(points, cells, fine, coarse).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
