"""Route profiles: distances along lines, resampling at equal steps, ascent and descent."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo


def default_segment_ids(features: DataFrame) -> DataFrame:
    """features (ord from 0 over the whole file, route_id, segment_id?) with missing ids filled in."""
    return features.withColumn("segment_id", F.coalesce("segment_id", F.format_string("%s_L%03d", F.col("route_id"), (F.col("ord") + 1).cast("int"))))


def with_distance(vertices: DataFrame, *line: str, order: str = "ord") -> DataFrame:
    """vertices (lat, lon) with length (from the one before) and distance_m (from the start)."""
    w = Window.partitionBy(*line).orderBy(order)
    step = geo.haversine_m(F.lag("lat").over(w), F.lag("lon").over(w), F.col("lat"), F.col("lon"))
    return vertices.withColumn("length", F.coalesce(step, F.lit(0.0))).withColumn("distance_m", F.sum("length").over(w))


def resampled(vertices: DataFrame, interval: float, *line: str, order: str = "ord") -> DataFrame:
    """A row at 0, at every multiple of interval, and at the end where that lies beyond the last one.

    Every stretch between vertices explodes its own multiples (k * interval), so a long line is spread
    over tasks; coordinates are linear between the vertices.
    """
    w = Window.partitionBy(*line).orderBy(order)
    rows = vertices.withColumn("_to", F.lead("distance_m").over(w)).withColumn("_lat2", F.lead("lat").over(w)).withColumn("_lon2", F.lead("lon").over(w))
    stretch = rows.where(F.col("_to").isNotNull() & (F.col("_to") > F.col("distance_m")))
    low, high = F.floor(F.col("distance_m") / interval) + 1, F.floor((F.col("_to") + 1e-9) / interval)
    inner = stretch.where(low <= high).withColumn("_k", F.explode(F.sequence(low, high))).withColumn("_d", F.col("_k") * F.lit(float(interval)))
    share = (F.col("_d") - F.col("distance_m")) / (F.col("_to") - F.col("distance_m"))
    at = lambda c: F.col(c) + (F.col(f"_{c}2") - F.col(c)) * share
    inner = inner.select(*line, F.col("_d").alias("distance_m"), at("lat").alias("lat"), at("lon").alias("lon"))
    last = rows.where(F.col("_to").isNull() & (F.pmod(F.col("distance_m") + 1e-9, F.lit(float(interval))) > 2e-9)).select(*line, "distance_m", "lat", "lon")
    start = rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").select(*line, F.lit(0.0).alias("distance_m"), "lat", "lon")
    return start.unionByName(inner).unionByName(last.where("distance_m > 0"))


def segments(samples: DataFrame, *line: str, order: str = "distance_m") -> DataFrame:
    """Per line of samples (distance_m, elevation_m): length, least and greatest height, ascent, descent, gaps.

    Only neighbours that both have a height count; otherwise their distance is missing.
    """
    w = Window.partitionBy(*line).orderBy(order)
    rows = samples.withColumn("_d", F.col("distance_m") - F.lag("distance_m").over(w)).withColumn("_e", F.col("elevation_m") - F.lag("elevation_m").over(w))
    return rows.groupBy(*line).agg(
        F.max("distance_m").alias("distance_m"),
        F.min("elevation_m").alias("elevation_min_m"),
        F.max("elevation_m").alias("elevation_max_m"),
        F.coalesce(F.sum(F.when(F.col("_e") > 0, F.col("_e"))), F.lit(0)).alias("ascent_m"),
        F.coalesce(F.sum(F.when(F.col("_e") < 0, -F.col("_e"))), F.lit(0)).alias("descent_m"),
        F.coalesce(F.sum(F.when(F.col("_e").isNull(), F.col("_d"))), F.lit(0)).alias("missing_distance_m"),
    )


def document(segments_: DataFrame, samples: DataFrame) -> DataFrame:
    """One row per route: its segments with their samples, nested as the profile file has them."""
    own = samples.groupBy("route_id", "segment_id").agg(F.sort_array(F.collect_list(F.struct("distance_m", "lon", "lat", "elevation_m", "layer", "source_code"))).alias("samples"))
    both = segments_.join(own, ["route_id", "segment_id"], "left")
    nested = F.struct("ord", "segment_id", "distance_m", "elevation_min_m", "elevation_max_m", "ascent_m", "descent_m", "missing_distance_m", "samples")
    return both.groupBy("route_id").agg(F.transform(F.sort_array(F.collect_list(nested)), lambda s: s.dropFields("ord")).alias("segments"))
