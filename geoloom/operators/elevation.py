"""Elevation at points: cell lookup, fall-back from the fine to the coarse layer, checks.

elev_cell (layer, tile_x, tile_y, px, py, meters, source_code); grid (layer, origin_lat, origin_lon, step_lat, step_lon).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geo

FINE, COARSE = 5, 10
KEYS = ("tile_x", "tile_y", "px", "py")


def address(lat: Column, lon: Column, origin_lat, origin_lon, step_lat, step_lon) -> dict[str, Column]:
    """Tile and place of a point in a layer's grid; null where a global cell is negative."""
    y, x = geo.global_cell(lat, F.lit(origin_lat), F.lit(step_lat), True), geo.global_cell(lon, F.lit(origin_lon), F.lit(step_lon), False)
    ok = (x >= 0) & (y >= 0)
    return {"tile_x": F.when(ok, geo.tile_of(x)), "tile_y": F.when(ok, geo.tile_of(y)), "px": F.when(ok, geo.in_tile(x)), "py": F.when(ok, geo.in_tile(y))}


def in_layer(points: DataFrame, cells: DataFrame, grid: dict, layer: int, name: str) -> DataFrame:
    """points (lat, lon, ...) with a struct ``name`` of the layer's cell, null where there is none.

    An equi-join on the computed cell: the points shuffle once, and only cells of one layer are read.
    """
    at = {f"_{k}": v for k, v in address(F.col("lat"), F.col("lon"), **grid).items()}
    own = cells.where((F.col("layer") == layer) & F.col("meters").isNotNull()).select(*[F.col(k).cast("long").alias(f"_{k}") for k in KEYS], F.struct(F.col("meters").cast("float").alias("elevation_m"), F.col("layer").cast("int").alias("layer"), F.col("source_code").cast("int").alias("source_code")).alias(name))
    return points.withColumns({k: v.cast("long") for k, v in at.items()}).join(own, list(at), "left").drop(*at)


def with_fallback(points: DataFrame, cells: DataFrame, fine: dict, coarse: dict) -> DataFrame:
    """points with elevation_m, layer, source_code of the fine layer, or else of the coarse one."""
    both = in_layer(in_layer(points, cells, fine, FINE, "_f"), cells, coarse, COARSE, "_c")
    pick = F.coalesce("_f", "_c")
    return both.select(*points.columns, *[pick[c].alias(c) for c in ("elevation_m", "layer", "source_code")])


def golden_check(found: DataFrame, fine_tolerance: float = 10.0, coarse_tolerance: float = 20.0) -> DataFrame:
    """found (expected_m, expected_layer, elevation_m) with diff_m and ok, by the expected layer's tolerance."""
    limit = F.when(F.col("expected_layer") == "dem5", fine_tolerance).otherwise(coarse_tolerance)
    diff = F.abs(F.col("elevation_m") - F.col("expected_m"))
    return found.withColumn("diff_m", diff).withColumn("ok", F.coalesce(diff <= limit, F.lit(False)))


def raster_places(rasters: DataFrame, cell: float) -> DataFrame:
    """Rasters by the places (_la, _lo) of ``cell`` degrees that their bounds touch, without those that can't come first.

    Of rasters with equal bounds the first stands for all, and where a raster holds a whole place, none after it counts.
    """
    at = lambda c: F.floor(F.col(c) / cell)
    one = rasters.groupBy("min_lat", "max_lat", "min_lon", "max_lon").agg(F.min_by(F.struct("*"), "ordinal").alias("_r")).select("_r.*")
    by = one.withColumn("_la", F.explode(F.sequence(at("min_lat"), at("max_lat")))).withColumn("_lo", F.explode(F.sequence(at("min_lon"), at("max_lon"))))
    whole = (at("min_lat") < F.col("_la")) & (F.col("_la") < at("max_lat")) & (at("min_lon") < F.col("_lo")) & (F.col("_lo") < at("max_lon"))
    least = by.groupBy("_la", "_lo").agg(F.min(F.when(whole, F.col("ordinal"))).alias("_least"))
    return by.join(least, ["_la", "_lo"]).where(F.col("_least").isNull() | (F.col("ordinal") <= F.col("_least"))).drop("_least")


def first_raster(points: DataFrame, rasters: DataFrame, cell: float = 0.125) -> DataFrame:
    """The first raster (by ordinal) whose bounds hold each point, with the nearest cell: an equi-join on places."""
    at = lambda c: F.floor(F.col(c) / cell)
    met = points.withColumn("_la", at("lat")).withColumn("_lo", at("lon")).join(raster_places(rasters, cell), ["_la", "_lo"])
    met = met.where(geo.within(F.col("lat"), F.col("lon"), F.col("min_lat"), F.col("max_lat"), F.col("min_lon"), F.col("max_lon")))
    first = met.withColumn("_rn", F.row_number().over(Window.partitionBy("point_id").orderBy("ordinal"))).where("_rn = 1")
    lat_step, lon_step = (F.col("max_lat") - F.col("min_lat")) / F.col("height"), (F.col("max_lon") - F.col("min_lon")) / F.col("width")
    return first.withColumn("row", geo.raster_row(F.col("lat"), F.col("max_lat"), lat_step, F.col("height"))).withColumn("col", geo.raster_col(F.col("lon"), F.col("min_lon"), lon_step, F.col("width"))).drop("_la", "_lo", "_rn")


def in_order(found: DataFrame, order: str = "ord") -> DataFrame:
    """Looked-up points in the order of their input."""
    return found.orderBy(order)


#: Differences are first counted in bins of this width.
BIN = 1.0


def difference_stats(pairs: DataFrame) -> DataFrame:
    """Of pairs (ord, a, b): count, median sorted[n/2], p90 sorted[min(int(0.9 n), n-1)], greatest and its ord.

    Positions are found in two steps: counts of bins (a small table) give the two bins that hold them, and only the distinct
    differences of these are ranked.
    """
    rows = pairs.select("ord", F.abs(F.col("a") - F.col("b")).alias("d")).where("d IS NOT NULL").withColumn("bin", F.floor(F.col("d") / BIN))
    total = rows.agg(F.count("*").alias("n"), F.max("d").alias("worst"), F.max_by(-F.col("ord"), F.struct(F.col("d"), -F.col("ord"))).alias("worst_ord"))
    size = F.broadcast(total.select(F.col("n").alias("t")))  # one row
    bins = rows.groupBy("bin").agg(F.count("*").alias("m")).withColumn("upto", F.sum("m").over(Window.orderBy("bin")))
    places = F.explode(F.array(F.struct(F.lit("median").alias("what"), F.floor(F.col("t") / 2).alias("k")), F.struct(F.lit("p90").alias("what"), F.least(F.floor(F.col("t") * F.lit(0.9)), F.col("t") - 1).alias("k"))))
    wanted = bins.join(size.where("t > 0").select(places.alias("w")), (F.col("upto") > F.col("w.k")) & (F.col("upto") - F.col("m") <= F.col("w.k")))
    wanted = wanted.select("bin", "w.what", (F.col("w.k") - F.col("upto") + F.col("m")).alias("k"))  # two rows
    near = rows.join(F.broadcast(wanted), "bin").groupBy("what", "k", "d").agg(F.count("*").alias("m"))
    ranked = near.withColumn("upto", F.sum("m").over(Window.partitionBy("what").orderBy("d"))).where(F.col("upto") > F.col("k"))
    of = lambda what: F.min(F.when(F.col("what") == what, F.col("d"))).alias(what)
    return total.join(F.broadcast(ranked.agg(of("median"), of("p90")))).select("n", "median", "p90", "worst", (-F.col("worst_ord")).alias("worst_ord"))


def agreement(pairs: DataFrame, tolerance: float) -> DataFrame:
    """Of sampled points (ord, inside, fine, coarse): how the fine raster's heights agree with the coarse one's.

    inside says whether the fine raster covers the point; null heights are no data.
    """
    both = F.col("fine").isNotNull() & F.col("coarse").isNotNull()
    n = lambda c: F.count_if(F.col("inside") & c)
    return pairs.agg(
        F.count_if(~F.col("inside")).alias("outside"), n(both).alias("comparable"), n(both & (F.abs(F.col("fine") - F.col("coarse")) <= tolerance)).alias("agree"),
        n(F.col("fine").isNull() & F.col("coarse").isNotNull()).alias("gaps"), n(F.col("fine").isNotNull() & F.col("coarse").isNull()).alias("strays"), n(F.col("fine").isNull() & F.col("coarse").isNull()).alias("sea"),
    )


#: The least share of land points that agree, and the strays taken for coast.
LAND_SHARE, COAST = 0.6, 10


def cross_validation(pairs: DataFrame, tolerance: float = 10.0, sea_share: float = 0.9) -> DataFrame:
    """agreement and difference_stats in one row, with rates and the names of the rules that fail."""
    counts = agreement(pairs, tolerance)
    stats = difference_stats(pairs.where("inside AND fine IS NOT NULL AND coarse IS NOT NULL").select("ord", F.col("fine").alias("a"), F.col("coarse").alias("b")))
    row = counts.join(F.broadcast(stats.select("median", "p90", "worst", "worst_ord")))  # one row each
    land, sea = F.coalesce(F.try_divide("agree", "comparable"), F.lit(1.0)), F.coalesce(F.try_divide("sea", F.col("sea")), F.lit(1.0))
    rules = {"no_land": F.col("comparable") == 0, "median": F.coalesce(F.col("median") > tolerance, F.lit(False)), "land_share": land < LAND_SHARE, "sea_share": sea < sea_share, "strays": F.col("strays") >= COAST}
    failed = F.filter(F.array(*[F.when(c, F.lit(name)) for name, c in rules.items()]), lambda x: x.isNotNull())
    return row.withColumn("land_share", F.round(land, 9)).withColumn("failed", F.array_join(failed, ","))


def golden_gate(checked: DataFrame, covered: DataFrame) -> DataFrame:
    """One row: golden points, failures, layers (layer, valid) without a valid cell, and whether all is well."""
    points = checked.agg(F.count("*").alias("points"), F.count_if(~F.col("ok")).alias("failures"))
    empty = covered.agg(F.count_if(F.col("valid") == 0).alias("empty_layers"), F.count("*").alias("layers"))
    return points.join(F.broadcast(empty)).withColumn("passed", (F.col("failures") == 0) & (F.col("empty_layers") == 0) & (F.col("layers") > 0))  # one row each


def both_layers(points: DataFrame, cells: DataFrame, fine: dict, coarse: dict) -> DataFrame:
    """points with the height of each layer, without a fall-back."""
    both = in_layer(in_layer(points, cells, fine, FINE, "_f"), cells, coarse, COARSE, "_c")
    return both.select(*points.columns, F.col("_f.elevation_m").alias("fine_m"), F.col("_c.elevation_m").alias("coarse_m"))


def sample_points(spark: SparkSession, bounds: tuple[float, float, float, float], n: int, seed: int = 42) -> DataFrame:
    """ord, lat, lon of n points in bounds (min_lat, min_lon, max_lat, max_lon) by a 64-bit xorshift; n is a parameter."""
    low_lat, low_lon, high_lat, high_lon = bounds
    mask, state, found = (1 << 64) - 1, seed, []
    for _ in range(2 * n):
        for shift in (13, -7, 17):
            state ^= (state << shift) & mask if shift > 0 else state >> -shift
        found.append(state / float(mask))
    rows = [(i, low_lat + u * (high_lat - low_lat), low_lon + v * (high_lon - low_lon)) for i, (u, v) in enumerate(zip(found[::2], found[1::2]))]
    return spark.createDataFrame(rows, "ord int, lat double, lon double")
