"""Elevation rasters as cell tables: priority merge, fill counts, tiles, statistics.

dem_cell (mesh, source_code, row, col, elev, kind): kind 0 is no data.  A finer source has the greater code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo

#: Kinds of samples by their code.
KINDS = ("nodata", "terrain", "sea", "inland_water", "seabed", "inland_bottom")
LETTERS = ((4, "A"), (3, "B"), (2, "C"))
SIDES = ("min_lat", "max_lat", "min_lon", "max_lon")


def checked_grids(rasters: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """rasters (mesh, source_code, width, height, bounds), failing where sources of a mesh disagree."""
    spread = [F.max(c) - F.min(c) for c in SIDES]
    bad = F.greatest(F.max("width") - F.min("width"), F.max("height") - F.min("height")) > 0
    for s in spread:
        bad = bad | (s > tolerance)
    doubled = F.count("*") > F.countDistinct("source_code")
    good = rasters.groupBy("mesh").agg(F.when(bad, "grid mismatch").when(doubled, "duplicate source").alias("error"))
    return rasters.join(good, "mesh").where(F.coalesce(F.assert_true(F.col("error").isNull(), F.concat(F.col("mesh"), F.lit(": "), F.col("error"))).isNull(), F.lit(True))).drop("error")


def blank_cells(grids: DataFrame) -> DataFrame:
    """A cell without data for every place of grids (mesh, width, height)."""
    at = F.explode(F.sequence(F.lit(0), F.col("width") * F.col("height") - 1))
    return grids.select("mesh", "width", at.alias("_k")).select(
        "mesh", F.floor(F.col("_k") / F.col("width")).cast("int").alias("row"), (F.col("_k") % F.col("width")).cast("int").alias("col"),
        F.lit(0).alias("source_code"), F.lit(None).cast("int").alias("elev"), F.lit(0).alias("kind"),
    )


def merge_priority(cells: DataFrame, grids: DataFrame | None = None) -> DataFrame:
    """One row for each (mesh, row, col): the valid cell of the highest source, or no data.

    With grids (mesh, width, height) every place of a mesh has a row, those too that no source stores; they are added
    before the one aggregation, so there is no join.
    """
    names = ("mesh", "row", "col", "source_code", "elev", "kind")
    if grids is not None:
        cells = cells.select(*names).unionByName(blank_cells(grids).withColumn("elev", F.col("elev").cast(cells.schema["elev"].dataType)))
    valid = F.col("kind") != 0
    pick = F.max_by(F.when(valid, F.struct("elev", "kind", "source_code")), F.when(valid, F.col("source_code")))
    return cells.groupBy("mesh", "row", "col").agg(pick.alias("p")).select(
        "mesh", "row", "col", F.col("p.elev").alias("elev"), F.coalesce("p.kind", F.lit(0)).alias("kind"), F.coalesce("p.source_code", F.lit(0)).alias("source_code")
    )


def mesh_wins(merged: DataFrame) -> DataFrame:
    """Cells that each source won, by mesh and in total (mesh null)."""
    n = lambda code: F.count_if(F.col("source_code") == code).alias
    return merged.rollup("mesh").agg(n(4)("a"), n(3)("b"), n(2)("c"), n(0)("nodata"))


def region_merge(rasters: DataFrame, cells: DataFrame, coarse_grids: DataFrame, coarse: DataFrame, regions: list[str] | None = None) -> DataFrame:
    """Totals of a merge by mesh and overall (mesh null): meshes, a, b, c, nodata, fills, remains and the share of gaps filled.

    rasters (region, mesh, source_code, width, height, bounds); a mesh outside its region, a source given twice and
    sources that disagree on a grid are errors.  A region without a coarse raster has no fills and no remains.
    """
    own = in_regions(rasters, regions)
    strayed = F.concat(F.col("mesh"), F.lit(": not of region "), F.col("region"))
    own = checked_grids(own.where(F.assert_true(F.substring("mesh", 1, 6) == F.col("region"), strayed).isNull()))
    grids = own.groupBy("mesh").agg(*[F.first(c).alias(c) for c in ("width", "height", *SIDES)])
    merged = merge_priority(cells.join(grids.select("mesh"), "mesh", "left_semi"), grids)
    n = lambda code: F.count_if(F.col("source_code") == code).alias
    wins = merged.groupBy("mesh").agg(n(4)("a"), n(3)("b"), n(2)("c"), n(0)("nodata"))
    both = wins.join(coarse_fill(merged, grids, coarse_grids, coarse), "mesh", "left").fillna(0, ["fills", "remains"])
    sums = [F.sum(c).alias(c) for c in ("a", "b", "c", "nodata", "fills", "remains")]
    return both.rollup("mesh").agg(F.count("*").alias("meshes"), *sums).withColumn("filled_pct", F.round(F.coalesce(F.try_divide(100 * F.col("fills"), F.col("fills") + F.col("remains")), F.lit(0.0)), 6))


def in_regions(rasters: DataFrame, regions: list[str] | None = None, meshes: list[str] | None = None, partial_only: bool = False) -> DataFrame:
    """rasters of some regions and meshes, or those that store fewer samples (stored) than their grid has."""
    keep = F.lit(True)
    if regions is not None:
        keep = keep & F.substring("mesh", 1, 6).isin(regions)
    if meshes is not None:
        keep = keep & F.col("mesh").isin(meshes)
    if partial_only:
        keep = keep & (F.col("stored") != F.col("width") * F.col("height"))
    return rasters.where(keep)


def absent_regions(rasters: DataFrame, regions: list[str]) -> DataFrame:
    """Regions asked for that no raster is of."""
    asked = rasters.sparkSession.createDataFrame([(x,) for x in regions], "region string")
    return asked.join(rasters.select(F.substring("mesh", 1, 6).alias("region")).distinct(), "region", "left_anti")


def north_to_south(rasters: DataFrame) -> DataFrame:
    """Regions with their bounds and place, the northernmost first."""
    by = rasters.groupBy("region").agg(F.max("max_lat").alias("max_lat"), F.min("min_lat").alias("min_lat"))
    return by.withColumn("place", F.row_number().over(Window.orderBy(F.col("max_lat").desc(), "region")))  # a row for each region


def source_combinations(merged: DataFrame) -> DataFrame:
    """How many meshes drew on which sources (letters in order, ``-`` for none)."""
    letter = F.coalesce(*[F.when(F.col("source_code") == code, x) for code, x in LETTERS])
    own = merged.groupBy("mesh").agg(F.array_join(F.sort_array(F.collect_set(letter)), "").alias("s"))
    return own.groupBy(F.when(F.col("s") == "", "-").otherwise(F.col("s")).alias("combo")).agg(F.count("*").alias("n"))


def kind_counts(cells: DataFrame, *by: str) -> DataFrame:
    return cells.groupBy(*by).agg(*[F.count_if(F.col("kind") == i).alias(name) for i, name in enumerate(KINDS)])


def coarse_fill(merged: DataFrame, grids: DataFrame, coarse_grids: DataFrame, coarse: DataFrame) -> DataFrame:
    """Per mesh with gaps: cells without data that the coarse raster's terrain covers, and those that remain.

    The centre of each gap is looked up in the raster of its region (the mesh's first six digits): grids (mesh, width,
    height, bounds), coarse_grids (region, width, height, bounds), coarse (region, row, col, elev, kind).  Meshes of a
    region without a coarse raster are left out.
    """
    gaps = merged.where("source_code = 0").select("mesh", "row", "col").join(grids, "mesh")
    step = lambda low, high, n: (F.col(high) - F.col(low)) / F.col(n)
    lat, lon = geo.cell_centre(F.col("row"), F.col("col"), F.col("max_lat"), F.col("min_lon"), step("min_lat", "max_lat", "height"), step("min_lon", "max_lon", "width"))
    centres = gaps.select("mesh", F.substring("mesh", 1, 6).alias("region"), lat.alias("lat"), lon.alias("lon"))
    met = centres.join(coarse_grids, "region")
    inside = geo.within(F.col("lat"), F.col("lon"), F.col("min_lat"), F.col("max_lat"), F.col("min_lon"), F.col("max_lon"))
    row = geo.raster_row(F.col("lat"), F.col("max_lat"), step("min_lat", "max_lat", "height"), F.col("height"))
    col = geo.raster_col(F.col("lon"), F.col("min_lon"), step("min_lon", "max_lon", "width"), F.col("width"))
    placed = met.select("mesh", "region", F.when(inside, row).alias("row"), F.when(inside, col).alias("col"))
    land = coarse.where("kind = 1 AND elev IS NOT NULL").select("region", "row", "col", F.lit(True).alias("land"))
    got = placed.join(land, ["region", "row", "col"], "left")
    return got.groupBy("mesh").agg(F.count("land").alias("fills"), F.count_if(F.col("land").isNull()).alias("remains"))


def sample_at(points: DataFrame, cells: DataFrame) -> DataFrame:
    """points (mesh, row, col, ...) with elev and kind of the stored cell.

    Both are null where nothing is stored; NaN heights are null, unknown kinds are no data.
    """
    kind = F.when(F.col("kind").between(0, 5), F.col("kind")).otherwise(0)
    own = cells.select("mesh", "row", "col", F.when(~F.isnan(F.col("elev").cast("double")), F.col("elev")).alias("elev"), kind.alias("kind"))
    return points.join(own, ["mesh", "row", "col"], "left")


def to_tiles(merged: DataFrame, offset_row: Column, offset_col: Column) -> DataFrame:
    """Valid cells with their tile and their place in it; offsets place a mesh in the layer's grid."""
    y, x = offset_row + F.col("row"), offset_col + F.col("col")
    return merged.where("kind <> 0").select(
        geo.tile_of(x).alias("tile_x"), geo.tile_of(y).alias("tile_y"), geo.in_tile(x).alias("px"), geo.in_tile(y).alias("py"), geo.quantized(F.col("elev")).alias("meters"), "source_code"
    )


def packed_tiles(cells: DataFrame, *keys: str) -> DataFrame:
    """A row for each tile with its cells as a map from place to metres and source."""
    at = F.col("py") * geo.TILE_CELLS + F.col("px")
    return cells.groupBy(*keys, "tile_x", "tile_y").agg(F.map_from_entries(F.collect_list(F.struct(at, F.struct("meters", "source_code")))).alias("cells"), F.count("*").alias("valid"))


def layer_coverage(cells: DataFrame) -> DataFrame:
    """Per layer: tiles, valid and missing cells."""
    tiles = cells.groupBy("layer", "tile_x", "tile_y").agg(F.count("*").alias("n"))
    return tiles.groupBy("layer").agg(F.count("*").alias("tiles"), F.sum("n").alias("valid"), (F.count("*") * 65536 - F.sum("n")).alias("nodata"))


def tile_bytes(tiles: DataFrame, cell_bytes: int = 3) -> DataFrame:
    """Per layer of packed tiles (layer, data): tiles, raw and compressed bytes."""
    return tiles.groupBy("layer").agg(F.count("*").alias("tiles"), (F.count("*") * (geo.TILE_CELLS**2 * cell_bytes)).alias("raw_bytes"), F.sum(F.octet_length("data")).alias("compressed_bytes"))


def layer_sources(cells: DataFrame) -> DataFrame:
    return cells.groupBy("layer", "source_code").agg(F.count("*").alias("n"))


def tile_extent(cells: DataFrame) -> DataFrame:
    return cells.groupBy("layer").agg(*[f(c).alias(f"{n}_{c}") for c in ("tile_x", "tile_y") for n, f in (("min", F.min), ("max", F.max))])


def bounds(rasters: DataFrame) -> DataFrame:
    return rasters.agg(F.min("min_lat").alias("min_lat"), F.max("max_lat").alias("max_lat"), F.min("min_lon").alias("min_lon"), F.max("max_lon").alias("max_lon"))


def shaded(cells: DataFrame) -> DataFrame:
    """Picture colours: terrain in grey by its share of the range, fixed colours for the rest."""
    span = cells.where("kind = 1").agg(F.min("elev").alias("low"), F.max("elev").alias("high"))
    grey = F.round(255 * F.coalesce(F.try_divide(F.col("elev") - F.col("low"), F.col("high") - F.col("low")), F.lit(0.0))).cast("int")
    fixed = {0: (255, 0, 255), 2: (0, 0, 160), 3: (0, 160, 255), 4: (0, 80, 80), 5: (0, 200, 160)}
    rgb = F.array(grey, grey, grey)
    for kind, colour in fixed.items():
        rgb = F.when(F.col("kind") == kind, F.array(*[F.lit(c) for c in colour])).otherwise(rgb)
    return cells.join(F.broadcast(span)).withColumn("rgb", rgb).drop("low", "high")  # span is one row
