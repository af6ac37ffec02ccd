"""The elevation store: a table of tiles by layer, one of grids, and one of key and value rows.

tile (layer, tile_x, tile_y, cells map<place, struct<meters, source_code>>, valid); grid (layer, origin_lat, origin_lon,
step_lat, step_lon).  The place of a cell in a tile is py * 256 + px.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo
from .raster import packed_tiles

GRID = ("layer", "origin_lat", "origin_lon", "step_lat", "step_lon")


def known_layers(rows: DataFrame, grids: DataFrame, layers: list[int] | None = None) -> DataFrame:
    """rows of the layers asked for (all by default); a layer that has no grid is an error."""
    if layers is not None:
        rows = rows.where(F.col("layer").isin(layers))
    held = rows.join(F.broadcast(grids.select("layer", F.lit(True).alias("_g"))), "layer", "left")  # a row for each layer
    return held.where(F.assert_true(F.col("_g").isNotNull(), F.concat(F.lit("unknown layer "), F.col("layer").cast("string"))).isNull()).drop("_g")


def write_store(cells: DataFrame, grids: DataFrame, path: str, facts: dict[str, str], layers: list[int] | None = None) -> None:
    """Writes tiles (partitioned by layer), grids and facts under path, which must not exist."""
    spark = cells.sparkSession
    packed_tiles(known_layers(cells, grids, layers), "layer").write.partitionBy("layer").parquet(f"{path}/tiles")
    chosen = grids if layers is None else grids.where(F.col("layer").isin(layers))
    chosen.select(*GRID).coalesce(1).write.parquet(f"{path}/grids")
    meta_rows(spark, facts).coalesce(1).write.parquet(f"{path}/meta")


def meta_rows(spark: SparkSession, facts: dict[str, str]) -> DataFrame:
    """key and value rows, ordered by key."""
    return spark.createDataFrame(sorted(facts.items()), "key string, value string")


def open_store(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Tiles, grids and facts."""
    return tuple(spark.read.parquet(f"{path}/{x}") for x in ("tiles", "grids", "meta"))


def grid_of(grids: DataFrame, layer: int) -> dict:
    """A layer's grid as the lookup takes it; fails for an unknown layer."""
    found = grids.where(F.col("layer") == layer).first()
    if found is None:
        raise ValueError(f"unknown layer {layer}")
    return {k: found[k] for k in GRID[1:]}


def cells_of(tiles: DataFrame) -> DataFrame:
    """The cells of tiles again; a place outside a tile is an error."""
    side = geo.TILE_CELLS
    rows = tiles.select("layer", "tile_x", "tile_y", F.explode("cells").alias("at", "c"))
    checked = rows.where(F.assert_true(F.col("at").between(0, side * side - 1), F.lit("a tile holds a place outside it")).isNull())
    return checked.select("layer", "tile_x", "tile_y", (F.col("at") % side).alias("px"), F.floor(F.col("at") / side).alias("py"), "c.meters", "c.source_code")


def one_tile(tiles: DataFrame, layer: int, tile_x: int, tile_y: int) -> DataFrame:
    """The cells of one tile; the key reaches the scan."""
    return cells_of(tiles.where((F.col("layer") == layer) & (F.col("tile_x") == tile_x) & (F.col("tile_y") == tile_y)))
