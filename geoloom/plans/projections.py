"""The driver's tables seen as points, cells, routes and records.

Coordinates come from integer arithmetic over powers of two, so every engine gets the same doubles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FINE_GRID = {"origin_lat": 34.0, "origin_lon": 133.0, "step_lat": 1 / 512, "step_lon": 1 / 512}
COARSE_GRID = {"origin_lat": 34.0, "origin_lon": 133.0, "step_lat": 1 / 256, "step_lon": 1 / 256}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    at = lambda base, factor: F.lit(base) + F.pmod(key * factor, F.lit(4096)) / F.lit(4096.0)
    return read(spark, sf_dir, "customer").select(key.alias("point_id"), at(33.0, 7919).alias("lat"), at(133.0, 104729).alias("lon"))


def elev_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = read(spark, sf_dir, "lineitem")
    place = {
        "layer": F.when(F.col("l_returnflag") == "R", 5).otherwise(10),
        "tile_x": F.when(F.col("l_returnflag") == "R", F.col("l_partkey") % 2).otherwise(0),
        "tile_y": F.when(F.col("l_returnflag") == "R", F.col("l_suppkey") % 2).otherwise(0),
        "px": F.col("l_orderkey") % 256,
        "py": (F.col("l_partkey") * 31 + F.col("l_linenumber") * 37) % 256,
    }
    cells = line.select(*[v.cast("long").alias(k) for k, v in place.items()], (F.col("l_partkey") % 1000).alias("meters"), (F.col("l_linenumber") % 4 + 1).alias("source_code"))
    low = F.min(F.struct("meters", "source_code"))
    return cells.groupBy(*place).agg(low.alias("c")).select(F.col("layer").cast("int").alias("layer"), "tile_x", "tile_y", "px", "py", F.col("c.meters").cast("int").alias("meters"), F.col("c.source_code").cast("int").alias("source_code"))


def dem_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = read(spark, sf_dir, "lineitem")
    kind = F.when(F.col("l_returnflag") == "N", 0).when(F.col("l_linestatus") == "O", 2).otherwise(1)
    keyed = line.select(
        F.format_string("%08d", F.col("l_partkey") % 8).alias("mesh"), (F.col("l_orderkey") % 150).cast("int").alias("row"), (F.col("l_suppkey") % 225).cast("int").alias("col"),
        (F.col("l_linenumber") % 4 + 1).cast("int").alias("source_code"), (F.col("l_partkey") % 900).cast("int").alias("elev"), kind.alias("kind"),
    )
    return keyed.groupBy("mesh", "row", "col", "source_code").agg(F.min(F.struct("kind", "elev")).alias("k")).select("mesh", "row", "col", "source_code", F.col("k.elev").alias("elev"), F.col("k.kind").alias("kind"))


#: Meshes lie side by side from 34.0, 133.0 on, 150 rows of 225 cells; the coarse raster has 70 rows for their 75.
FINE_STEP, COARSE_STEP = 1 / 1024, 1 / 512
MESHES, ROWS, COLS, COARSE_ROWS = 8, 150, 225, 70


def dem_grids(spark: SparkSession) -> DataFrame:
    """region, mesh, width, height and bounds of every mesh."""
    m = F.col("id")
    west = F.lit(133.0) + m * (COLS * FINE_STEP)
    return spark.range(MESHES).select(
        F.lit("000000").alias("region"), F.format_string("%08d", m).alias("mesh"), F.lit(COLS).alias("width"), F.lit(ROWS).alias("height"),
        F.lit(34.0 - ROWS * FINE_STEP).alias("min_lat"), F.lit(34.0).alias("max_lat"), west.alias("min_lon"), (west + COLS * FINE_STEP).alias("max_lon"),
    )


def coarse_grids(spark: SparkSession) -> DataFrame:
    width = MESHES * COLS // 2
    return spark.range(1).select(F.lit("000000").alias("region"), F.lit(width).alias("width"), F.lit(COARSE_ROWS).alias("height"), F.lit(34.0 - COARSE_ROWS * COARSE_STEP).alias("min_lat"), F.lit(34.0).alias("max_lat"), F.lit(133.0).alias("min_lon"), F.lit(133.0 + width * COARSE_STEP).alias("max_lon"))


def coarse_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = read(spark, sf_dir, "lineitem")
    kind = F.when(F.col("l_returnflag") == "A", 0).otherwise(1)
    keyed = line.select(((F.col("l_suppkey") * 7 + F.col("l_linenumber") * 11) % COARSE_ROWS).cast("int").alias("row"), ((F.col("l_partkey") * 13 + F.col("l_orderkey")) % (MESHES * COLS // 2)).cast("int").alias("col"), (F.col("l_partkey") % 900).cast("int").alias("elev"), kind.alias("kind"))
    return keyed.groupBy("row", "col").agg(F.min(F.struct("kind", "elev")).alias("k")).select(F.lit("000000").alias("region"), "row", "col", F.col("k.elev").alias("elev"), F.col("k.kind").alias("kind"))


DEM_SQL = f"""
dem AS (
  SELECT mesh, "row", col, source_code, min_k // 1000 AS kind, min_k % 1000 AS elev FROM (
    SELECT lpad(CAST(l_partkey % 8 AS VARCHAR), 8, '0') AS mesh, CAST(l_orderkey % 150 AS INT) AS "row", CAST(l_suppkey % 225 AS INT) AS col,
           CAST(l_linenumber % 4 + 1 AS INT) AS source_code,
           CAST(min((CASE WHEN l_returnflag = 'N' THEN 0 WHEN l_linestatus = 'O' THEN 2 ELSE 1 END) * 1000 + l_partkey % 900) AS INT) AS min_k
    FROM lineitem GROUP BY 1, 2, 3, 4)
), places AS (
  SELECT lpad(CAST(m AS VARCHAR), 8, '0') AS mesh, CAST(r AS INT) AS "row", CAST(c AS INT) AS col
  FROM range({MESHES}) a(m), range({ROWS}) b(r), range({COLS}) d(c)
), merged AS (
  SELECT p.mesh, p."row", p.col, CASE WHEN best > 0 THEN elev END AS elev, CASE WHEN best > 0 THEN kind ELSE 0 END AS kind, coalesce(best, 0) AS source_code
  FROM places p LEFT JOIN (
    SELECT mesh, "row", col, arg_max(elev, v) AS elev, arg_max(kind, v) AS kind, CAST(max(v) AS INT) AS best FROM (
      SELECT *, CASE WHEN kind <> 0 THEN source_code ELSE 0 END AS v FROM dem) GROUP BY 1, 2, 3) s USING (mesh, "row", col)
)
"""
COARSE_SQL = f"""
coarse AS (
  SELECT "row", col, k // 1000 AS kind, k % 1000 AS elev FROM (
    SELECT (l_suppkey * 7 + l_linenumber * 11) % {COARSE_ROWS} AS "row", (l_partkey * 13 + l_orderkey) % {MESHES * COLS // 2} AS col,
           min((CASE WHEN l_returnflag = 'A' THEN 0 ELSE 1 END) * 1000 + l_partkey % 900) AS k FROM lineitem GROUP BY 1, 2)
), gaps AS (
  SELECT m.mesh, c.kind IS NOT NULL AS filled FROM (
    SELECT mesh, 34e0 - ("row" + 0.5e0) / 1024 AS lat, 133e0 + (CAST(mesh AS INT) * {COLS} + col + 0.5e0) / 1024 AS lon FROM merged WHERE source_code = 0) m
  LEFT JOIN coarse c ON c.kind = 1 AND m.lat >= 34e0 - {COARSE_ROWS} / 512e0 AND c."row" = CAST(floor((34e0 - m.lat) * 512) AS BIGINT) AND c.col = CAST(floor((m.lon - 133e0) * 512) AS BIGINT)
), filled AS (
  SELECT mesh, count(*) FILTER (filled) AS fills, count(*) FILTER (NOT filled) AS remains FROM gaps GROUP BY mesh
)
"""
POINTS_SQL = """
pts AS (
  SELECT c_custkey AS point_id, 33e0 + ((c_custkey * 7919) % 4096) / 4096e0 AS lat, 133e0 + ((c_custkey * 104729) % 4096) / 4096e0 AS lon FROM customer
)
"""
CELLS_SQL = """
cells AS (
  SELECT layer, tile_x, tile_y, px, py, CAST(m // 10 AS INT) AS meters, CAST(m % 10 AS INT) AS source_code FROM (
    SELECT CASE WHEN l_returnflag = 'R' THEN 5 ELSE 10 END AS layer,
           CASE WHEN l_returnflag = 'R' THEN l_partkey % 2 ELSE 0 END AS tile_x, CASE WHEN l_returnflag = 'R' THEN l_suppkey % 2 ELSE 0 END AS tile_y,
           l_orderkey % 256 AS px, (l_partkey * 31 + l_linenumber * 37) % 256 AS py,
           min((l_partkey % 1000) * 10 + l_linenumber % 4 + 1) AS m
    FROM lineitem GROUP BY 1, 2, 3, 4, 5)
)
"""
