"""Queries over rasters: merge, fills, samples, the store, checks, tiles and geometry."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo
from ..operators import elevation, profile, raster, store
from .projections import CELLS_SQL, COARSE_GRID, COARSE_SQL, DEM_SQL, FINE_GRID, POINTS_SQL, coarse_cells, coarse_grids, dem_cells, dem_grids, elev_cells, points, read
from .registry import query


def _fine(spark, d):
    """Cells of the fine sources; the coarsest source is a raster of its own."""
    return dem_cells(spark, d)


def _merged(spark, d):
    return raster.merge_priority(_fine(spark, d), dem_grids(spark))


@query(f"WITH {DEM_SQL} SELECT * FROM merged")
def merge_priority(spark, d):
    return _merged(spark, d)


@query(f"""WITH {DEM_SQL} SELECT mesh, count(*) FILTER (source_code = 4) AS a, count(*) FILTER (source_code = 3) AS b, count(*) FILTER (source_code = 2) AS c,
count(*) FILTER (source_code = 0) AS nodata FROM merged GROUP BY ROLLUP (mesh)""")
def merge_wins_rollup(spark, d):
    return raster.mesh_wins(_merged(spark, d))


@query(f"""WITH {DEM_SQL}, s AS (SELECT mesh, coalesce(string_agg(DISTINCT x, '' ORDER BY x), '') AS s FROM (
SELECT mesh, CASE source_code WHEN 4 THEN 'A' WHEN 3 THEN 'B' WHEN 2 THEN 'C' END AS x FROM merged) GROUP BY mesh)
SELECT CASE WHEN s = '' THEN '-' ELSE s END AS combo, count(*) AS n FROM s GROUP BY 1""")
def source_combos(spark, d):
    return raster.source_combinations(_merged(spark, d))


@query(f"""WITH {DEM_SQL} SELECT mesh, count(*) FILTER (kind = 0) AS nodata, count(*) FILTER (kind = 1) AS terrain, count(*) FILTER (kind = 2) AS sea,
count(*) FILTER (kind = 3) AS inland_water, count(*) FILTER (kind = 4) AS seabed, count(*) FILTER (kind = 5) AS inland_bottom FROM merged GROUP BY mesh""")
def kind_counts(spark, d):
    return raster.kind_counts(_merged(spark, d), "mesh")


@query(f"WITH {DEM_SQL}, {COARSE_SQL} SELECT * FROM filled")
def dem10_fill(spark, d):
    return raster.coarse_fill(_merged(spark, d), dem_grids(spark).drop("region"), coarse_grids(spark), coarse_cells(spark, d))


@query(f"""WITH {DEM_SQL}, {COARSE_SQL}, w AS (SELECT mesh, count(*) FILTER (source_code = 4) AS a, count(*) FILTER (source_code = 3) AS b, count(*) FILTER (source_code = 2) AS c,
count(*) FILTER (source_code = 0) AS nodata FROM merged GROUP BY mesh)
SELECT mesh, count(*) AS meshes, CAST(sum(a) AS BIGINT) AS a, CAST(sum(b) AS BIGINT) AS b, CAST(sum(c) AS BIGINT) AS c, CAST(sum(nodata) AS BIGINT) AS nodata, CAST(sum(coalesce(fills, 0)) AS BIGINT) AS fills,
CAST(sum(coalesce(remains, 0)) AS BIGINT) AS remains, round(coalesce(100e0 * sum(coalesce(fills, 0)) / nullif(sum(coalesce(fills, 0) + coalesce(remains, 0)), 0), 0), 6) AS filled_pct FROM w LEFT JOIN filled USING (mesh) GROUP BY ROLLUP (mesh)""")
def region_merge(spark, d):
    sources = dem_grids(spark).crossJoin(spark.range(1, 5).select(F.col("id").cast("int").alias("source_code")))  # 8 meshes, 4 sources
    return raster.region_merge(sources, _fine(spark, d), coarse_grids(spark), coarse_cells(spark, d), ["000000", "999999"])


@query(f"""WITH {DEM_SQL} SELECT CAST(floor((CAST(mesh AS INT) * 225 + col) / 256e0) AS BIGINT) AS tile_x, CAST(floor(("row" + 200) / 256e0) AS BIGINT) AS tile_y,
CAST((CAST(mesh AS INT) * 225 + col) % 256 AS INT) AS px, CAST(("row" + 200) % 256 AS INT) AS py, CAST(elev AS SMALLINT) AS meters, source_code FROM merged WHERE kind <> 0""")
def tile_placement(spark, d):
    return raster.to_tiles(_merged(spark, d), F.lit(200), F.col("mesh").cast("int") * 225)


@query(f"""WITH {DEM_SQL}, p AS (SELECT o_orderkey, lpad(CAST(o_custkey % 8 AS VARCHAR), 8, '0') AS mesh, CAST(o_orderkey % 150 AS INT) AS "row", CAST(o_custkey % 225 AS INT) AS col FROM orders)
SELECT o_orderkey, p.mesh, p."row", p.col, elev, CASE WHEN kind BETWEEN 0 AND 5 THEN kind WHEN kind IS NOT NULL THEN 0 END AS kind
FROM p LEFT JOIN (SELECT mesh, "row", col, CASE WHEN elev % 7 = 0 THEN NULL ELSE CAST(elev AS DOUBLE) END AS elev, kind * 3 AS kind FROM dem WHERE source_code = 4) c ON c.mesh = p.mesh AND c."row" = p."row" AND c.col = p.col""")
def raster_sample(spark, d):
    at = read(spark, d, "orders").select("o_orderkey", F.format_string("%08d", F.col("o_custkey") % 8).alias("mesh"), (F.col("o_orderkey") % 150).cast("int").alias("row"), (F.col("o_custkey") % 225).cast("int").alias("col"))
    height = F.when(F.col("elev") % 7 == 0, float("nan")).otherwise(F.col("elev").cast("double"))
    return raster.sample_at(at, _fine(spark, d).where("source_code = 4").withColumn("elev", height).withColumn("kind", F.col("kind") * 3))


@query("SELECT 34 - 150 / 1024e0 AS min_lat, 34e0 AS max_lat, 133e0 AS min_lon, 133 + 1800 / 1024e0 AS max_lon")
def raster_bounds(spark, d):
    return raster.bounds(dem_grids(spark))


@query("""SELECT region, place FROM (SELECT lpad(CAST(s_nationkey AS VARCHAR), 6, '0') AS region, row_number() OVER (ORDER BY max((s_suppkey * 37) % 101) DESC, lpad(CAST(s_nationkey AS VARCHAR), 6, '0')) AS place FROM supplier GROUP BY 1, s_nationkey)""")
def region_order(spark, d):
    rows = read(spark, d, "supplier").select(F.format_string("%06d", F.col("s_nationkey")).alias("region"), ((F.col("s_suppkey") * 37) % 101).cast("double").alias("max_lat"), F.lit(0.0).alias("min_lat"))
    return raster.north_to_south(rows).select("region", F.col("place").cast("long").alias("place"))


@query("""WITH r AS (SELECT s_suppkey, lpad(CAST(s_nationkey AS VARCHAR), 6, '0') || '01' AS mesh, s_suppkey % 5 AS stored FROM supplier)
SELECT s_suppkey, mesh FROM r WHERE mesh[1:6] IN ('000003', '000007', '000021') AND stored <> 4""")
def region_filter(spark, d):
    rows = read(spark, d, "supplier").select("s_suppkey", F.concat(F.format_string("%06d", F.col("s_nationkey")), F.lit("01")).alias("mesh"), (F.col("s_suppkey") % 5).alias("stored"), F.lit(2).alias("width"), F.lit(2).alias("height"))
    return raster.in_regions(rows, ["000003", "000007", "000021"], partial_only=True).select("s_suppkey", "mesh")


@query(f"WITH {CELLS_SQL} SELECT CAST(layer AS INT) AS layer, tile_x, tile_y, count(*) AS valid, CAST(sum(meters) AS BIGINT) AS meters, CAST(sum(px * 256 + py) AS BIGINT) AS places FROM cells WHERE layer = 5 GROUP BY 1, 2, 3")
def store_tiles(spark, d):
    """Cells packed into tiles and unpacked again, of one layer that the grids know."""
    grids = spark.createDataFrame([(5, *FINE_GRID.values()), (10, *COARSE_GRID.values())], "layer int, origin_lat double, origin_lon double, step_lat double, step_lon double")
    tiles = raster.packed_tiles(store.known_layers(elev_cells(spark, d), grids, [5]), "layer")
    back = store.cells_of(tiles)
    return back.groupBy("layer", "tile_x", "tile_y").agg(F.count("*").alias("valid"), F.sum("meters").alias("meters"), F.sum(F.col("px") * 256 + F.col("py")).alias("places"))


@query(f"WITH {CELLS_SQL} SELECT CAST(layer AS INT) AS layer, tile_x, tile_y, CAST(px AS BIGINT) AS px, CAST(py AS BIGINT) AS py, meters, source_code FROM cells WHERE layer = 5 AND tile_x = 1 AND tile_y = 0")
def store_one_tile(spark, d):
    return store.one_tile(raster.packed_tiles(elev_cells(spark, d), "layer"), 5, 1, 0).withColumn("px", F.col("px").cast("long")).withColumn("py", F.col("py").cast("long"))


_BOTH_SQL = f"""{POINTS_SQL}, {CELLS_SQL}, a AS (SELECT *, CAST(floor((34e0 - lat) * 512) AS BIGINT) AS y5, CAST(floor((lon - 133e0) * 512) AS BIGINT) AS x5, CAST(floor((34e0 - lat) * 256) AS BIGINT) AS y10, CAST(floor((lon - 133e0) * 256) AS BIGINT) AS x10 FROM pts),
both_layers AS (SELECT point_id, CAST(f.meters AS FLOAT) AS fine_m, CAST(c.meters AS FLOAT) AS coarse_m FROM a LEFT JOIN cells f ON f.layer = 5 AND f.tile_x = x5 // 256 AND f.tile_y = y5 // 256 AND f.px = x5 % 256 AND f.py = y5 % 256
LEFT JOIN cells c ON c.layer = 10 AND c.tile_x = x10 // 256 AND c.tile_y = y10 // 256 AND c.px = x10 % 256 AND c.py = y10 % 256)"""


def _both(spark, d):
    return elevation.both_layers(points(spark, d), elev_cells(spark, d), FINE_GRID, COARSE_GRID).select("point_id", "fine_m", "coarse_m")


@query(f"WITH {_BOTH_SQL} SELECT * FROM both_layers")
def both_layers(spark, d):
    return _both(spark, d)


@query(f"""WITH {_BOTH_SQL}, p AS (SELECT point_id AS ord, point_id % 5 <> 0 AS inside, CASE WHEN point_id % 7 > 0 THEN CAST(point_id % 211 AS DOUBLE) END AS fine, CASE WHEN point_id % 11 > 0 THEN CAST((point_id * 3) % 223 AS DOUBLE) END AS coarse FROM both_layers),
d AS (SELECT ord, abs(fine - coarse) AS d FROM p WHERE inside AND fine IS NOT NULL AND coarse IS NOT NULL), l AS (SELECT list_sort(list(d)) AS s, count(*) AS n, max(d) AS worst FROM d),
c AS (SELECT count(*) FILTER (NOT inside) AS outside, count(*) FILTER (inside AND fine IS NOT NULL AND coarse IS NOT NULL) AS comparable, count(*) FILTER (inside AND abs(fine - coarse) <= 10) AS agree, count(*) FILTER (inside AND fine IS NULL AND coarse IS NOT NULL) AS gaps,
count(*) FILTER (inside AND fine IS NOT NULL AND coarse IS NULL) AS strays, count(*) FILTER (inside AND fine IS NULL AND coarse IS NULL) AS sea FROM p)
SELECT c.*, s[n // 2 + 1] AS median, s[least(CAST(floor(n * 0.9e0) AS BIGINT), n - 1) + 1] AS p90, worst, (SELECT min(ord) FROM d WHERE d = worst) AS worst_ord, round(agree / CAST(comparable AS DOUBLE), 9) AS land_share,
concat_ws(',', CASE WHEN s[n // 2 + 1] > 10 THEN 'median' END, CASE WHEN agree / CAST(comparable AS DOUBLE) < 0.6 THEN 'land_share' END, CASE WHEN strays >= 10 THEN 'strays' END) AS failed FROM c, l""")
def cross_validation(spark, d):
    k = F.col("point_id")
    rows = _both(spark, d).select(k.alias("ord"), (k % 5 != 0).alias("inside"), F.when(k % 7 > 0, (k % 211).cast("double")).alias("fine"), F.when(k % 11 > 0, ((k * 3) % 223).cast("double")).alias("coarse"))
    return elevation.cross_validation(rows)


@query(f"""WITH {_BOTH_SQL}, g AS (SELECT abs(coalesce(fine_m, coarse_m) - point_id % 1000) <= CASE WHEN point_id % 2 = 0 THEN 10 ELSE 20 END AS ok FROM both_layers), l AS (SELECT layer, count(*) AS valid FROM cells GROUP BY layer)
SELECT (SELECT count(*) FROM g) AS points, (SELECT count(*) FROM g WHERE NOT coalesce(ok, false)) AS failures, count(*) FILTER (valid = 0) AS empty_layers, count(*) AS layers, (SELECT count(*) FROM g WHERE NOT coalesce(ok, false)) = 0 AND count(*) > 0 AS passed FROM l""")
def golden_gate(spark, d):
    found = elevation.with_fallback(points(spark, d), elev_cells(spark, d), FINE_GRID, COARSE_GRID)
    rows = found.withColumn("expected_m", (F.col("point_id") % 1000).cast("double")).withColumn("expected_layer", F.when(F.col("point_id") % 2 == 0, "dem5").otherwise("dem10"))
    return elevation.golden_gate(elevation.golden_check(rows), raster.layer_coverage(elev_cells(spark, d)))


@query(f"""WITH {POINTS_SQL}, r AS (SELECT s_suppkey AS ordinal, 33e0 + (s_suppkey % 8) / 8e0 AS min_lat, 33e0 + (s_suppkey % 8 + 3) / 8e0 AS max_lat, 133e0 + (s_suppkey % 5) / 8e0 AS min_lon, 133e0 + (s_suppkey % 5 + 2) / 8e0 AS max_lon FROM supplier),
m AS (SELECT point_id, lat, lon, r.*, row_number() OVER (PARTITION BY point_id ORDER BY ordinal) AS rn FROM pts JOIN r ON lat BETWEEN min_lat AND max_lat AND lon BETWEEN min_lon AND max_lon)
SELECT point_id, ordinal, CAST(least(floor((max_lat - lat) * 128), 47) AS INT) AS "row", CAST(least(floor((lon - min_lon) * 128), 31) AS INT) AS col FROM m WHERE rn = 1""")
def first_raster(spark, d):
    k, at = F.col("s_suppkey"), lambda base, n, of, add=0: F.lit(base) + (F.col("s_suppkey") % of + add) / F.lit(8.0)
    rasters = read(spark, d, "supplier").select(k.alias("ordinal"), at(33.0, 8, 8).alias("min_lat"), at(33.0, 8, 8, 3).alias("max_lat"), at(133.0, 8, 5).alias("min_lon"), at(133.0, 8, 5, 2).alias("max_lon"), F.lit(32).alias("width"), F.lit(48).alias("height"))
    return elevation.first_raster(points(spark, d), rasters).select("point_id", "ordinal", "row", "col")


@query(f"""WITH {POINTS_SQL} SELECT point_id, round(2 * 6371000e0 * atan2(sqrt(h), sqrt(1 - h)), 3) AS atan_m, round(2 * 6371000e0 * asin(sqrt(h)), 3) AS asin_m FROM (
SELECT point_id, pow(sin(radians(33.5e0 - lat) / 2), 2) + cos(radians(lat)) * cos(radians(33.5e0)) * pow(sin(radians(133.5e0 - lon) / 2), 2) AS h FROM pts)""")
def haversine(spark, d):
    lat, lon = F.lit(33.5), F.lit(133.5)
    return points(spark, d).select("point_id", F.round(geo.haversine_m(F.col("lat"), F.col("lon"), lat, lon), 3).alias("atan_m"), F.round(geo.haversine_asin_m(F.col("lat"), F.col("lon"), lat, lon), 3).alias("asin_m"))


@query("""WITH c AS (SELECT event_id, user_id, lat, lon, lag(lat) OVER w AS la, lag(lon) OVER w AS lo FROM (SELECT event_id, user_id, 33e0 + (event_id * 7919 % 4096) / 4096e0 AS lat, 133e0 + (event_id * 104729 % 4096) / 4096e0 AS lon FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
s AS (SELECT event_id, user_id, coalesce(2 * 6371000e0 * atan2(sqrt(h), sqrt(1 - h)), 0) AS step FROM (SELECT *, pow(sin(radians(lat - la) / 2), 2) + cos(radians(la)) * cos(radians(lat)) * pow(sin(radians(lon - lo) / 2), 2) AS h FROM c))
SELECT event_id, user_id, round(sum(step) OVER (PARTITION BY user_id ORDER BY event_id), 2) AS distance_m FROM s""")
def line_distance(spark, d):
    k = F.col("event_id")
    at = lambda base, f: F.lit(base) + ((k * f) % 4096) / F.lit(4096.0)
    rows = read(spark, d, "events").select("event_id", "user_id", at(33.0, 7919).alias("lat"), at(133.0, 104729).alias("lon"))
    return profile.with_distance(rows, "user_id", order="event_id").select("event_id", "user_id", F.round("distance_m", 2).alias("distance_m"))


@query("""WITH k AS (SELECT o_orderkey, o_orderkey % 1000 AS i, o_custkey % 40 AS sx, o_orderkey % 7 AS sy FROM orders),
r AS (SELECT *, CASE WHEN i < 50 - sx THEN sy ELSE sy + 1 + (i - (50 - sx)) // 50 END AS "row", CASE WHEN i < 50 - sx THEN sx + i ELSE (i - (50 - sx)) % 50 END AS col FROM k)
SELECT o_orderkey, CAST("row" AS INT) AS "row", CAST(col AS INT) AS col, i AS place, 50 - sx + 50 * (30 - 1 - sy) AS capacity, round(34 - ("row" + 0.5e0) / 64, 9) AS lat, round(133 + (col + 0.5e0) / 64, 9) AS lon FROM r""")
def stored_samples(spark, d):
    """Row and column of a stored sample, its place found again, what a grid can hold, and the cell's centre."""
    i, sx, sy, w = F.col("o_orderkey") % 1000, F.col("o_custkey") % 40, F.col("o_orderkey") % 7, F.lit(50)
    rows = read(spark, d, "orders").select("o_orderkey", sx.alias("sx"), sy.alias("sy"), geo.stored_row(i, sx, sy, w).alias("row"), geo.stored_col(i, sx, w).alias("col"))
    lat, lon = geo.cell_centre(F.col("row"), F.col("col"), F.lit(34.0), F.lit(133.0), F.lit(1 / 64), F.lit(1 / 64))
    return rows.select("o_orderkey", "row", "col", geo.stored_index(F.col("row"), F.col("col"), F.col("sx"), F.col("sy"), w).alias("place"), geo.grid_capacity(F.col("sx"), F.col("sy"), w, F.lit(30)).alias("capacity"), F.round(lat, 9).alias("lat"), F.round(lon, 9).alias("lon"))


@query(f"""WITH {POINTS_SQL} SELECT point_id, ceil(lat * 64) / 64 AS north, floor(lon * 64) / 64 AS west, CAST(round((34e0 - lat) * 4096) AS BIGINT) AS down FROM pts""")
def grid_alignment(spark, d):
    step = F.lit(1 / 64)
    return points(spark, d).select("point_id", geo.aligned_origin(F.col("lat"), step, True).alias("north"), geo.aligned_origin(F.col("lon"), step, False).alias("west"), geo.placement_offset(F.lit(34.0), F.col("lat"), F.lit(1 / 4096)).alias("down"))


@query("""WITH b AS (SELECT s_suppkey, 30e0 + s_suppkey % 20 AS lat, 130e0 + s_suppkey % 15 AS lon FROM supplier), t AS (SELECT s_suppkey, CAST(floor((lon + 180) / 360 * 512) AS INT) AS x0, CAST(floor((lon + 2 + 180) / 360 * 512) AS INT) AS x1,
CAST(floor((1 - ln(tan(radians(lat + 1)) + 1 / cos(radians(lat + 1))) / pi()) / 2 * 512) AS INT) AS y0, CAST(floor((1 - ln(tan(radians(lat)) + 1 / cos(radians(lat))) / pi()) / 2 * 512) AS INT) AS y1 FROM b), x AS (SELECT s_suppkey, unnest(range(x0, x1 + 1)) AS x, y0, y1 FROM t)
SELECT s_suppkey, CAST(x AS INT) AS x, CAST(y AS INT) AS y, CAST(511 - y AS INT) AS tms_y FROM (SELECT s_suppkey, x, unnest(range(y0, y1 + 1)) AS y FROM x)""")
def web_tiles(spark, d):
    lat, lon = F.lit(30.0) + F.col("s_suppkey") % 20, F.lit(130.0) + F.col("s_suppkey") % 15
    tiles = geo.tiles_over(lat, lat + 1, lon, lon + 2, F.lit(9))
    return read(spark, d, "supplier").select("s_suppkey", F.explode(tiles).alias("t")).select("s_suppkey", "t.x", "t.y", "t.tms_y")


@query("""WITH RECURSIVE c(o_orderkey, bit, rest, x, y) AS (SELECT o_orderkey, 0, (o_orderkey * 104729) % 4194304, CAST(0 AS BIGINT), CAST(0 AS BIGINT) FROM orders UNION ALL
SELECT o_orderkey, bit + 1, rest // 4, CASE WHEN ry = 0 THEN CASE WHEN rx = 1 THEN side - 1 - y ELSE y END ELSE x END + rx * side, CASE WHEN ry = 0 THEN CASE WHEN rx = 1 THEN side - 1 - x ELSE x END ELSE y END + ry * side
FROM (SELECT *, CAST(pow(2, bit) AS BIGINT) AS side, (rest // 2) % 2 AS rx, (rest % 2 + (rest // 2) % 2) % 2 AS ry FROM c WHERE bit < 11))
SELECT o_orderkey, CAST(x AS BIGINT) AS x, CAST(y AS BIGINT) AS y FROM c WHERE bit = 11""")
def hilbert_tiles(spark, d):
    first = (4**11 - 1) // 3
    rows = read(spark, d, "orders").select("o_orderkey", geo.archive_tile((F.col("o_orderkey") * 104729) % 4194304 + first, 11).alias("t"))
    return rows.select("o_orderkey", "t.x", "t.y")


@query(f"WITH {POINTS_SQL}, {CELLS_SQL} SELECT p.point_id, c.meters FROM pts p LEFT JOIN cells c ON c.layer = 10 AND c.tile_x = 0 AND c.tile_y = 0 AND c.px = CAST(floor((lon - 133e0) * 256) AS BIGINT) AND c.py = CAST(floor((34e0 - lat) * 256) AS BIGINT)")
def one_layer_lookup(spark, d):
    found = elevation.in_layer(points(spark, d), elev_cells(spark, d), COARSE_GRID, elevation.COARSE, "c")
    return elevation.in_order(found.select("point_id", F.col("c.elevation_m").cast("int").alias("meters")), "point_id")
