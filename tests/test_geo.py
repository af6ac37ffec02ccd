import math

from pyspark.sql import functions as F

from geoloom.functions import geo


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_tiles_of_negative_cells(spark):
    got = spark.createDataFrame([(-1,), (0,), (255,), (256,), (-256,), (-257,)], "c long").select(geo.tile_of(F.col("c")), geo.in_tile(F.col("c"))).collect()
    assert [tuple(r) for r in got] == [(-1, 255), (0, 0), (0, 255), (1, 0), (-1, 0), (-2, 255)]


def test_quantized_rounds_away_from_zero(spark):
    rows = [(100.5,), (-5.5,), (float("nan"),), (None,), (1e6,), (-1e6,)]
    got = [r[0] for r in spark.createDataFrame(rows, "m double").select(geo.quantized(F.col("m"))).collect()]
    assert got == [101, -6, None, None, 32767, -32767]
    assert one(spark, geo.raw_metres(F.lit(None).cast("smallint"))) == -32768


def test_haversine_forms_agree(spark):
    args = [F.lit(x) for x in (34.0, 134.0, 34.0, 134.001)]
    a, b = one(spark, geo.haversine_m(*args)), one(spark, geo.haversine_asin_m(*args))
    assert math.isclose(a, b, rel_tol=1e-9) and 91 < a < 93


def test_bounds_are_inclusive_and_clamped(spark):
    row = geo.raster_row(F.lit(34.0), F.lit(34.5), F.lit(0.25), F.lit(2))
    assert one(spark, row) == 1
    assert one(spark, geo.within(F.lit(34.0), F.lit(134.0), 34.0, 35.0, 133.0, 134.0))


def test_stored_order_of_partial_grids(spark):
    cells = spark.range(4).select(geo.stored_row(F.col("id"), F.lit(2), F.lit(0), F.lit(3)).alias("r"), geo.stored_col(F.col("id"), F.lit(2), F.lit(3)).alias("c"))
    assert [tuple(x) for x in cells.collect()] == [(0, 2), (1, 0), (1, 1), (1, 2)]
    back = [one(spark, geo.stored_index(F.lit(r), F.lit(c), F.lit(2), F.lit(0), F.lit(3))) for r, c in ((0, 2), (1, 0), (1, 2), (0, 1))]
    assert back == [0, 1, 3, None]


def test_polygon(spark):
    assert one(spark, geo.in_polygon(F.lit(33.8), F.lit(133.5))) is True
    assert one(spark, geo.in_polygon(F.lit(34.6), F.lit(135.4))) is False


def test_terrain_codec_round_trip(spark):
    c = one(spark, geo.terrain_rgb(F.lit(1234.5)))
    assert math.isclose(one(spark, geo.terrain_metres(F.lit(c.r), F.lit(c.g), F.lit(c.b))), 1234.5, abs_tol=0.05)


def test_hilbert_tiles_of_a_zoom_level_are_all_there(spark):
    zoom = 3
    first = (4**zoom - 1) // 3
    got = spark.range(first, first + 4**zoom).select(geo.archive_tile(F.col("id"), zoom).alias("t")).select("t.x", "t.y").collect()
    assert len({tuple(r) for r in got}) == 64
    assert all(abs(a.x - b.x) + abs(a.y - b.y) == 1 for a, b in zip(got, got[1:]))
