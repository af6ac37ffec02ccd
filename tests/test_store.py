import json

import pytest
from pyspark.sql import functions as F

from geoloom.functions import geo
from geoloom.operators import elevation, linking, osm, raster, reports, store
from geoloom.sources import archives, exports, records

GRIDS = "layer int, origin_lat double, origin_lon double, step_lat double, step_lon double"
SIDES = "min_lat double, max_lat double, min_lon double, max_lon double"


@pytest.fixture
def cells(spark):
    return spark.createDataFrame([(5, 0, 0, 3, 4, 7, 4), (5, 1, 0, 255, 255, -2, 3), (10, 0, 0, 0, 0, 9, 1)], "layer int, tile_x long, tile_y long, px int, py int, meters int, source_code int")


def test_store_round_trip(spark, cells, tmp_path):
    grids = spark.createDataFrame([(5, 34.0, 133.0, 0.5, 0.5), (10, 34.0, 133.0, 1.0, 1.0)], GRIDS)
    path = str(tmp_path / "store")
    store.write_store(cells, grids, path, {"b": "2", "a": "1"}, [5])
    tiles, kept, facts = store.open_store(spark, path)
    assert [tuple(r) for r in facts.collect()] == [("a", "1"), ("b", "2")]
    assert store.grid_of(kept, 5)["step_lat"] == 0.5
    with pytest.raises(ValueError, match="unknown layer 10"):
        store.grid_of(kept, 10)
    assert [tuple(r)[3:] for r in store.one_tile(tiles, 5, 1, 0).collect()] == [(255, 255, -2, 3)]
    assert store.cells_of(tiles).count() == 2
    with pytest.raises(Exception, match="(?i)exists"):
        store.write_store(cells, grids, path, {})


def test_unknown_layers_and_places_are_errors(spark, cells):
    grids = spark.createDataFrame([(5, 34.0, 133.0, 0.5, 0.5)], GRIDS)
    with pytest.raises(Exception, match="unknown layer 10"):
        store.known_layers(cells, grids).collect()
    bad = spark.range(1).select(F.lit(5).alias("layer"), F.lit(0).alias("tile_x"), F.lit(0).alias("tile_y"), F.create_map(F.lit(65536), F.struct(F.lit(1).alias("meters"), F.lit(4).alias("source_code"))).alias("cells"))
    with pytest.raises(Exception, match="outside"):
        store.cells_of(bad).collect()


def test_merge_counts_the_full_grid(spark):
    cells = spark.createDataFrame([("00000001", 1, 1, 4, 5, 1)], "mesh string, row int, col int, source_code int, elev int, kind int")
    grids = spark.createDataFrame([("00000001", 3, 2), ("00000002", 1, 1)], "mesh string, width int, height int")
    wins = {r.mesh: (r.a, r.nodata) for r in raster.mesh_wins(raster.merge_priority(cells, grids)).collect()}
    assert wins == {"00000001": (1, 5), "00000002": (0, 1), None: (1, 6)}


def test_region_merge_of_partial_grids(spark):
    rasters = spark.createDataFrame([("503300", "50330000", 4, 2, 2, 34.0, 35.0, 133.0, 134.0), ("503300", "50330000", 3, 2, 2, 34.0, 35.0, 133.0, 134.0), ("503400", "50340000", 4, 1, 1, 34.0, 35.0, 134.0, 135.0)], f"region string, mesh string, source_code int, width int, height int, {SIDES}")
    cells = spark.createDataFrame([("50330000", 0, 0, 4, 5, 1)], "mesh string, row int, col int, source_code int, elev int, kind int")
    coarse_grids = spark.createDataFrame([("503300", 1, 2, 34.0, 35.0, 133.0, 134.0)], f"region string, width int, height int, {SIDES}")
    coarse = spark.createDataFrame([("503300", 0, 0, 8, 1), ("503300", 1, 0, 8, 2)], "region string, row int, col int, elev int, kind int")
    got = {r.mesh: (r.meshes, r.a, r.nodata, r.fills, r.remains) for r in raster.region_merge(rasters, cells, coarse_grids, coarse).collect()}
    assert got == {"50330000": (1, 1, 3, 1, 2), "50340000": (1, 0, 1, 0, 0), None: (2, 1, 4, 1, 2)}
    only = raster.region_merge(rasters, cells, coarse_grids, coarse, ["503400"]).collect()
    assert {r.mesh for r in only} == {"50340000", None}
    assert [r.region for r in raster.absent_regions(rasters, ["503300", "999999"]).collect()] == ["999999"]
    with pytest.raises(Exception, match="not of region"):
        raster.region_merge(rasters.withColumn("region", F.lit("111111")), cells, coarse_grids, coarse).collect()
    with pytest.raises(Exception, match="duplicate source"):
        raster.region_merge(rasters.unionAll(rasters), cells, coarse_grids, coarse).collect()


def test_difference_stats_by_bins(spark):
    values = [0.25 * i for i in range(37)] + [100.0]
    rows = spark.createDataFrame([(i, v, 0.0) for i, v in enumerate(values)] + [(99, None, 1.0)], "ord int, a double, b double")
    r = elevation.difference_stats(rows).first()
    s = sorted(values)
    assert (r.n, r.median, r.p90, r.worst, r.worst_ord) == (38, s[19], s[34], 100.0, 37)
    assert elevation.difference_stats(rows.limit(0)).first().n == 0


def test_cross_validation_rules(spark):
    schema = "ord int, inside boolean, fine double, coarse double"
    good = [(i, True, 100.0, 101.0) for i in range(20)] + [(30 + i, True, None, None) for i in range(3)] + [(50, False, None, None)]
    r = elevation.cross_validation(spark.createDataFrame(good, schema)).first()
    assert (r.failed, r.comparable, r.agree, r.sea, r.outside) == ("", 20, 20, 3, 1)
    bad = [(i, True, 100.0, 150.0) for i in range(5)] + [(10 + i, True, 3.0, None) for i in range(10)]
    assert elevation.cross_validation(spark.createDataFrame(bad, schema)).first().failed == "median,land_share,strays"
    assert elevation.cross_validation(spark.createDataFrame([], schema)).first().failed == "no_land"


@pytest.mark.parametrize("zoom", [0, 1, 5, 14])
def test_hilbert_tiles_of_deep_levels(spark, zoom):
    first, n = (4**zoom - 1) // 3, min(4**zoom, 3000)
    got = spark.range(first, first + n).select(geo.archive_tile(F.col("id"), zoom).alias("t")).select("t.x", "t.y").collect()
    assert len({tuple(r) for r in got}) == n
    assert all(abs(a.x - b.x) + abs(a.y - b.y) == 1 for a, b in zip(got, got[1:]))


def test_exports(spark, tmp_path):
    rows = spark.createDataFrame([(0, "resolved", "p", "33.5", "133.5", "a"), (1, "resolved", "p", "33.6", "133.6", "b"), (2, "resolved", "", "1", "1", "c"), (3, "pending", "q", "1", "1", "d"), (4, "resolved", "r", "95", "1", "e")], "ord int, status string, place_id string, lat string, lon string, name string")
    doc = json.loads(exports.collection(exports.map_points(rows, "name")).first().value)
    assert [f["properties"]["name"] for f in doc["features"]] == ["a"] and doc["features"][0]["geometry"]["coordinates"] == [133.5, 33.5]
    assert json.loads(exports.collection(exports.map_points(rows.limit(0), "name")).first().value) == {"type": "FeatureCollection", "features": []}
    line = spark.createDataFrame([(0, [[133.0, 33.0], [134.0, 33.0]], "r")], "ord int, coordinates array<array<double>>, route_id string")
    assert json.loads(exports.line_features(line, "route_id").first().feature)["geometry"]["type"] == "LineString"
    exports.write_json_lines(spark.createDataFrame([(1, None)], "b int, a string"), str(tmp_path / "lines"))
    assert spark.read.text(str(tmp_path / "lines")).first().value == '{"a":null,"b":1}'
    report = exports.write_report(reports.status_counts(spark.createDataFrame([("x",), (None,)], "status string"), "x"), str(tmp_path / "report.json"))
    assert report == {"x": 1, "other": 1} == json.loads((tmp_path / "report.json").read_text())
    assert "| x | 1 |" in exports.report_text(report, "t")


def test_temples_of_maps(spark):
    rows = [(1, {"amenity": "place_of_worship", "name": "第12番札所 甲"}), (2, {"amenity": "place_of_worship", "name": "第１３番札所 別格"}), (3, {"amenity": "bar", "name": "第14番札所"}), (4, {"amenity": "place_of_worship"})]
    got = osm.temple_candidates(spark.createDataFrame(rows, "id int, tags map<string,string>")).collect()
    assert [(r.id, r.number, r.noise, r.wide) for r in got] == [(1, 12, False, False), (2, 13, True, True)]


def test_last_asset_of_a_url(spark):
    images = spark.createDataFrame([("u",), ("v",)], "url string")
    assets = spark.createDataFrame([(0, "u", "a"), (1, "u", "b")], "ord int, url string, path string")
    assert {r.url: r.local_path for r in linking.with_files(images, assets).collect()} == {"u": "b", "v": None}


def test_json_lines_and_golden_points(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"x": 2}\n\n{"x": 1}\n')
    assert [r.x for r in records.json_lines(spark, str(tmp_path / "a.jsonl"), "x int").orderBy("ord").collect()] == [2, 1]
    (tmp_path / "bad.jsonl").write_text("{x\n")
    with pytest.raises(Exception):
        records.json_lines(spark, str(tmp_path / "bad.jsonl"), "x int").collect()
    point = {"name": "a", "lat": 33.5, "lon": 133.5, "expected_m": 4.0, "layer": "dem10"}
    (tmp_path / "golden.json").write_text(json.dumps({"tolerance_m": {"dem5": 3, "dem10": 7}, "points": [point, point | {"layer": "dem5"}]}))
    got = records.golden_points(spark, str(tmp_path / "golden.json")).orderBy("ord").collect()
    assert [(r.name, r.expected_layer, r.tolerance_m) for r in got] == [("a", "dem10", 7.0), ("a", "dem5", 3.0)]
    (tmp_path / "golden2.json").write_text(json.dumps({"tolerance_m": {"dem5": 3, "dem10": 7}, "points": [point | {"lat": None}]}))
    with pytest.raises(Exception, match="bad golden point 0"):
        records.golden_points(spark, str(tmp_path / "golden2.json")).collect()


def test_archives_by_region(spark):
    rows = spark.createDataFrame([(f"/d/{n}",) for n in ("FG-5033-01-DEM5A.zip", "FG-5033-01-DEM5B.zip", "FG-5034-00-DEM10B.zip", "x.zip")], "path string")
    assert [tuple(r) for r in archives.fine_archives(rows).collect()] == [("503301", ["/d/FG-5033-01-DEM5A.zip", "/d/FG-5033-01-DEM5B.zip"])]
    twice = spark.createDataFrame([("/a/FG-5034-00-DEM10B.zip",), ("/b/FG-5034-00-DEM10B.zip",)], "path string").withColumn("content", F.lit(b""))
    with pytest.raises(Exception, match="two archives for region 503400"):
        archives.coarse_rasters(twice).collect()


def test_spots_in_a_script(spark):
    page = "<script>var spots = [{\"Spot\":{\"spot_category_id\":\"3\",\"number\":\"7\"},\"SpotContent\":{\"tel_ja\":\"1\"}},{\"Spot\":{\"spot_category_id\":\"4\"}}];</script>"
    got = archives.script_spots(spark.createDataFrame([(page,)], "html string")).collect()
    assert [(r.spot["number"], r.content["tel_ja"]) for r in got] == [("7", "1")]
    with pytest.raises(Exception, match="no spots"):
        archives.script_spots(spark.createDataFrame([("none",)], "html string")).collect()
