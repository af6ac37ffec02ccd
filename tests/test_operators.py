import io
import zipfile

import pytest
from pyspark.sql import functions as F

from geoloom.operators import elevation, linking, osm, profile, raster, reports
from geoloom.sources import archives, records

CELL = "mesh string, source_code int, row int, col int, elev float, kind int"


def test_merge_takes_the_finest_valid_source(spark):
    rows = [("m", 4, 0, 0, None, 0), ("m", 3, 0, 0, 7.0, 1), ("m", 4, 0, 1, 0.0, 2), ("m", 3, 0, 1, 5.0, 1), ("m", 4, 1, 0, None, 0), ("m", 2, 1, 1, -5.0, 4)]
    got = {(r.row, r.col): (r.elev, r.kind, r.source_code) for r in raster.merge_priority(spark.createDataFrame(rows, CELL)).collect()}
    assert got == {(0, 0): (7.0, 1, 3), (0, 1): (0.0, 2, 4), (1, 0): (None, 0, 0), (1, 1): (-5.0, 4, 2)}


def test_grids_of_a_mesh_must_agree(spark):
    schema = "mesh string, source_code int, width int, height int, min_lat double, max_lat double, min_lon double, max_lon double"
    one = ("m", 4, 3, 2, 34.0, 35.0, 133.0, 134.0)
    assert raster.checked_grids(spark.createDataFrame([one, ("m", 3, *one[2:])], schema)).count() == 2
    for bad in (("m", 3, 4, *one[3:]), one):
        with pytest.raises(Exception, match="m: "):
            raster.checked_grids(spark.createDataFrame([one, bad], schema)).collect()


def test_fallback_to_the_coarse_layer(spark):
    step = 1 / 18000
    fine = {"origin_lat": 34.508333333, "origin_lon": 134.25, "step_lat": step, "step_lon": step}
    coarse = {**fine, "step_lat": step / 2, "step_lon": step / 2}
    cells = spark.createDataFrame([(5, 0, 0, 100, 100, 123, 4), (10, 0, 0, 100, 100, 99, 1)], "layer int, tile_x long, tile_y long, px long, py long, meters int, source_code int")
    at = lambda n: (fine["origin_lat"] - n * step, fine["origin_lon"] + n * step)
    points = spark.createDataFrame([(0, *at(100.5)), (1, *at(50.25)), (2, *at(7.5)), (3, *at(-3.0)), (4, None, None)], "ord int, lat double, lon double")
    got = [tuple(r)[3:] for r in elevation.with_fallback(points, cells, fine, coarse).orderBy("ord").collect()]
    assert got == [(123.0, 5, 4), (99.0, 10, 1), (None, None, None), (None, None, None), (None, None, None)]


def test_first_raster_on_a_shared_edge(spark):
    rasters = spark.createDataFrame([(0, 34.0, 34.5, 133.0, 133.5, 2, 2), (1, 34.5, 35.0, 133.0, 133.5, 2, 2)], "ordinal int, min_lat double, max_lat double, min_lon double, max_lon double, width int, height int")
    got = elevation.first_raster(spark.createDataFrame([(1, 34.5, 133.5)], "point_id int, lat double, lon double"), rasters).first()
    assert (got.ordinal, got.row, got.col) == (0, 0, 1)


def test_first_raster_under_many_rasters(spark):
    k = F.col("id")
    same = spark.range(60000).select(k.alias("ordinal"), *[F.lit(x).alias(n) for n, x in (("min_lat", 33.0), ("max_lat", 34.0), ("min_lon", 133.0), ("max_lon", 134.0), ("width", 2), ("height", 2))])
    nested = spark.range(2000).select((k - 2000).alias("ordinal"), (33.5 - (k + 1) / 8000).alias("min_lat"), (33.5 + (k + 1) / 8000).alias("max_lat"), (133.5 - (k + 1) / 8000).alias("min_lon"), (133.5 + (k + 1) / 8000).alias("max_lon"), F.lit(2).alias("width"), F.lit(2).alias("height"))
    points = spark.range(4000).select(k.alias("point_id"), (33.5 + k / 8000).alias("lat"), F.lit(133.5).alias("lon"))
    assert elevation.raster_places(same, 0.125).count() == 81  # not 60000 for each place
    found = elevation.first_raster(points, same.unionByName(nested))
    assert found.agg(F.count("*"), F.count_if(F.col("ordinal") == F.when(F.col("point_id") <= 2000, F.greatest(F.col("point_id") - 2001, F.lit(-2000))).otherwise(0))).first() == (4000, 4000)


def test_profile_of_a_line(spark):
    line = spark.createDataFrame([("a", 0, 34.0, 134.0), ("a", 1, 34.0, 134.001)], "line string, ord int, lat double, lon double")
    rows = profile.resampled(profile.with_distance(line, "line"), 20.0, "line").orderBy("distance_m").collect()
    assert [round(r.distance_m) for r in rows] == [0, 20, 40, 60, 80, 92]
    assert rows[-1].lon == 134.001 and abs(rows[1].lon - 134.000217) < 1e-6


def test_gaps_are_missing_distance(spark):
    rows = spark.createDataFrame([("a", 0.0, 10), ("a", 20.0, 15), ("a", 40.0, None), ("a", 60.0, 5), ("a", 80.0, 1)], "line string, distance_m double, elevation_m int")
    r = profile.segments(rows, "line").first()
    assert (r.distance_m, r.elevation_min_m, r.elevation_max_m, r.ascent_m, r.descent_m, r.missing_distance_m) == (80.0, 1, 15, 5, 4, 40.0)


def test_default_segment_ids_count_over_the_file(spark):
    rows = spark.createDataFrame([(0, "r", None), (1, "q", "x"), (2, "r", None)], "ord int, route_id string, segment_id string")
    assert [r.segment_id for r in profile.default_segment_ids(rows).orderBy("ord").collect()] == ["r_L001", "x", "r_L003"]


def test_duplicates_report_the_first_signal(spark):
    rows = [(1, "a", "p", "", 34.0, 134.0), (2, "a", "p", "w", 34.0, 134.0005), (3, "a", "", "w", 34.5, 134.0), (4, "", "p", "", 34.0, 134.0)]
    got = {(r.a, r.b): r.signal for r in linking.duplicate_pairs(spark.createDataFrame(rows, "ord int, name string, phone string, website string, lat double, lon double")).collect()}
    assert got == {(1, 2): "same name", (1, 4): "same phone", (2, 4): "same phone", (2, 3): "same website"}


def test_duplicates_are_not_grouped_and_meet_in_tiles(spark):
    schema = "ord int, name string, phone string, website string, lat double, lon double"
    rows = [(i, "abc"[i % 3], "pq"[i % 2] if i % 5 else None, "w" if i % 7 == 0 else "", 34.0 + (i % 4) / 2000, 134.0 if i % 11 else None) for i in [*range(60), 3, 3, 14, 40]]

    def signal(x, y):
        near = None not in (x[5], y[5]) and abs(x[4] - y[4]) * 111195 < 100
        return 1 if x[1] == y[1] and near else 2 if x[2] and x[2] == y[2] else 3 if x[3] and x[3] == y[3] else 9

    want = {}
    for x in rows:
        for y in rows:
            if x[0] < y[0] and signal(x, y) < 9:
                want[x[0], y[0]] = min(want.get((x[0], y[0]), 9), signal(x, y))
    found = [((r.a, r.b), r.signal) for r in linking.duplicate_pairs(spark.createDataFrame(rows, schema), block=4).collect()]
    assert len(found) == len(want)
    assert dict(found) == {k: ("", "same name", "same phone", "same website")[v] for k, v in want.items()}
    k = F.col("id")
    one = spark.range(4000).select(k.alias("x"), F.lit("k").alias("key"))
    pairs = linking.tiled_join(one, one.withColumnRenamed("x", "y"), ["key"], "x", "y", 256)
    sizes = [r["n"] for r in pairs.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 4000 * 4000 and max(sizes) < 8_000_000  # one task had them all


def test_geocoding_precedence(spark):
    sha = lambda u: F.sha2(F.lit(u), 256)
    cache = spark.range(1).select(F.explode(F.array(*[F.struct(sha(u).alias("url_sha256"), F.lit(f).alias("failed"), F.lit(n).alias("place_count"), F.lit(lat).alias("lat"), F.lit(lon).alias("lon")) for u, f, n, lat, lon in (("ok", False, 1, 33.5, 133.5), ("two", False, 2, 33.5, 133.5), ("far", False, 1, 40.0, 140.0), ("none", False, 0, 0.0, 0.0))])).alias("c")).select("c.*")
    rows = spark.createDataFrame([(0, ["none", "ok"]), (1, ["far", "two"]), (2, ["none", "gone"]), (3, ["none"]), (4, [])], "ord int, candidates array<string>")
    from geoloom.functions.geo import in_region

    got = [r.status for r in linking.geocoded(rows, cache, in_region).orderBy("ord").collect()]
    assert got == ["resolved", "place_ambiguous", "fetch_failed", "place_not_found", "no_url"]


def test_contexts_reset_with_the_prefecture(spark):
    rows = [("d", 0, "A", None), ("d", 1, None, 5), ("d", 2, None, None), ("d", 3, "B", None), ("d", 4, None, None)]
    got = linking.latest_context(spark.createDataFrame(rows, "doc string, ord int, prefecture string, temple int")).orderBy("ord").collect()
    assert [(r.prefecture, r.temple) for r in got] == [("A", None), ("A", 5), ("A", 5), ("B", None), ("B", None)]


def test_multipolygon_points(spark):
    square = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]
    ways = [(1, square[:3]), (2, square[2:]), (3, [(1.0, 1.0), (3.0, 1.0), (3.0, 3.0), (1.0, 3.0), (1.0, 1.0)])]
    ways = spark.createDataFrame([(i, [{"lon": x, "lat": y} for x, y in c]) for i, c in ways], "id long, coords array<struct<lon:double,lat:double>>")
    member = lambda i, role: {"type": "w", "ref": i, "role": role}
    relations = spark.createDataFrame([(10, [member(1, "outer"), member(2, "outer"), member(3, "inner"), member(9, "outer")])], "id long, members array<struct<type:string,ref:long,role:string>>")
    got = osm.representative_points(osm.relation_parts(relations, ways)).first()
    assert got.missing == 1 and got.closed and (0 < got.lon < 1 or 3 < got.lon < 4)


def test_warning_examples(spark):
    rows = spark.createDataFrame([(i, "c", i % 7) for i in range(30)] + [(30, "d", 1)], "ord int, code string, id int")
    got = {r.code: (r.n, r.examples) for r in reports.warning_examples(rows).collect()}
    assert got == {"c": (30, [0, 1, 2, 3, 4]), "d": (1, [1])}


def test_equal_numbers_keep_an_order(spark):
    rows = spark.createDataFrame([(9 - i, "x" if i % 2 else "7") for i in range(10)], "k int, id string")
    assert [r.k for r in reports.by_number(rows, "id", "k").orderBy("place").collect()] == [1, 3, 5, 7, 9, 0, 2, 4, 6, 8]


GML = """<?xml version="1.0" encoding="{enc}"?><Dataset xmlns:gml="http://g"><DEM><fid>f</fid><lfSpanFr><gml:timePosition>2025-12-08</gml:timePosition></lfSpanFr><mesh>51346200</mesh>
<coverage><gml:boundedBy><gml:Envelope srsName="fguuid:jgd2024.bl"><gml:lowerCorner>34.5 134.25</gml:lowerCorner><gml:upperCorner>34.6 134.4</gml:upperCorner></gml:Envelope></gml:boundedBy>
<gml:low>0 0</gml:low><gml:high>2 1</gml:high><gml:tupleList>
地表面,12.5
海水面,-9999.
データなし,-9999.
その他,-9999.00
その他,120.5
海水底面,-5.16
</gml:tupleList><gml:sequenceRule order="+x-y">Linear</gml:sequenceRule><gml:startPoint>0 0</gml:startPoint></coverage></DEM></Dataset>"""


@pytest.mark.parametrize("enc", ["UTF-8", "Shift_JIS"])
def test_gml_rasters_from_nested_archives(spark, tmp_path, enc):
    inner, outer = io.BytesIO(), tmp_path / "FG-GML-513462-DEM5A.zip"
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("a-DEM5A.XML", GML.format(enc=enc).encode("cp932" if enc == "Shift_JIS" else "utf-8"))
    with zipfile.ZipFile(outer, "w") as z:
        z.writestr("inner.zip", inner.getvalue())
        z.writestr("readme.txt", "x")
    found = archives.dem_rasters(archives.xml_entries(archives.files(spark, str(tmp_path), "*.zip")))
    r = found.first()
    assert (r.mesh, r.survey_date, r.width, r.height, r.crs) == ("51346200", "2025-12-08", 3, 2, "fguuid:jgd2024.bl")
    assert r.kind == [1, 2, 0, 0, 1, 4]
    assert [None if x is None else round(x, 2) for x in r.elev] == [12.5, 0.0, None, None, 120.5, -5.16]
    assert found.select(archives.region_of(F.col("path"))).first()[0] == "513462"
    cells = archives.dem_cells(found.withColumn("source_code", F.lit(4))).orderBy("row", "col").collect()
    assert [(c.row, c.col) for c in cells] == [(0, 0), (0, 1), (0, 2), (1, 0), (1, 1), (1, 2)]


def test_unknown_labels_are_errors():
    with pytest.raises(ValueError):
        archives.sample_of("??", "1")
    with pytest.raises(ValueError):
        archives.sample_of("地表面", "x")


def test_kml(spark, tmp_path):
    (tmp_path / "a.kml").write_text('<kml xmlns="http://k"><Placemark><name> A </name><description>x&lt;br&gt;y &amp;amp; z</description><MultiGeometry><Point><coordinates>1,2,0</coordinates></Point><LineString><coordinates>1,2 3,4</coordinates></LineString></MultiGeometry></Placemark></kml>')
    (tmp_path / "b.kml").write_text("<kml>")
    rows = archives.placemarks(archives.files(spark, str(tmp_path), "*.kml")).orderBy("path").collect()
    assert (rows[0].name, rows[0].description, [g.kind for g in rows[0].geometry]) == ("A", "x\ny & z", ["Point", "LineString"])
    assert "malformed" in rows[1].error


def test_html_tables(spark):
    page = "<table><tr><th>A</th><td>b<br>c</td></tr></table><a href='/x'> go </a><img src=q>"
    nodes = archives.page_nodes(spark.createDataFrame([(1, page), (2, None)], "id int, html string"), "id", "html")
    assert archives.page_tables(nodes, "id").first().cells == ["A", "b\nc"]
    assert tuple(archives.page_links(nodes, "id").select("href", "text").first()) == ("/x", "go")


def test_json_lines_keep_their_fields(spark):
    lines = spark.createDataFrame([(0, '{"lat": 33.5, "lon": 133, "k": [1]}'), (1, "  ")], "ord int, value string")
    got = records.with_fields(records.point_lines(lines).withColumn("elevation_m", F.lit(None).cast("float")), "elevation_m").first()
    assert got.value == '{"lat": 33.5, "lon": 133, "k": [1],"elevation_m":null}'
    with pytest.raises(Exception, match="line 1"):
        records.point_lines(spark.createDataFrame([(0, '{"lat": "x"}')], "ord int, value string")).collect()


def test_raw_raster_begins_at_the_least_tile(spark, tmp_path):
    cells = spark.createDataFrame([(3, 7, 0, 0, 10), (4, 8, 255, 255, 20)], "tile_x long, tile_y long, px int, py int, meters int")
    shape = records.raw_raster(cells, str(tmp_path / "r.raw"))
    import numpy as np

    data = np.fromfile(tmp_path / "r.raw", "<i2").reshape(shape["height"], shape["width"])
    assert (data[0, 0], data[511, 511], data[0, 511]) == (10, 20, -32768)
    assert "EPSG:4326" in records.vrt("r.raw", shape, {"origin_lat": 34.0, "origin_lon": 133.0, "step_lat": 0.1, "step_lon": 0.1})
    with pytest.raises(FileExistsError):
        records.raw_raster(cells, str(tmp_path / "r.raw"))


def test_stream_of_points(spark, tmp_path):
    from geoloom.streaming import points

    grid = {"origin_lat": 34.0, "origin_lon": 133.0, "step_lat": 0.5, "step_lon": 0.5}
    cells = spark.createDataFrame([(5, 0, 0, 0, 0, 7, 4)], "layer int, tile_x long, tile_y long, px long, py long, meters int, source_code int")
    spark.createDataFrame([(1, 33.75, 133.25)], "id int, lat double, lon double").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id int, lat double, lon double").parquet(str(tmp_path / "in"))
    points.start(stream, cells, grid, grid, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select("id", "elevation_m").collect()] == [(1, 7.0)]
