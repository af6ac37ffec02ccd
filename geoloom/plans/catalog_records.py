"""Queries over records: maps' tables, trails, manifests, reports, texts, exports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo, text
from ..operators import linking, lodging, osm, reports, styles, trail
from ..sources import exports, records
from .projections import read
from .registry import query

# Maps' tables.


def _objects(spark, d):
    """Orders as tagged objects: places of worship, some numbered, and lodgings of known and unknown kinds."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    number = (c % 99).cast("string")
    tail = F.when(k % 11 == 0, " 別格").when(k % 7 == 0, "観音堂").otherwise("")
    name = F.when(k % 4 == 0, F.concat(F.lit("第"), F.when(k % 8 == 0, F.translate(number, "0123456789", "０１２３４５６７８９")).otherwise(number), F.lit("番札所"), tail)).otherwise(F.col("o_orderpriority"))
    kind = F.when(k % 5 == 0, "hotel").when(k % 5 == 1, "hostel").when(k % 5 == 2, " castle ").when(k % 5 == 3, "")
    tags = F.map_filter(F.create_map(F.lit("amenity"), F.when(k % 2 == 0, "place_of_worship").otherwise("bar"), F.lit("name"), name, F.lit("tourism"), kind, F.lit("religion"), F.when(k % 3 == 0, "buddhist").otherwise("shinto")), lambda _, v: v.isNotNull())
    return read(spark, d, "orders").select(k.alias("id"), tags.alias("tags"))


_OBJECTS_SQL = """o AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN 'place_of_worship' ELSE 'bar' END AS amenity, CASE WHEN o_orderkey % 3 = 0 THEN 'buddhist' ELSE 'shinto' END AS religion,
CASE o_orderkey % 5 WHEN 0 THEN 'hotel' WHEN 1 THEN 'hostel' WHEN 2 THEN 'castle' END AS tourism, CAST(o_custkey % 99 AS INT) AS number,
'第' || CASE WHEN o_orderkey % 8 = 0 THEN translate(CAST(o_custkey % 99 AS VARCHAR), '0123456789', '０１２３４５６７８９') ELSE CAST(o_custkey % 99 AS VARCHAR) END || '番札所' || CASE WHEN o_orderkey % 11 = 0 THEN ' 別格' WHEN o_orderkey % 7 = 0 THEN '観音堂' ELSE '' END AS name FROM orders),
cand AS (SELECT id, number, name, o.id % 11 = 0 AS noise, o.id % 11 <> 0 AND o.id % 7 = 0 AS hall, o.id % 8 = 0 AS wide FROM o WHERE id % 4 = 0)"""


@query(f"WITH {_OBJECTS_SQL} SELECT * FROM cand")
def temple_candidates(spark, d):
    return osm.temple_candidates(_objects(spark, d))


def _relations(spark, d):
    p = F.col("p_partkey")
    name = F.concat(F.lit("四国遍路 "), (p % 30).cast("string"), F.lit("番札所甲~"), (p % 30 + 60).cast("string"), F.lit("番札所乙"))
    tags = F.create_map(F.lit("type"), F.lit("route"), F.lit("route"), F.when(p % 2 == 0, "hiking").otherwise("bus"), F.lit("name"), F.when(p % 3 == 0, F.col("p_name")).otherwise(name))
    return read(spark, d, "part").select(p.alias("id"), tags.alias("tags"))


_SEGMENTS_SQL = "seg AS (SELECT CAST(p_partkey % 30 AS INT) AS from_number, CAST(p_partkey % 30 + 60 AS INT) AS to_number, '甲' AS from_name, '乙' AS to_name, max(p_partkey) AS relation_id FROM part WHERE p_partkey % 2 = 0 AND p_partkey % 3 <> 0 GROUP BY 1, 2)"


@query(f"""WITH {_OBJECTS_SQL}, {_SEGMENTS_SQL} SELECT seg.*, CASE WHEN from_number IN (SELECT number FROM cand WHERE NOT noise) THEN 'ok' ELSE 'MISSING' END AS from_status,
CASE WHEN to_number IN (SELECT number FROM cand WHERE NOT noise) THEN 'ok' ELSE 'MISSING' END AS to_status FROM seg""")
def segment_status(spark, d):
    return osm.segment_status(osm.route_segments(_relations(spark, d)), osm.temple_candidates(_objects(spark, d)))


@query(f"""WITH {_OBJECTS_SQL}, {_SEGMENTS_SQL} SELECT (SELECT count(*) FROM o WHERE amenity = 'place_of_worship') AS worship, (SELECT count(*) FROM o WHERE amenity = 'place_of_worship' AND religion = 'buddhist') AS buddhist,
count(*) AS candidates, count(DISTINCT number) AS numbers, count(*) FILTER (noise) AS noise, (SELECT count(*) FROM part WHERE p_partkey % 2 = 0) AS routes, (SELECT count(*) FROM seg) AS segments FROM cand""")
def worship_inventory(spark, d):
    return osm.inventory(_objects(spark, d), _relations(spark, d))


@query(f"WITH {_OBJECTS_SQL} SELECT id, 'unknown tourism subtype: castle' AS warning FROM o WHERE tourism = 'castle'")
def subtype_warnings(spark, d):
    return osm.subtype_warnings(_objects(spark, d))


@query("""SELECT count(*) AS total, count(*) FILTER (o_orderkey % 3 = 0) AS nodes, count(*) FILTER (o_orderkey % 3 = 1) AS ways, count(*) FILTER (o_orderkey % 3 = 2) AS relations, count(*) FILTER (o_orderkey % 4 = 0) AS missing_name, count(*) FILTER (o_orderkey % 6 = 0) AS missing_coordinate,
count(*) FILTER (o_orderkey % 5 <> 0) AS missing_phone, count(*) FILTER (o_orderkey % 7 < 2) AS missing_website, count(*) FILTER (o_orderkey % 8 = 0 OR o_orderkey % 9 = 0) AS with_laundry_tags, count(*) FILTER (o_orderkey % 10 = 0) AS with_internet_tags, 'castle,inn' AS unknown_subtypes FROM orders""")
def lodging_stats(spark, d):
    k = F.col("o_orderkey")
    on = lambda c, v: F.when(c, v)
    rows = read(spark, d, "orders").select(
        F.when(k % 3 == 0, "node").when(k % 3 == 1, "way").otherwise("relation").alias("kind"), F.when(k % 9 == 4, "castle").when(k % 9 == 5, "inn").when(k % 9 < 4, "hotel").alias("subtype"), on(k % 4 != 0, "x").alias("name"),
        on(k % 6 != 0, F.lit(33.0)).alias("lat"), F.lit(133.0).alias("lon"), on(k % 5 == 0, "1").alias("phone"), F.when(k % 7 == 0, "").when(k % 7 > 1, "w").alias("website"), on(k % 8 == 0, True).alias("washing_machine"), on(k % 9 == 0, False).alias("dryer"), on(k % 10 == 0, "yes").alias("internet_access"), F.lit("").alias("wifi"),
    )
    return osm.lodging_stats(rows)


def _ways(spark, d):
    """Suppliers as ways; every fourth has one point only."""
    k = F.col("s_suppkey")
    at = lambda n: F.struct((F.lit(133.0) + (k + n) / F.lit(64.0)).alias("lon"), F.lit(33.0).alias("lat"))
    return read(spark, d, "supplier").select(k.alias("id"), F.when(k % 4 == 0, F.array(at(0))).otherwise(F.array(at(0), at(1))).alias("coords"))


def _routes(spark, d):
    """Orders as relations whose members are their lines' suppliers; some are nodes."""
    member = F.struct(F.when(F.col("l_linenumber") == 3, "n").otherwise("w").alias("type"), (F.col("l_suppkey") * 2).alias("ref"), F.col("l_returnflag").alias("role"))
    lines = read(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_returnflag", member.alias("m")))), lambda s: s.m).alias("members"))
    tags = F.create_map(F.lit("type"), F.lit("route"), F.lit("route"), F.when(F.col("id") % 3 == 0, "bus").otherwise("hiking"), F.lit("ref"), F.col("id").cast("string"))
    return lines.withColumn("tags", tags)


@query("SELECT s_suppkey AS id FROM supplier WHERE s_suppkey IN (SELECT l_suppkey * 2 FROM lineitem WHERE l_linenumber <> 3)")
def needed_ways(spark, d):
    return osm.needed_ways(_ways(spark, d), _routes(spark, d)).select("id")


@query("""SELECT l_orderkey AS relation_id, CAST(l_orderkey AS VARCHAR) AS ref, l_suppkey * 2 AS way_id, l_returnflag AS role, 2 AS points FROM lineitem JOIN supplier ON s_suppkey = l_suppkey * 2 WHERE l_linenumber <> 3 AND l_orderkey % 3 <> 0 AND s_suppkey % 4 <> 0""")
def route_layer(spark, d):
    return osm.route_lines(_routes(spark, d), _ways(spark, d)).select("relation_id", "ref", "way_id", "role", F.size("coords").alias("points"))


@query("""SELECT l_orderkey AS id, count(s_suppkey) AS found, count(*) FILTER (s_suppkey IS NULL) AS missing, coalesce(string_agg(l_returnflag, '' ORDER BY l_linenumber, l_returnflag) FILTER (s_suppkey IS NOT NULL), '') AS roles FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey * 2 WHERE l_linenumber <> 3 GROUP BY 1""")
def relation_parts(spark, d):
    parts = osm.relation_parts(_routes(spark, d), _ways(spark, d))
    return parts.select("id", "found", "missing", F.array_join(F.transform("parts", lambda p: p.role), "").alias("roles"))


# Trails.


def _courses(spark, d):
    """Orders as courses: a line of three points and points named after lines, spots, and photo titles."""
    lines = read(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda s: (s.l_partkey % 5).cast("string")).alias("names"))
    at = lambda a, b: F.array(F.lit(a), F.lit(b))
    shape = lambda kind, *c: F.array(F.struct(F.lit(kind).alias("kind"), F.array(*c).alias("coordinates")))
    route = F.struct(F.lit("line").alias("name"), shape("LineString", at(133.0, 33.0), at(133.1, 33.0), at(133.2, 33.1)).alias("geometry"))
    marks = F.transform("names", lambda n: F.struct(n.alias("name"), shape("Point", at(133.5, 33.5)).alias("geometry")))
    spots = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.struct(i.cast("string").alias("number"), i.cast("string").alias("title")))
    return read(spark, d, "orders").join(lines, "o_orderkey").select(F.col("o_orderkey").alias("source_post_id"), F.col("o_orderpriority").alias("prefecture"), F.col("o_orderpriority").alias("name"), spots.alias("spots"), F.when(F.col("o_orderkey") % 2 == 0, (F.col("o_custkey") % 5).cast("string")).alias("photo_title"), F.concat(F.array(route), marks).alias("placemarks"))


_COUNTERS_SQL = """WITH p AS (SELECT l_orderkey, l_partkey % 5 AS k, count(*) AS n FROM lineitem GROUP BY 1, 2), c AS (SELECT o_orderkey, o_orderpriority AS prefecture, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey % 5 END AS photo, sum(n) AS pois,
count(*) FILTER (n = 1 AND k < 4) AS linked, count(*) FILTER (n > 1) AS ambiguous FROM orders JOIN p ON l_orderkey = o_orderkey GROUP BY 1, 2, 3),
t AS (SELECT prefecture, count(*) AS courses, count(*) AS route_segments, count(*) * 3 AS route_coordinate_points, CAST(sum(pois) AS BIGINT) AS kml_pois, count(*) * 4 AS tourism_spots, CAST(sum(ambiguous) AS BIGINT) AS ambiguous_names, count(photo) AS photo_points,
CAST(sum(CASE WHEN EXISTS (SELECT 1 FROM p WHERE p.l_orderkey = c.o_orderkey AND p.k = c.photo AND p.n = 1) THEN 1 ELSE 0 END) AS BIGINT) AS matched_photo_points, CAST(sum(linked) AS BIGINT) AS linked_tourism_spots, CAST(count(*) * 4 - sum(linked) AS BIGINT) AS unmatched_tourism_spots,
CAST(sum(pois) - sum(linked) AS BIGINT) AS unmatched_pois FROM c GROUP BY ROLLUP (prefecture))"""


@query(f"{_COUNTERS_SQL} SELECT * FROM t")
def trail_totals(spark, d):
    return trail.counters(_courses(spark, d))


@query(f"{_COUNTERS_SQL}, x AS (SELECT *, CASE WHEN courses % 2 = 0 THEN 1 ELSE 0 END AS odd FROM t) SELECT 'points' AS rule, count(*) AS n FROM x WHERE odd = 1 HAVING count(*) > 0")
def trail_accounting(spark, d):
    """Counters, spoilt where the number of courses is even, against their identities."""
    rows = trail.counters(_courses(spark, d))
    return reports.accounting(rows.withColumn("route_coordinate_points", F.when(F.col("courses") % 2 == 0, F.col("route_segments")).otherwise(F.col("route_coordinate_points"))))


@query("""SELECT 'SNT_' || o_orderkey || '_L001' AS segment_id, 'SNT_' || o_orderkey AS route_id, 1 AS seg, 1 AS seg_count, 3 AS points FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)""")
def trail_segments(spark, d):
    return trail.segments(trail.checked(_courses(spark, d))).select("segment_id", "route_id", "seg", F.col("seg_count").cast("int").alias("seg_count"), F.size("coordinates").alias("points"))


@query("""WITH p AS (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_partkey % 5) AS n, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS rn FROM lineitem)
SELECT 'SNT_' || l_orderkey || '_P' || lpad(CAST(rn AS VARCHAR), 4, '0') AS id, CAST(l_partkey % 5 AS VARCHAR) AS name, CASE WHEN n = 1 AND l_partkey % 5 < 4 THEN 'tourism_spot' ELSE 'kml_poi' END AS kind FROM p JOIN orders ON o_orderkey = l_orderkey""")
def trail_pois(spark, d):
    return trail.poi_features(_courses(spark, d)).select("id", "name", "kind")


@query("SELECT count(*) AS course_count, count(*) FILTER (o_orderkey % 2 = 0) AS photo_point_count, count(*) * 4 AS tourism_spot_count, (SELECT count(*) FROM lineitem) + count(*) AS placemark_count, (SELECT count(*) FROM events) AS warning_count FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)")
def dataset_summary(spark, d):
    rows = _courses(spark, d).select(F.col("photo_title").alias("photo_point"), F.col("spots").alias("tourism_spots"), "placemarks")
    return reports.dataset_summary(rows, read(spark, d, "events"))


@query("SELECT o_orderpriority AS prefecture, CAST(o_custkey AS VARCHAR) AS route_id, max(o_orderkey) AS ord FROM orders GROUP BY 1, 2")
def latest_routes(spark, d):
    return linking.latest_routes(read(spark, d, "orders").select(F.col("o_orderpriority").alias("prefecture"), F.col("o_custkey").cast("string").alias("route_id"), F.col("o_orderkey").alias("ord")))


@query("""SELECT o_orderkey AS course_id, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'p' END AS page_sha256, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 't' END AS track_sha256, CASE WHEN o_orderkey % 3 = 0 THEN 'missing_page' WHEN o_orderkey % 4 = 0 THEN 'missing_track' ELSE 'complete' END AS state FROM orders""")
def trail_manifest(spark, d):
    k = read(spark, d, "orders").select(F.col("o_orderkey").alias("course_id"))
    return linking.trail_manifest(k, k.where("course_id % 3 <> 0").withColumn("sha256", F.lit("p")), k.where("course_id % 4 <> 0").withColumn("sha256", F.lit("t")))


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS id, 'course is not in the manifest' AS rule FROM orders WHERE o_orderkey % 5 = 0 UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'track checksum differs' FROM orders WHERE o_orderkey % 5 <> 0 AND o_orderkey % 4 <> 0 AND o_orderkey % 7 = 0
UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'track has no line' FROM orders WHERE o_orderkey % 4 <> 0 AND o_orderkey % 9 = 0""")
def trail_violations(spark, d):
    k = read(spark, d, "orders").select(F.col("o_orderkey").alias("course_id"))
    kept = k.where("course_id % 5 <> 0").withColumn("track_sha256", F.lit("t"))
    tracks = k.where("course_id % 4 <> 0").select("course_id", F.when(F.col("course_id") % 7 == 0, "u").otherwise("t").alias("sha256"), (F.col("course_id") % 9).alias("line_count"))
    return linking.trail_violations(k, kept, tracks)


# Manifests, records and reports.


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE 'f' || CAST(l_partkey + 1000 AS VARCHAR) END AS local_path FROM lineitem""")
def image_files(spark, d):
    images = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("url"))
    part = read(spark, d, "part").where("p_partkey % 3 <> 0")
    assets = part.select(F.explode(F.array(F.lit(0), F.lit(1))).alias("ord"), F.col("p_partkey").alias("url")).withColumn("path", F.concat(F.lit("f"), (F.col("url") + 1000 * F.col("ord")).cast("string")))
    return linking.with_files(images, assets).select("l_orderkey", "l_linenumber", "local_path")


@query("SELECT o_orderkey AS source_id, c_mktsegment AS retrieved_at FROM orders LEFT JOIN customer ON c_custkey = o_orderkey")
def retrieval_times(spark, d):
    manifest = read(spark, d, "customer").select(F.col("c_custkey").alias("source_id"), F.col("c_mktsegment").alias("retrieved_at"))
    return linking.with_retrieval(read(spark, d, "orders").select(F.col("o_orderkey").alias("source_id")), manifest)


@query("""SELECT o_orderkey AS url, CASE WHEN o_orderkey % 4 = 0 THEN sha256(o_orderpriority) WHEN o_orderkey % 3 = 0 THEN 'old' ELSE 'new' END AS sha256, CASE WHEN o_orderkey % 3 = 0 THEN 'fetched' ELSE 'skipped' END AS status FROM orders""")
def refreshed_manifest(spark, d):
    o, k = read(spark, d, "orders"), F.col("o_orderkey")
    old = o.select(k.alias("url"), F.lit("old").alias("sha256"), F.lit("fetched").alias("status"))
    new = o.select(k.alias("url"), F.when(k % 3 != 0, "new").alias("sha256"), F.when(k % 3 == 0, "failed").otherwise("skipped").alias("status"))
    return linking.refreshed_manifest(old, new, o.where(k % 4 == 0).select(k.alias("url"), F.col("o_orderpriority").cast("binary").alias("content")))


@query("""SELECT count(*) AS records, count(*) FILTER (p_partkey % 3 = 0) AS with_detail, count(*) FILTER (p_partkey % 3 <> 0) AS without_detail, count(*) FILTER (p_size < 20) AS temple, count(*) FILTER (p_size >= 20) AS route, count(DISTINCT p_type) AS distinct_names,
(SELECT count(*) FROM (SELECT p_type FROM part GROUP BY 1 HAVING count(*) > 1)) AS repeated_names, (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM part GROUP BY p_type HAVING count(*) > 1)) AS repeated_listings FROM part""")
def record_stats(spark, d):
    rows = read(spark, d, "part").select(F.col("p_type").alias("name"), F.col("p_brand").alias("prefecture"), F.when(F.col("p_size") < 20, "temple").otherwise("route").alias("table_kind"), (F.col("p_partkey") % 3 == 0).alias("has_detail"))
    return reports.record_stats(rows)


@query("""SELECT count(*) AS record_count, count(DISTINCT o_orderpriority) AS prefectures, count(*) FILTER (o_orderkey % 9 = 0) AS closure_marker_count, (SELECT string_agg(CAST(n AS VARCHAR), ',' ORDER BY n) FROM (SELECT DISTINCT 1 + o_custkey % 88 AS n FROM orders WHERE o_orderkey % 2 = 0)) AS temple_numbers FROM orders""")
def manifest_summary(spark, d):
    k = F.col("o_orderkey")
    return reports.manifest_summary(read(spark, d, "orders").select(F.col("o_orderpriority").alias("prefecture"), F.when(k % 9 == 0, "closed").when(k % 9 == 1, "").alias("closure_marker"), F.when(k % 2 == 0, 1 + F.col("o_custkey") % 88).alias("temple_number")))


@query("SELECT count(*) FILTER (o_orderstatus = 'F') AS \"F\", count(*) FILTER (o_orderstatus = 'O') AS \"O\", count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) AS other FROM orders")
def status_counts(spark, d):
    return reports.status_counts(read(spark, d, "orders").withColumnRenamed("o_orderstatus", "status"), "F", "O")


@query("""SELECT mesh, count(*) AS rasters, CAST(sum(s) AS BIGINT) AS stored, CAST(sum(w * 3) AS BIGINT) AS cells, count(*) FILTER (s <> w * 3) AS partial FROM (SELECT lpad(CAST(s_nationkey AS VARCHAR), 8, '0') AS mesh, s_suppkey % 13 AS s, s_suppkey % 5 AS w FROM supplier) GROUP BY ROLLUP (mesh)""")
def archive_listing(spark, d):
    rows = read(spark, d, "supplier").select(F.format_string("%08d", F.col("s_nationkey")).alias("mesh"), (F.col("s_suppkey") % 13).alias("stored"), (F.col("s_suppkey") % 5).alias("width"), F.lit(3).alias("height"))
    return reports.archive_listing(rows)


@query("""WITH x AS (SELECT s_suppkey, CASE WHEN s_suppkey % 10 = 0 THEN 'x' || CAST(s_suppkey AS VARCHAR) ELSE CAST(s_suppkey * 37 % 1009 AS VARCHAR) END AS id FROM supplier) SELECT s_suppkey, id, CAST(row_number() OVER (ORDER BY TRY_CAST(id AS BIGINT) NULLS LAST, id) AS INT) AS place FROM x""")
def numeric_order(spark, d):
    k = F.col("s_suppkey")
    return reports.by_number(read(spark, d, "supplier").select("s_suppkey", F.when(k % 10 == 0, F.concat(F.lit("x"), k.cast("string"))).otherwise((k * 37 % 1009).cast("string")).alias("id")), "id", "s_suppkey")


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS id, 'source url does not match the id' AS rule FROM orders WHERE o_orderkey % 10 = 0 UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'temple number is not of 1 to 88' FROM orders WHERE o_custkey % 100 NOT BETWEEN 1 AND 88 AND o_orderkey % 3 <> 0
UNION ALL SELECT NULL, 'a prefecture is missing' UNION ALL SELECT NULL, 'detail counts differ from the index'""")
def index_violations(spark, d):
    k = F.col("o_orderkey")
    rows = read(spark, d, "orders").select(k.alias("source_id"), k.cast("string").alias("canonical_url"), F.when(k % 10 != 0, k.cast("string")).alias("source_url"), k.alias("list_order"), F.col("o_orderpriority").alias("prefecture"), F.when(k % 3 != 0, F.col("o_custkey") % 100).alias("temple_number"))
    return lodging.index_violations(rows, ("1-URGENT", "none"), {"fetched": 3})


@query("""SELECT count(*) FILTER (json_extract_string(props, '$.page') <> '') AS page, count(*) FILTER (json_extract_string(props, '$.nothing') <> '') AS nothing FROM events""")
def field_coverage(spark, d):
    rows = read(spark, d, "events").select(F.from_json("props", "map<string,string>").alias("props"))
    return reports.field_coverage(rows, "props", ["page", "nothing"])


# Styles and exports.


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE (l_partkey % 50) * 20 % 100 = 0")
def index_contours(spark, d):
    return styles.index_contours(read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", ((F.col("l_partkey") % 50) * 20).alias("elevation_m"))).drop("elevation_m")


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'red' WHEN 'O' THEN 'blue' ELSE 'grey' END AS colour, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority ELSE '' END AS label FROM orders WHERE o_custkey % 20 IN (3, 7)")
def style_features(spark, d):
    rows = read(spark, d, "orders").select("o_orderkey", "o_orderstatus", (F.col("o_custkey") % 20).cast("string").alias("route_id"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority")).alias("name"))
    return styles.of_routes(rows, "3", "7").select("o_orderkey", styles.matched(F.col("o_orderstatus"), {"F": "red", "O": "blue"}, "grey").alias("colour"), styles.label("name").alias("label"))


@query("""SELECT min(o_orderkey) AS ord, '{"type":"Feature","geometry":{"type":"Point","coordinates":[133.5,33.25]},"properties":{"place_id":"' || CAST(o_custkey AS VARCHAR) || '","phone":null}}' AS feature FROM orders WHERE o_orderkey % 3 = 0 AND o_custkey % 7 <> 0 GROUP BY o_custkey""")
def point_features(spark, d):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    rows = read(spark, d, "orders").select(k.alias("ord"), F.when(k % 3 == 0, "resolved").otherwise("pending").alias("status"), c.cast("string").alias("place_id"), F.when(c % 7 == 0, "x").otherwise("33.25").alias("lat"), F.lit("133.5").alias("lon"), F.lit(None).cast("string").alias("phone"))
    return exports.map_points(rows, "place_id", "phone")


@query("""SELECT CAST(n_nationkey AS BIGINT) AS ord, '{"a":null,"n_name":"' || n_name || '","n_nationkey":' || CAST(n_nationkey AS VARCHAR) || '}' AS value FROM nation""")
def sorted_json(spark, d):
    rows = read(spark, d, "nation").select(F.col("n_nationkey"), F.col("n_name"), F.lit(None).cast("string").alias("a"))
    return exports.sorted_json(rows).select(F.get_json_object("value", "$.n_nationkey").cast("long").alias("ord"), "value")


@query("""SELECT event_id AS ord, 33e0 + (event_id % 64) / 64e0 AS lat, 133e0 + (event_id % 32) / 32e0 AS lon, '{"lat":' || CAST(33e0 + (event_id % 64) / 64e0 AS VARCHAR) || ',"lon":' || CAST(133e0 + (event_id % 32) / 32e0 AS VARCHAR) || ',"id":' || CAST(event_id AS VARCHAR) || ',"elevation_m":' || CASE WHEN event_id % 2 = 0 THEN '7' ELSE 'null' END || '}' AS value FROM events""")
def point_lines(spark, d):
    k = F.col("event_id")
    lat, lon = F.lit(33.0) + (k % 64) / F.lit(64.0), F.lit(133.0) + (k % 32) / F.lit(32.0)
    line = F.concat(F.lit('{"lat":'), lat.cast("string"), F.lit(',"lon":'), lon.cast("string"), F.lit(',"id":'), k.cast("string"), F.lit("} "))
    rows = records.point_lines(read(spark, d, "events").select(k.alias("ord"), line.alias("value")))
    return records.with_fields(rows.withColumn("elevation_m", F.when(F.col("ord") % 2 == 0, 7)), "elevation_m").select("ord", "lat", "lon", "value")


# Texts.

_K = "o_orderkey"


def _built(spark, d, **columns):
    return read(spark, d, "orders").select(_K, *[c.alias(n) for n, c in columns.items()])


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN printf('%04d-%02d-%02d', 2000 + o_orderkey % 30, 1 + o_orderkey % 12, 1 + o_orderkey % 28) END AS modified, o_orderkey % 4 < 2 AS known, CASE o_orderkey % 4 WHEN 0 THEN true WHEN 1 THEN false END AS flag, CASE WHEN o_orderkey % 4 = 3 THEN 'maybe' END AS other FROM orders""")
def dates_and_flags(spark, d):
    k = F.col(_K)
    date = F.concat((2000 + k % 30).cast("string"), F.when(k % 3 == 0, "年 ").otherwise("/"), (1 + k % 12).cast("string"), F.when(k % 3 == 0, "月").otherwise("/"), (1 + k % 28).cast("string"), F.when(k % 3 == 0, "日更新").otherwise(""))
    word = F.when(k % 4 == 0, F.when(k % 8 == 0, " True").otherwise("1")).when(k % 4 == 1, F.when(k % 8 == 1, "NO ").otherwise("0")).when(k % 4 == 3, " maybe ")
    got = _built(spark, d, m=text.modified_date(date), y=text.yes_no_or_text(word))
    return got.select(_K, F.col("m").alias("modified"), F.col("y.flag").isNotNull().alias("known"), F.col("y.flag").alias("flag"), F.col("y.text").alias("other"))


@query("""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN '.png' WHEN 1 THEN '.webp' ELSE '.jpg' END AS ending FROM orders""")
def image_endings(spark, d):
    k = F.col(_K)
    kind = F.when(k % 4 == 0, "Image/PNG; q=1").when(k % 4 == 2, "text/html")
    return _built(spark, d, ending=text.image_ending(kind, F.when(k % 4 == 1, "http://h/a.WebP?x=.gif").when(k % 4 == 2, "http://h.png/b").otherwise("http://h/c.bmp")))


@query("""SELECT o_orderkey, CAST(1 + o_orderkey % 5 + 2 AS INT) AS rooms, '和室,洋室' AS kinds, CAST(9 AS INT) AS total, CAST(o_orderkey % 30 AS INT) AS spaces, CASE WHEN o_orderkey % 2 = 0 THEN 'free' ELSE 'paid' END AS fee, CASE WHEN o_orderkey % 3 = 0 THEN false WHEN o_orderkey % 3 = 1 THEN true END AS booked FROM orders""")
def rooms_and_parking(spark, d):
    k = F.col(_K)
    n = F.translate((1 + k % 5).cast("string"), "0123456789", "０１２３４５６７８９")
    raw = F.concat(F.lit("和室"), n, F.lit("部屋、洋室2室"))
    park = F.concat((k % 30).cast("string"), F.lit("台（"), F.when(k % 2 == 0, "無料").otherwise("有料"), F.when(k % 3 == 0, "・予約不要").when(k % 3 == 1, "・要予約").otherwise(""), F.lit("）"))
    got = _built(spark, d, r=text.rooms(raw), t=text.rooms_with_total(F.concat(F.lit("全9室 うち"), raw), F.lit("")), p=text.parking(park))
    return got.select(_K, F.col("r.room_count").alias("rooms"), F.array_join("r.types", ",").alias("kinds"), F.col("t.room_count").alias("total"), F.col("p.space_count").alias("spaces"), F.col("p.fee_status").alias("fee"), F.col("p.reservation_required").alias("booked"))


@query("""SELECT o_orderkey, true AS breakfast, '07:00' AS at, o_orderkey % 2 = 0 AS dinner, CASE WHEN o_orderkey % 2 = 0 THEN '18:30' END AS dinner_at, CASE WHEN o_orderkey % 3 = 0 THEN 'cash,card' ELSE 'cash' END AS methods, CASE WHEN o_orderkey % 3 = 0 THEN 'VISA,JCB' ELSE '' END AS cards FROM orders""")
def meals_and_payment(spark, d):
    k = F.col(_K)
    meal = F.concat(F.lit("朝食７：00〜"), F.when(k % 2 == 0, " 夕食 18:30").otherwise(""))
    pay = F.concat(F.lit("現金"), F.when(k % 3 == 0, "、カード（ viza / JCB）").otherwise("のみ"))
    got = _built(spark, d, m=text.meals(F.regexp_replace(meal, "〜", "")), p=text.payment(pay))
    return got.select(_K, F.col("m.breakfast.available").alias("breakfast"), F.col("m.breakfast.time").alias("at"), F.col("m.dinner.available").alias("dinner"), F.col("m.dinner.time").alias("dinner_at"), F.array_join("p.methods", ",").alias("methods"), F.array_join("p.cards", ",").alias("cards"))


@query("""SELECT o_orderkey, CAST(1 + o_orderkey % 88 AS INT) AS a, '甲寺' AS b, CAST(1 + o_custkey % 88 AS INT) AS c, '乙寺' AS d, CASE WHEN o_orderkey % 2 = 0 THEN 'ガパ' ELSE 'カハ' END AS kana, nullif(o_orderkey % 4, 0) AS stars, (o_orderkey % 50) / 10e0 AS km FROM orders""")
def routes_and_marks(spark, d):
    k = F.col(_K)
    line = F.concat((1 + k % 88).cast("string"), F.lit("番 甲寺から"), (1 + F.col("o_custkey") % 88).cast("string"), F.lit("番乙寺 へのお宿"))
    kana = F.when(k % 2 == 0, "ｶﾞﾊﾟ").otherwise("ｶﾊ")
    got = _built(spark, d, r=text.route(line), kana=text.normalize_half_kana(kana), stars=text.star_count(F.repeat(F.lit("★"), (k % 4).cast("int"))), km=text.distance_km(F.concat(((k % 50) / 10.0).cast("string"), F.lit("㎞"))))
    return got.select(_K, F.col("r.from_temple.number").alias("a"), F.col("r.from_temple.name").alias("b"), F.col("r.to_temple.number").alias("c"), F.col("r.to_temple.name").alias("d"), "kana", F.col("stars").cast("long").alias("stars"), "km")


@query("""SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 4 WHEN 1 THEN 3 WHEN 2 THEN 2 WHEN 3 THEN 1 END AS code, CASE p_partkey % 5 WHEN 0 THEN 'DEM5A' WHEN 1 THEN 'DEM5B' WHEN 2 THEN 'DEM5C' WHEN 3 THEN 'DEM10B' ELSE 'nodata' END AS label, '&lt;b&gt;&amp;' || CAST(p_partkey AS VARCHAR) AS escaped, p_partkey % 2 = 0 AS allowed FROM part""")
def sources_and_hosts(spark, d):
    k = F.col("p_partkey")
    name = F.concat(F.lit("x-"), F.element_at(F.array(*[F.lit(x) for x in ("dem5a", "DEM5B", "Dem5c", "DEM10B", "other")]), (k % 5 + 1).cast("int")), F.lit(".xml"))
    code = text.source_code_of(name)
    url = F.concat(F.lit("https://"), F.when(k % 2 == 0, "Maps.Example.com").otherwise("other.example"), F.lit("/p?q=1"))
    return read(spark, d, "part").select("p_partkey", code.cast("int").alias("code"), text.source_label(code).alias("label"), text.escaped(F.concat(F.lit("<b>&"), k.cast("string"))).alias("escaped"), text.host_allowed(url, ("maps.example.com",)).alias("allowed"))


@query("""SELECT doc, ord, last_value(prefecture IGNORE NULLS) OVER (PARTITION BY doc ORDER BY ord) AS prefecture, last_value(temple IGNORE NULLS) OVER (PARTITION BY doc, p ORDER BY ord) AS temple FROM (
SELECT *, count(prefecture) OVER (PARTITION BY doc ORDER BY ord) AS p FROM (SELECT user_id AS doc, event_id AS ord, CASE WHEN event_type = 'click' THEN event_id END AS prefecture, CASE WHEN event_type = 'view' THEN event_id END AS temple FROM events))""")
def latest_context(spark, d):
    nodes = read(spark, d, "events").select(F.col("user_id").alias("doc"), F.col("event_id").alias("ord"), F.when(F.col("event_type") == "click", F.col("event_id")).alias("prefecture"), F.when(F.col("event_type") == "view", F.col("event_id")).alias("temple"))
    return linking.latest_context(nodes).select("doc", "ord", "prefecture", "temple")


@query("""SELECT p_partkey FROM part WHERE (SELECT count(*) FROM supplier WHERE CAST(s_suppkey % 97 AS VARCHAR) = CAST(p_partkey % 101 AS VARCHAR)) = 1""")
def matched_to_unique(spark, d):
    left = read(spark, d, "part").select("p_partkey", F.lit("s").alias("scope"), (F.col("p_partkey") % 101).cast("string").alias("key"))
    right = read(spark, d, "supplier").select(F.lit("s").alias("scope"), (F.col("s_suppkey") % 97).cast("string").alias("key"))
    return linking.matched_to_unique(left, right, "scope").select("p_partkey")


@query("""WITH c AS (SELECT c_custkey AS ord, c_custkey % 5 AS s FROM customer)
SELECT ord, CASE s WHEN 0 THEN 'resolved' WHEN 1 THEN 'place_ambiguous' WHEN 2 THEN 'place_outside' WHEN 3 THEN 'place_not_found' ELSE 'fetch_failed' END AS status, CASE WHEN s = 0 THEN 33.5 END AS lat FROM c""")
def geocoded_places(spark, d):
    k = F.col("c_custkey")
    rows = read(spark, d, "customer").select(k.alias("ord"), F.array(F.concat(F.lit("u"), k.cast("string"))).alias("candidates"))
    cache = read(spark, d, "customer").where(k % 5 < 4).select(F.sha2(F.concat(F.lit("u"), k.cast("string")), 256).alias("url_sha256"), F.lit(False).alias("failed"), F.when(k % 5 == 1, 2).when(k % 5 == 3, 0).otherwise(1).alias("place_count"), F.when(k % 5 == 2, 50.0).otherwise(33.5).alias("lat"), F.lit(133.5).alias("lon"))
    return linking.geocoded(rows, cache, geo.in_region).select("ord", "status", "lat")
