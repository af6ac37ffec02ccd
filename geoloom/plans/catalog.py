"""Named queries over the driver's tables, and the SQL each must agree with."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import geo, text
from ..operators import elevation, linking, osm, profile, raster, reports
from ..sources import archives
from .projections import CELLS_SQL, COARSE_GRID, FINE_GRID, POINTS_SQL, elev_cells, points, read
from .registry import QUERIES, SQL, query  # noqa: F401


@query(f"""WITH {POINTS_SQL}, g AS (SELECT point_id, CAST(floor((33.75e0 - lat) * 512) AS BIGINT) AS gy, CAST(floor((lon - 133.25e0) * 512) AS BIGINT) AS gx, lat, lon FROM pts)
SELECT point_id, CAST(floor(gx / 256e0) AS BIGINT) AS tile_x, CAST(floor(gy / 256e0) AS BIGINT) AS tile_y, CAST(((gx % 256) + 256) % 256 AS INT) AS px,
CAST(((gy % 256) + 256) % 256 AS INT) AS py, lat BETWEEN 33.25 AND 33.75 AND lon BETWEEN 133.25 AND 133.75 AS inside FROM g""")
def tile_address(spark, d):
    y, x = geo.global_cell(F.col("lat"), F.lit(33.75), F.lit(1 / 512), True), geo.global_cell(F.col("lon"), F.lit(133.25), F.lit(1 / 512), False)
    inside = geo.within(F.col("lat"), F.col("lon"), 33.25, 33.75, 133.25, 133.75)
    return points(spark, d).select("point_id", geo.tile_of(x).alias("tile_x"), geo.tile_of(y).alias("tile_y"), geo.in_tile(x).alias("px"), geo.in_tile(y).alias("py"), inside.alias("inside"))


LOOKUP_SQL = f"""{POINTS_SQL}, {CELLS_SQL}, a AS (
  SELECT *, CAST(floor((34e0 - lat) * 512) AS BIGINT) AS y5, CAST(floor((lon - 133e0) * 512) AS BIGINT) AS x5,
         CAST(floor((34e0 - lat) * 256) AS BIGINT) AS y10, CAST(floor((lon - 133e0) * 256) AS BIGINT) AS x10 FROM pts
), found AS (
  SELECT point_id, lat, lon, CAST(coalesce(f.meters, c.meters) AS FLOAT) AS elevation_m, CAST(coalesce(f.layer, c.layer) AS INT) AS layer, coalesce(f.source_code, c.source_code) AS source_code
  FROM a LEFT JOIN cells f ON f.layer = 5 AND f.tile_x = x5 // 256 AND f.tile_y = y5 // 256 AND f.px = x5 % 256 AND f.py = y5 % 256
  LEFT JOIN cells c ON c.layer = 10 AND c.tile_x = x10 // 256 AND c.tile_y = y10 // 256 AND c.px = x10 % 256 AND c.py = y10 % 256
)"""


def _found(spark, d):
    return elevation.with_fallback(points(spark, d), elev_cells(spark, d), FINE_GRID, COARSE_GRID)


@query(f"WITH {LOOKUP_SQL} SELECT * FROM found")
def elev_point_fallback(spark, d):
    return _found(spark, d)


@query(f"""WITH {LOOKUP_SQL} SELECT point_id, elevation_m, expected_m, expected_layer, abs(elevation_m - expected_m) AS diff_m,
coalesce(abs(elevation_m - expected_m) <= CASE WHEN expected_layer = 'dem5' THEN 10 ELSE 20 END, false) AS ok FROM (
SELECT *, CAST((point_id * 13) % 1000 AS DOUBLE) AS expected_m, CASE WHEN point_id % 2 = 0 THEN 'dem5' ELSE 'dem10' END AS expected_layer FROM found)""")
def golden_check(spark, d):
    rows = _found(spark, d).withColumn("expected_m", ((F.col("point_id") * 13) % 1000).cast("double")).withColumn("expected_layer", F.when(F.col("point_id") % 2 == 0, "dem5").otherwise("dem10"))
    return elevation.golden_check(rows).select("point_id", "elevation_m", "expected_m", "expected_layer", "diff_m", "ok")


@query(f"""WITH {CELLS_SQL}, t AS (SELECT layer, tile_x, tile_y, count(*) AS n FROM cells GROUP BY 1, 2, 3)
SELECT CAST(layer AS INT) AS layer, count(*) AS tiles, CAST(sum(n) AS BIGINT) AS valid, CAST(count(*) * 65536 - sum(n) AS BIGINT) AS nodata FROM t GROUP BY 1""")
def layer_coverage(spark, d):
    return raster.layer_coverage(elev_cells(spark, d))


@query(f"WITH {CELLS_SQL} SELECT CAST(layer AS INT) AS layer, source_code, count(*) AS n FROM cells GROUP BY 1, 2")
def layer_sources(spark, d):
    return raster.layer_sources(elev_cells(spark, d))


@query(f"""WITH {CELLS_SQL} SELECT CAST(layer AS INT) AS layer, min(tile_x) AS min_tile_x, max(tile_x) AS max_tile_x, min(tile_y) AS min_tile_y, max(tile_y) AS max_tile_y FROM cells GROUP BY 1""")
def tile_extent(spark, d):
    return raster.tile_extent(elev_cells(spark, d))


@query("""WITH s AS (SELECT user_id AS route, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) * 20 AS distance_m,
CASE WHEN event_type = 'error' THEN NULL ELSE CAST(floor(value) AS BIGINT) END AS e FROM events),
w AS (SELECT *, e - lag(e) OVER o AS de, distance_m - lag(distance_m) OVER o AS dd FROM s WINDOW o AS (PARTITION BY route ORDER BY distance_m))
SELECT route, CAST(max(distance_m) AS BIGINT) AS distance_m, min(e) AS elevation_min_m, max(e) AS elevation_max_m, CAST(coalesce(sum(de) FILTER (de > 0), 0) AS BIGINT) AS ascent_m,
CAST(coalesce(sum(-de) FILTER (de < 0), 0) AS BIGINT) AS descent_m, CAST(coalesce(sum(dd) FILTER (de IS NULL), 0) AS BIGINT) AS missing_distance_m FROM w GROUP BY route""")
def profile_segments(spark, d):
    n = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    rows = read(spark, d, "events").select(F.col("user_id").alias("route"), (n * 20).cast("long").alias("distance_m"), F.when(F.col("event_type") != "error", F.floor("value").cast("long")).alias("elevation_m"))
    return profile.segments(rows, "route")


@query("""WITH l AS (SELECT o_orderkey AS line, 20 * (1 + o_custkey % 9) + o_orderkey % 20 AS len FROM orders),
s AS (SELECT line, len, unnest(generate_series(0, len // 20)) * 20 AS m FROM l UNION ALL SELECT line, len, len FROM l WHERE len % 20 <> 0)
SELECT line, CAST(m AS DOUBLE) AS distance_m, round(m / CAST(len AS DOUBLE), 9) AS share FROM s""")
def resample_line(spark, d):
    n = F.lit(20) * (1 + F.col("o_custkey") % 9) + F.col("o_orderkey") % 20
    lines = read(spark, d, "orders").select(F.col("o_orderkey").alias("line"), n.cast("double").alias("len"))
    ends = F.explode(F.array(F.struct(F.lit(0).alias("ord"), F.lit(0.0).alias("distance_m"), F.lit(0.0).alias("lat")), F.struct(F.lit(1).alias("ord"), F.col("len").alias("distance_m"), F.lit(1.0).alias("lat"))))
    corners = lines.select("line", ends.alias("e")).select("line", "e.*", F.lit(0.0).alias("lon"))
    return profile.resampled(corners, 20.0, "line").select("line", "distance_m", F.round("lat", 9).alias("share"))


@query("""WITH e AS (SELECT event_id AS ord, abs(CAST(floor(value) AS BIGINT) - event_id % 100) AS d FROM events WHERE value IS NOT NULL),
l AS (SELECT list_sort(list(d)) AS s, count(*) AS n FROM e)
SELECT n, s[n // 2 + 1] AS median, s[least(CAST(floor(n * 0.9e0) AS BIGINT), n - 1) + 1] AS p90, (SELECT max(d) FROM e) AS worst,
(SELECT min(ord) FROM e WHERE d = (SELECT max(d) FROM e)) AS worst_ord FROM l""")
def validate_stats(spark, d):
    rows = read(spark, d, "events").where("value IS NOT NULL").select(F.col("event_id").alias("ord"), F.floor("value").cast("long").alias("a"), (F.col("event_id") % 100).alias("b"))
    return elevation.difference_stats(rows)


DUP_SQL = """WITH r AS (SELECT s_suppkey AS ord, CAST(s_nationkey AS VARCHAR) AS name, CASE WHEN s_suppkey % 7 = 0 THEN CAST(s_suppkey % 35 AS VARCHAR) ELSE '' END AS phone,
CASE WHEN s_suppkey % 5 = 0 THEN CAST(s_suppkey % 50 AS VARCHAR) ELSE '' END AS website, 33e0 + ((s_suppkey * 7919) % 64) / 65536e0 AS lat, 133e0 + ((s_suppkey * 104729) % 64) / 65536e0 AS lon FROM supplier),
p AS (SELECT a.ord AS a, b.ord AS b, 1 AS rank, 'same name' AS signal FROM r a JOIN r b ON a.name = b.name AND a.ord < b.ord AND a.name <> ''
 WHERE 2 * 6371000e0 * asin(sqrt(pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2))) < 100
UNION ALL SELECT a.ord, b.ord, 2, 'same phone' FROM r a JOIN r b ON a.phone = b.phone AND a.ord < b.ord AND a.phone <> ''
UNION ALL SELECT a.ord, b.ord, 3, 'same website' FROM r a JOIN r b ON a.website = b.website AND a.ord < b.ord AND a.website <> '')
SELECT a, b, arg_min(signal, rank) AS signal FROM p GROUP BY a, b"""


@query(DUP_SQL)
def dup_pairs(spark, d):
    k = F.col("s_suppkey")
    some = lambda every, of: F.when(k % every == 0, (k % of).cast("string")).otherwise("")
    at = lambda base, f: F.lit(base) + ((k * f) % 64) / F.lit(65536.0)
    rows = read(spark, d, "supplier").select(k.alias("ord"), F.col("s_nationkey").cast("string").alias("name"), some(7, 35).alias("phone"), some(5, 50).alias("website"), at(33.0, 7919).alias("lat"), at(133.0, 104729).alias("lon"))
    return linking.duplicate_pairs(rows)


@query("""WITH l AS (SELECT p_brand AS scope, CAST(p_partkey % 97 AS VARCHAR) AS key, count(*) AS n, min(p_partkey) AS id FROM part GROUP BY 1, 2),
r AS (SELECT 'Brand#' || CAST(1 + s_suppkey % 5 AS VARCHAR) || CAST(1 + (s_suppkey // 5) % 5 AS VARCHAR) AS scope, CAST(s_suppkey % 97 AS VARCHAR) AS key, count(*) AS n, min(s_suppkey) AS id FROM supplier GROUP BY 1, 2)
SELECT coalesce(l.scope, r.scope) AS scope, coalesce(l.key, r.key) AS key, coalesce(l.n, 0) AS n_left, coalesce(r.n, 0) AS n_right, coalesce(l.n, 0) = 1 AND coalesce(r.n, 0) = 1 AS linked,
coalesce(l.n, 0) > 1 OR coalesce(r.n, 0) > 1 AS ambiguous, CASE WHEN l.n = 1 AND r.n = 1 THEN l.id END AS left_id, CASE WHEN l.n = 1 AND r.n = 1 THEN r.id END AS right_id
FROM l FULL JOIN r ON l.scope = r.scope AND l.key = r.key""")
def one_to_one_link(spark, d):
    k = F.col("s_suppkey")
    left = read(spark, d, "part").select(F.col("p_brand").alias("scope"), (F.col("p_partkey") % 97).cast("string").alias("key"), F.col("p_partkey").alias("id"))
    brand = F.concat(F.lit("Brand#"), (1 + k % 5).cast("string"), (1 + F.floor(k / 5) % 5).cast("string"))
    return linking.one_to_one(left, read(spark, d, "supplier").select(brand.alias("scope"), (k % 97).cast("string").alias("key"), k.alias("id")), "scope")


@query("""WITH o AS (SELECT o_orderkey AS id, o_orderstatus AS s FROM orders WHERE o_orderkey % 3 <> 0),
n AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 10 = 1 THEN 'X' ELSE o_orderstatus END AS s FROM orders WHERE o_orderkey % 4 <> 0)
SELECT coalesce(o.id, n.id) AS id, CASE WHEN o.id IS NULL THEN 'added' WHEN n.id IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM o FULL JOIN n ON o.id = n.id WHERE o.id IS NULL OR n.id IS NULL OR o.s IS DISTINCT FROM n.s""")
def index_drift(spark, d):
    orders = read(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("s"))
    new = orders.where("id % 4 <> 0").withColumn("s", F.when(F.col("id") % 10 == 1, "X").otherwise(F.col("s")))
    return linking.drift(orders.where("id % 3 <> 0"), new, "id", "s")


@query("""WITH l AS (SELECT o_orderkey AS ord, o_custkey AS id FROM orders), r AS (SELECT o_orderkey AS ord, o_custkey + CASE WHEN o_orderkey % 11 = 0 THEN 1 ELSE 0 END AS id FROM orders WHERE o_orderkey % 13 <> 0)
SELECT coalesce(l.ord, r.ord) AS ord, l.id AS left_id, r.id AS right_id FROM l FULL JOIN r ON l.ord = r.ord WHERE l.id IS DISTINCT FROM r.id""")
def id_sequence_check(spark, d):
    left = read(spark, d, "orders").select(F.col("o_orderkey").alias("ord"), F.col("o_custkey").alias("id"))
    return linking.sequence_mismatches(left, left.where("ord % 13 <> 0").withColumn("id", F.col("id") + F.when(F.col("ord") % 11 == 0, 1).otherwise(0)))


@query("""WITH p AS (SELECT o_orderkey AS url, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS sha256, 'fetched' AS status FROM orders WHERE o_orderkey % 2 = 0),
c AS (SELECT o_orderkey AS url, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'n' END AS sha256, CASE WHEN o_orderkey % 5 = 0 THEN 'failed' ELSE 'fetched' END AS status FROM orders WHERE o_orderkey % 7 <> 0)
SELECT coalesce(p.url, c.url) AS url, CASE WHEN c.url IS NULL OR (c.status = 'failed' AND p.sha256 IS NOT NULL) THEN p.sha256 ELSE c.sha256 END AS sha256,
CASE WHEN c.url IS NULL OR (c.status = 'failed' AND p.sha256 IS NOT NULL) THEN p.status ELSE c.status END AS status FROM p FULL JOIN c ON p.url = c.url""")
def manifest_merge(spark, d):
    o, k = read(spark, d, "orders"), F.col("o_orderkey")
    old = o.where(k % 2 == 0).select(k.alias("url"), F.when(k % 3 != 0, F.col("o_custkey").cast("string")).alias("sha256"), F.lit("fetched").alias("status"))
    new = o.where(k % 7 != 0).select(k.alias("url"), F.when(k % 5 != 0, "n").alias("sha256"), F.when(k % 5 == 0, "failed").otherwise("fetched").alias("status"))
    return linking.manifest_merge(old, new)


@query("""WITH f AS (SELECT event_type AS code, user_id AS id, min(event_id) AS ord FROM events GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY code ORDER BY ord) AS rn FROM f)
SELECT r.code, n, string_agg(CAST(id AS VARCHAR), ',' ORDER BY rn) AS examples FROM r JOIN (SELECT event_type AS code, count(*) AS n FROM events GROUP BY 1) c ON c.code = r.code WHERE rn <= 5 GROUP BY r.code, n""")
def warning_examples(spark, d):
    rows = read(spark, d, "events").select(F.col("event_id").alias("ord"), F.col("event_type").alias("code"), F.col("user_id").alias("id"))
    return reports.warning_examples(rows).select("code", "n", F.array_join(F.col("examples").cast("array<string>"), ",").alias("examples"))


@query("SELECT source AS value, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY 1 ORDER BY n DESC, value LIMIT 15")
def histogram_topn(spark, d):
    return reports.top_values(read(spark, d, "documents"), "source", 15)


@query("""SELECT count(*) AS total, count(*) FILTER (text <> '') AS with_text, count(*) FILTER (n_chars >= 1000) AS long, count(*) FILTER (regexp_matches(text, '[0-9]')) AS with_digits FROM documents""")
def coverage_counts(spark, d):
    return reports.coverage(read(spark, d, "documents"), {"with_text": F.col("text") != "", "long": F.col("n_chars") >= 1000, "with_digits": F.col("text").rlike("[0-9]")})


@query("SELECT CAST(g AS INT) AS number FROM generate_series(1, 88) t(g) WHERE g NOT IN (SELECT 1 + (p_partkey * 7) % 88 FROM part WHERE p_size < 5)")
def missing_numbers(spark, d):
    return reports.missing_numbers(read(spark, d, "part").where("p_size < 5").select((1 + (F.col("p_partkey") * 7) % 88).alias("number")), "number", 1, 88)


@query("SELECT c_mktsegment, c_nationkey, count(*) AS n FROM customer GROUP BY 1, 2 HAVING count(*) > 1")
def repeated_keys(spark, d):
    return reports.repeated_keys(read(spark, d, "customer"), "c_mktsegment", "c_nationkey")


@query("""SELECT o_orderkey, CAST(o_custkey AS VARCHAR) || '_L' || lpad(CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS VARCHAR), 3, '0') AS label FROM orders""")
def segment_labels(spark, d):
    return reports.numbered(read(spark, d, "orders"), "o_custkey", "o_orderkey", "_L%03d").select("o_orderkey", "label")


@query("SELECT CAST(o_custkey AS BIGINT) AS o_custkey, min(o_orderkey) AS o_orderkey FROM orders GROUP BY 1")
def first_per_key(spark, d):
    return linking.first_per_key(read(spark, d, "orders").select("o_custkey", "o_orderkey"), "o_custkey", "o_orderkey")


@query("""SELECT event_id, CAST(2 + event_id % 20 AS VARCHAR) || ':' || lpad(CAST((event_id * 7) % 60 AS VARCHAR), 2, '0') AS raw,
lpad(CAST(2 + event_id % 20 AS VARCHAR), 2, '0') || ':' || lpad(CAST((event_id * 7) % 60 AS VARCHAR), 2, '0') AS start_time, CASE WHEN event_id % 3 = 0 THEN '21:00' END AS end_time,
lpad(CAST(2 + event_id % 20 AS VARCHAR), 2, '0') || ':' || lpad(CAST((event_id * 7) % 60 AS VARCHAR), 2, '0') || CASE event_id % 3 WHEN 0 THEN '-21:00' WHEN 1 THEN '-' ELSE '' END AS shown FROM events""")
def time_parse(spark, d):
    raw = F.concat((2 + F.col("event_id") % 20).cast("string"), F.lit(":"), F.lpad(((F.col("event_id") * 7) % 60).cast("string"), 2, "0"))
    tail = F.element_at(F.array(F.lit("〜21:00"), F.lit("～"), F.lit("")), (F.col("event_id") % 3 + 1).cast("int"))
    got = text.time_range(F.concat(F.translate(raw, "0123456789:", "０１２３４５６７８９："), tail))
    return read(spark, d, "events").select("event_id", raw.alias("raw"), got.start.alias("start_time"), got.end.alias("end_time"), got.time.alias("shown"))


@query("""SELECT p_partkey, CAST(p_size * 100 AS INT) AS low, CAST(CASE p_partkey % 3 WHEN 0 THEN p_size * 100 WHEN 1 THEN p_size * 200 END AS INT) AS high, 'priced' AS status, CAST(NULL AS VARCHAR) AS missing FROM part""")
def price_parse(spark, d):
    amount = (F.col("p_size") * 100).cast("string")
    raw = F.concat(F.lit("素泊まり："), amount, F.when(F.col("p_partkey") % 3 == 0, "円").when(F.col("p_partkey") % 3 == 1, F.concat(F.lit("〜"), (F.col("p_size") * 200).cast("string"), F.lit("円"))).otherwise("円〜"))
    rows = read(spark, d, "part").select("p_partkey", F.get(text.prices(raw), F.lit(0)).alias("i"))
    return rows.select("p_partkey", F.col("i.amount_yen").alias("low"), F.col("i.max_amount_yen").alias("high"), F.col("i.status").alias("status"), F.col("i.room_type").alias("missing"))


@query("SELECT o_orderkey, CAST(o_orderkey % 1000 AS INT) AS n, '第' || CAST(o_orderkey % 1000 AS VARCHAR) || '番、札所（' || o_orderstatus || '）' AS cleaned FROM orders")
def text_normalize(spark, d):
    number = (F.col("o_orderkey") % 1000).cast("string")
    wide = F.translate(number, "0123456789", "０１２３４５６７８９")
    raw = F.concat(F.lit("第"), wide, F.lit("番 、  札所 （ "), F.col("o_orderstatus"), F.lit(" ）"))
    return read(spark, d, "orders").select("o_orderkey", text.whole_number(wide).alias("n"), text.clean_punct(text.normalize_digits(raw)).alias("cleaned"))


STATE_WORDS = ("可", "不可（要相談）", "未確認", "対象外", "ー", "???", "", "なし")


@query("""SELECT o_orderkey, CASE o_orderkey % 8 WHEN 0 THEN 'available' WHEN 1 THEN 'unavailable' WHEN 2 THEN 'unknown' WHEN 3 THEN 'not_applicable' WHEN 4 THEN 'not_provided'
WHEN 5 THEN 'unknown' WHEN 6 THEN 'not_provided' ELSE 'unavailable' END AS state, CASE WHEN o_orderkey % 8 = 0 THEN 'available' WHEN o_orderkey % 8 IN (1, 7) THEN 'unavailable' WHEN o_orderkey % 8 IN (2, 5) THEN 'unknown' WHEN o_orderkey % 8 = 3 THEN 'not_applicable' ELSE 'not_provided' END AS keyed FROM orders""")
def tri_state(spark, d):
    value = F.element_at(F.array(*[F.lit(x) for x in STATE_WORDS]), (F.col("o_orderkey") % 8 + 1).cast("int"))
    keyed = text.keyed_states(F.concat(F.lit("駐車：可|※洗濯機 : "), value), {"洗濯機": ("washer",), "駐車": ("parking",)})
    return read(spark, d, "orders").select("o_orderkey", text.tri_state(value).alias("state"), keyed.washer.alias("keyed"))


@query("""SELECT page_id, regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1) AS host, split_part(url, '?', 1) AS canonical, nullif(regexp_extract(url, '([0-9]+)', 1), '') AS first_id FROM pages""")
def url_parts(spark, d):
    return read(spark, d, "pages").select("page_id", F.coalesce(F.try_parse_url("url", F.lit("HOST")), F.lit("")).alias("host"), text.image_url(F.col("url")).url.alias("canonical"), text.empty_to_null(F.regexp_extract("url", "([0-9]+)", 1)).alias("first_id"))


def _built_pages(spark, d):
    """A small page for each of the table's pages, whose elements SQL can name."""
    k = F.col("page_id").cast("string")
    page = F.concat(F.lit("<div><p>x</p><a href='/p"), k, F.lit("?q=1&amp;r=2'>T <b>"), k, F.lit("</b></a><a>none</a><table><tr><th>k</th><td>"), k, F.lit("<br>v</td></tr></table></div>"))
    return read(spark, d, "pages").select("page_id", page.alias("html"))


@query("""SELECT page_id, 2 AS ord, '/p' || CAST(page_id AS VARCHAR) || '?q=1&r=2' AS href, 'T ' || CAST(page_id AS VARCHAR) AS text FROM pages""")
def html_links(spark, d):
    return archives.page_links(archives.page_nodes(_built_pages(spark, d), "page_id", "html", ("a",)), "page_id")


@query("""SELECT page_id, 6 AS "row", 'k|' || CAST(page_id AS VARCHAR) || chr(10) || 'v' AS cells FROM pages""")
def html_tables(spark, d):
    rows = archives.page_tables(archives.page_nodes(_built_pages(spark, d), "page_id", "html", ("td", "th")), "page_id")
    return rows.select("page_id", "row", F.array_join("cells", "|").alias("cells"))


@query()
def page_anchors(spark, d):
    """The links of the raw pages."""
    return archives.page_links(archives.page_nodes(read(spark, d, "pages"), "page_id", "html", ("a",)), "page_id")


@query("SELECT event_id, json_extract_string(props, '$.page') AS page, CAST(length(props) AS INT) AS n FROM events")
def json_props(spark, d):
    return read(spark, d, "events").select("event_id", F.get_json_object("props", "$.page").alias("page"), F.length("props").alias("n"))


def _polygon_sql() -> str:
    ring = geo.ISLAND
    edges = ", ".join(f"({x1!r}e0, {y1!r}e0, {x2!r}e0, {y2!r}e0)" for (x1, y1), (x2, y2) in zip(ring, [ring[-1], *ring[:-1]]))
    return f"""WITH p AS (SELECT c_custkey AS point_id, 32e0 + ((c_custkey * 7919) % 4096) / 1024e0 AS lat, 131e0 + ((c_custkey * 104729) % 4096) / 1024e0 AS lon FROM customer),
e(x1, y1, x2, y2) AS (VALUES {edges})
SELECT point_id, lat BETWEEN 32 AND 35 AND lon BETWEEN 131 AND 135.5 AS in_region,
(SELECT count(*) FROM e WHERE (y1 > lat) <> (y2 > lat) AND lon < (lat - y1) * (x2 - x1) / (y2 - y1) + x1) % 2 = 1 AS in_island FROM p"""


@query(_polygon_sql())
def point_in_polygon(spark, d):
    k = F.col("c_custkey")
    at = lambda base, f: F.lit(base) + ((k * f) % 4096) / F.lit(1024.0)
    rows = read(spark, d, "customer").select(k.alias("point_id"), at(32.0, 7919).alias("lat"), at(131.0, 104729).alias("lon"))
    return rows.select("point_id", geo.in_region(F.col("lat"), F.col("lon")).alias("in_region"), geo.in_polygon(F.col("lat"), F.col("lon")).alias("in_island"))


@query("""SELECT l_orderkey, l_linenumber, CAST(v // 65536 AS INT) AS r, CAST((v // 256) % 256 AS INT) AS g, CAST(v % 256 AS INT) AS b, CAST(floor(m / 20e0) * 20 AS INT) AS contour FROM (
SELECT *, CAST(round((m + 10000) * 10) AS INT) AS v FROM (SELECT l_orderkey, l_linenumber, CAST(l_partkey % 3000 AS DOUBLE) - 100 AS m FROM lineitem))""")
def terrain_rgb(spark, d):
    m = (F.col("l_partkey") % 3000).cast("double") - 100
    rows = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", geo.terrain_rgb(m).alias("c"), geo.contour_below(m).alias("contour"))
    return rows.select("l_orderkey", "l_linenumber", "c.r", "c.g", "c.b", "contour")


@query(f"""WITH {POINTS_SQL} SELECT point_id, CAST(floor((lon + 180) / 360 * 1024e0) AS INT) AS x, CAST(floor((1 - ln(tan(radians(lat)) + 1 / cos(radians(lat))) / pi()) / 2 * 1024e0) AS INT) AS y FROM pts""")
def mercator_tiles(spark, d):
    return points(spark, d).select("point_id", geo.mercator_x(F.col("lon"), F.lit(10)).alias("x"), geo.mercator_y(F.col("lat"), F.lit(10)).alias("y"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'hotel' WHEN o_orderkey % 4 = 1 THEN 'hostel' END AS subtype, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_custkey AS VARCHAR) WHEN o_orderkey % 3 = 1 THEN 'c' END AS phone
FROM orders WHERE o_orderkey % 4 < 2""")
def lodging_tags(spark, d):
    k = F.col("o_orderkey")
    kind = F.when(k % 4 == 0, " hotel").when(k % 4 == 1, "hostel ").when(k % 4 == 2, "museum").otherwise("")
    tags = F.create_map(F.lit("tourism"), kind, F.lit("phone"), F.when(k % 3 == 0, F.col("o_custkey").cast("string")).otherwise(" "), F.lit("contact:phone"), F.when(k % 3 == 1, "c").otherwise(""))
    rows = read(spark, d, "orders").select(k.alias("id"), F.lit(0.0).alias("lat"), F.lit(0.0).alias("lon"), tags.alias("tags"))
    return osm.lodging_features(osm.lodging(rows)).select(F.col("id").alias("o_orderkey"), "subtype", "phone")


from . import catalog_rasters, catalog_records  # noqa: E402, F401  (they register their queries)
