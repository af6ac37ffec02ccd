"""Trail courses: route segments, points of interest, links to spots, counters by prefecture.

course (source_post_id, prefecture, name, spots array<struct<number,title>>, photo_title, placemarks array<struct<name,
geometry array<struct<kind,coordinates>>>>).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import trail_key, trail_keys
from .linking import one_to_one

PREFECTURES = ("tokushima", "kochi", "ehime", "kagawa")


def checked(courses: DataFrame) -> DataFrame:
    """courses, failing on a repeated id, a missing prefecture, a bad position or a course without a line."""
    shapes = F.flatten(F.transform("placemarks", lambda p: p.geometry))
    bad = F.exists(shapes, lambda g: (F.size(g.coordinates) < F.when(g.kind == "LineString", 2).otherwise(1)) | F.exists(g.coordinates, lambda c: (F.size(c) < 2) | ~c[0].between(-180, 180) | ~c[1].between(-90, 90)))
    n = courses.groupBy("source_post_id").agg(F.count("*").alias("_n"))
    error = (
        F.when(F.col("_n") > 1, "duplicate source_post_id")
        .when(F.coalesce("prefecture", F.lit("")) == "", "prefecture is required")
        .when(F.coalesce(bad, F.lit(True)), "bad geometry")
        .when(~F.exists(shapes, lambda g: g.kind == "LineString"), "no LineString")
    )
    rows = courses.join(n, "source_post_id").withColumn("_e", error)
    return rows.where(F.assert_true(F.col("_e").isNull(), F.concat(F.lit("course "), F.col("source_post_id").cast("string"), F.lit(": "), F.col("_e"))).isNull()).drop("_n", "_e")


def parts(courses: DataFrame, kind: str) -> DataFrame:
    """Shapes of one kind, numbered in file order within their course."""
    p = courses.select(F.format_string("SNT_%s", F.col("source_post_id").cast("string")).alias("route_id"), "prefecture", F.posexplode("placemarks").alias("i", "p"))
    g = p.select("route_id", "prefecture", "i", F.col("p.name").alias("name"), F.posexplode("p.geometry").alias("j", "g")).where(F.col("g.kind") == kind)
    n = F.row_number().over(Window.partitionBy("route_id").orderBy("i", "j"))
    return g.select("route_id", "prefecture", "name", n.alias("n"), F.col("g.coordinates").alias("coordinates"))


def segments(courses: DataFrame) -> DataFrame:
    lines = parts(courses, "LineString")
    return lines.select("route_id", "prefecture", F.format_string("%s_L%03d", "route_id", "n").alias("segment_id"), F.col("n").alias("seg"), F.count("*").over(Window.partitionBy("route_id")).alias("seg_count"), "coordinates")


def spots(courses: DataFrame) -> DataFrame:
    s = courses.select(F.format_string("SNT_%s", F.col("source_post_id").cast("string")).alias("route_id"), "prefecture", F.posexplode("spots").alias("i", "s"))
    return s.select("route_id", "prefecture", F.format_string("%s_S%03d", "route_id", F.col("i") + 1).alias("id"), "s.number", F.col("s.title").alias("name"), trail_key(F.col("s.title")).alias("key"))


def pois(courses: DataFrame) -> DataFrame:
    p = parts(courses, "Point")
    return p.select("route_id", "prefecture", F.format_string("%s_P%04d", "route_id", "n").alias("id"), "name", trail_key(F.col("name")).alias("key"), F.get("coordinates", F.lit(0)).alias("position"))


def links(courses: DataFrame) -> DataFrame:
    """Per course and name: whether a spot and a point link one to one, or are ambiguous."""
    return one_to_one(spots(courses), pois(courses), "route_id", "prefecture")


def poi_features(courses: DataFrame) -> DataFrame:
    """Points of interest, with the spot that each links to one to one.

    A course is read once and its names are met within its own row: sorted by key, a link is a spot and a point that
    stand alone side by side.  Courses of a repeated id are one route, as in ``parts``; a course whose rows already
    lie in order of source_post_id is neither sorted nor dealt again.
    """
    route = Window.partitionBy("source_post_id")
    own = F.struct("prefecture", *[F.coalesce(c, F.array()).alias(c) for c in ("spots", "placemarks")])
    tagged = courses.select("source_post_id", own.alias("c"), F.monotonically_increasing_id().alias("_r"))
    routes = tagged.select("source_post_id", F.collect_list("c").over(route).alias("cs"), "_r", F.min("_r").over(route).alias("_first")).where("_r = _first")

    def points(c, k):
        of = lambda p, i: F.transform(F.coalesce(p.geometry, F.array()), lambda g, j: F.struct(i.alias("i"), j.alias("j"), k.alias("k"), c.prefecture.alias("prefecture"), p["name"].alias("name"), F.get(g.coordinates, F.lit(0)).alias("position"), (g.kind == "Point").alias("_is")))
        return F.filter(F.flatten(F.transform(c.placemarks, of)), lambda x: x._is)

    spots_ = F.flatten(F.transform("cs", lambda c: F.transform(c.spots, lambda s, i: F.struct(c.prefecture.alias("prefecture"), s.title.alias("name"), (i + 1).alias("n")))))
    shown = F.flatten(F.transform("cs", points))
    rows = routes.select(F.format_string("SNT_%s", F.col("source_post_id").cast("string")).alias("route_id"), F.when(F.size("cs") > 1, F.sort_array(shown)).otherwise(shown).alias("_p"), spots_.alias("_s"))
    keyed = rows.select("route_id", "_p", "_s", trail_keys(F.transform("_p", lambda x: x["name"])).alias("_pk"), trail_keys(F.transform("_s", lambda x: x["name"])).alias("_sk"))
    item = lambda x, key, point, spot, position: F.struct(x.prefecture.alias("prefecture"), key.alias("key"), point.alias("point"), spot.alias("spot"), x["name"].alias("name"), position.alias("position"))
    items = F.concat(
        F.transform("_p", lambda x, i: item(x, F.get("_pk", i), i + 1, F.lit(None).cast("int"), x.position)),
        F.transform("_s", lambda x, i: item(x, F.get("_sk", i), F.lit(0), x.n, F.when(F.lit(False), F.get("_p", F.lit(0)).position))),
    )
    # spots (point 0) stand before the points of their name; names of a missing prefecture and empty keys meet nothing
    at = lambda i: F.get("_i", i)
    same = lambda a, b: F.coalesce((at(a).prefecture == at(b).prefecture) & (at(a).key == at(b).key), F.lit(False))
    linked = lambda x, i: (x.key != "") & (at(i - 1).point == 0) & same(i - 1, i) & ~same(i - 2, i) & ~same(i + 1, i)
    each = F.transform("_i", lambda x, i: F.struct(x.point.alias("point"), x["name"].alias("name"), x.position.alias("position"), F.when(linked(x, i), at(i - 1).spot).alias("spot")))
    found = keyed.select("route_id", F.sort_array(items).alias("_i")).select("route_id", F.inline(F.filter(each, lambda x: x.point > 0)))
    content = F.when(F.col("spot").isNotNull(), F.format_string("%s_S%03d", "route_id", "spot"))
    return found.select(F.format_string("%s_P%04d", "route_id", "point").alias("id"), "route_id", "name", F.when(F.col("spot").isNotNull(), "tourism_spot").otherwise("kml_poi").alias("kind"), content.alias("content_id"), "position")


def counters(courses: DataFrame) -> DataFrame:
    """Counts by prefecture and in total (prefecture null).

    A course is read once: it gives a row for itself, its photo, its spots and its points, and the rows of a name are
    counted together.
    """
    item = lambda what, title: F.struct(F.lit(what).alias("what"), title.alias("title"))
    shapes = lambda p, kind: F.filter(F.coalesce(p.geometry, F.array()), lambda g: g.kind == kind)
    placemarks = F.coalesce("placemarks", F.array())
    lines = F.flatten(F.transform(placemarks, lambda p: shapes(p, "LineString")))
    points = F.flatten(F.transform(placemarks, lambda p: F.transform(shapes(p, "Point"), lambda _: item("point", p["name"]))))
    photo = F.filter(F.array(item("photo", F.col("photo_title"))), lambda x: x.title.isNotNull())
    items = F.concat(F.array(item("course", F.lit(None).cast("string"))), photo, F.transform(F.coalesce("spots", F.array()), lambda x: item("spot", x.title)), points)
    sizes = F.aggregate(lines, F.lit(0).cast("long"), lambda n, g: n + F.coalesce(F.size(g.coordinates), F.lit(0)))
    rows = courses.select("source_post_id", "prefecture", F.size(lines).cast("long").alias("lines"), sizes.alias("positions"), F.explode(items).alias("x"))
    keyed = rows.select("source_post_id", "prefecture", "lines", "positions", "x.what", trail_key(F.col("x.title")).alias("key"))
    are = lambda what: F.count_if(F.col("what") == what)
    sum_ = lambda c: F.sum(F.when(F.col("what") == "course", F.col(c)).otherwise(0))
    by_name = keyed.groupBy("source_post_id", "prefecture", "key").agg(
        are("course").alias("courses"), sum_("lines").alias("route_segments"), sum_("positions").alias("route_coordinate_points"), are("point").alias("kml_pois"),
        are("spot").alias("tourism_spots"), are("photo").alias("photo_points"),
    )
    everywhere = F.sum("kml_pois").over(Window.partitionBy("source_post_id", "key"))  # a photo's point may be of another prefecture
    one = lambda c: F.when(c & (F.col("key") != ""), 1).otherwise(0)
    spots_, pois_, known = F.col("tourism_spots"), F.col("kml_pois"), F.col("prefecture").isNotNull()
    # names of a missing prefecture meet nothing, so their spots and points are told apart
    ambiguous = F.when(known, one((spots_ > 1) | (pois_ > 1))).otherwise(one(spots_ > 1) + one(pois_ > 1))
    counted = by_name.withColumn("_points", everywhere).select(
        "prefecture", *[c for c in by_name.columns if c not in ("source_post_id", "prefecture", "key")], ambiguous.alias("ambiguous_names"),
        one(known & (spots_ == 1) & (pois_ == 1)).alias("linked_tourism_spots"), F.when((F.col("_points") == 1) & (F.col("key") != ""), F.col("photo_points")).otherwise(0).alias("matched_photo_points"),
    )
    n = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    plain = ("courses", "route_segments", "route_coordinate_points", "kml_pois", "tourism_spots", "ambiguous_names", "photo_points", "matched_photo_points", "linked_tourism_spots")
    return counted.rollup("prefecture").agg(
        *[n(c).alias(c) for c in plain], (n("tourism_spots") - n("linked_tourism_spots")).alias("unmatched_tourism_spots"), (n("kml_pois") - n("linked_tourism_spots")).alias("unmatched_pois")
    )


def ordered(routes: DataFrame) -> DataFrame:
    """Routes by a fixed prefecture order, then course number (none last), then id."""
    at = F.array_position(F.array(*[F.lit(p) for p in PREFECTURES]), F.col("prefecture"))
    return routes.orderBy(F.when(at == 0, 99).otherwise(at), F.coalesce(F.col("course_number").try_cast("int"), F.lit(2147483647)), "route_id")
