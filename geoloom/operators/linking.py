"""Links between records: duplicates, one-to-one names, drift, upserts, sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo

NEAR_M = 100.0


def tiled_join(left: DataFrame, right: DataFrame, keys: list[str], l_id: str, r_id: str, block: int) -> DataFrame:
    """The equi-join of two tables in tiles of about ``block`` rows a side, dealt to all tasks.

    A key's pairs may be many however few its rows are, so neither the size of the tables nor that of a key says
    how much a task has to do; tiles are alike, and a task holds one at a time.
    """
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = lambda df, name: df.groupBy(*keys).agg(F.ceil(F.count("*") / block).cast("int").alias(name))
    sizes = n(left, "_bl").join(n(right, "_br"), keys)
    of = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    l = left.join(sizes, keys).withColumn("_r", of(l_id, "_bl")).withColumn("_c", every("_br")).drop("_bl", "_br")  # noqa: E741
    r = right.join(sizes, keys).withColumn("_c", of(r_id, "_br")).withColumn("_r", every("_bl")).drop("_bl", "_br")
    # one text: of several columns the optimizer leaves a constant one out, shuffles again and joins all in one task
    tile = F.to_json(F.struct(*keys, "_r", "_c")).alias("_tile")
    dealt = lambda df, *less: df.select(tile, *[c for c in df.columns if c not in ("_r", "_c", *less)]).repartition(parts, "_tile")
    return dealt(l).join(dealt(r, *keys).hint("merge"), "_tile").drop("_tile")


def duplicate_pairs(rows: DataFrame, near_m: float = NEAR_M, block: int = 1024) -> DataFrame:
    """a, b, signal of rows (ord, name, phone, website, lat, lon): the first signal of an unordered pair.

    Equal names count within near_m metres and meet in cells of at least that size.  A pair knows its earlier signals
    from its own two rows, so pairs are not grouped; only those of a repeated ord, which may come of several rows, are.
    """
    size = near_m / 80000.0  # degrees; a degree of longitude has over 80 km up to 44 degrees of latitude
    cols = ["ord", "name", "phone", "website", "lat", "lon"]
    keyed = rows.select(*cols, F.floor(F.col("lat") / size).alias("_y"), F.floor(F.col("lon") / size).alias("_x"))
    repeated = rows.groupBy("ord").agg(F.count("*").alias("_n")).where("_n > 1").select("ord")
    once, again = keyed.join(repeated, "ord", "left_anti"), keyed.join(repeated, "ord", "left_semi")
    step = lambda c: F.abs(F.col(f"a{c}") - F.col(f"b{c}")) <= 1
    near = step("_y") & step("_x") & (geo.haversine_asin_m(F.col("a_lat"), F.col("a_lon"), F.col("b_lat"), F.col("b_lon")) < near_m)
    same = lambda k: F.coalesce((F.col(f"a_{k}") == F.col(f"b_{k}")) & (F.col(f"a_{k}") != ""), F.lit(False))
    by_name = same("name") & F.coalesce(near, F.lit(False))
    around = F.explode(F.array(*[F.struct((F.col("b_y") + dy).alias("y"), (F.col("b_x") + dx).alias("x")) for dy in (-1, 0, 1) for dx in (-1, 0, 1)]))

    def pairs(a: DataFrame, b: DataFrame) -> DataFrame:
        side = lambda df, p: df.select(*[F.col(c).alias(f"{p}_{c}") for c in cols], F.col("_y").alias(f"{p}_y"), F.col("_x").alias(f"{p}_x"))
        left, right = side(a, "a"), side(b, "b")

        def met(key: str, rank: int, keep, l=left, r=right, *cell: str) -> DataFrame:  # noqa: E741
            both = tiled_join(l.where(f"a_{key} <> ''").withColumn("_k", F.col(f"a_{key}")), r.where(f"b_{key} <> ''").withColumn("_k", F.col(f"b_{key}")), ["_k", *cell], "a_ord", "b_ord", block)
            return both.where(F.col("a_ord") < F.col("b_ord")).where(keep).select(F.col("a_ord").alias("a"), F.col("b_ord").alias("b"), F.lit(rank).alias("rank"), F.lit(f"same {key}").alias("signal"))

        own = left.withColumn("_cy", F.col("a_y")).withColumn("_cx", F.col("a_x"))
        cells = right.withColumn("_n", around).withColumn("_cy", F.col("_n.y")).withColumn("_cx", F.col("_n.x")).drop("_n")
        named = met("name", 1, near, own, cells, "_cy", "_cx")
        return named.unionAll(met("phone", 2, ~by_name)).unionAll(met("website", 3, ~by_name & ~same("phone")))

    first = pairs(again, keyed).unionAll(pairs(once, again)).groupBy("a", "b").agg(F.min_by("signal", "rank").alias("signal"))
    return pairs(once, once).select("a", "b", "signal").unionAll(first)


def one_to_one(left: DataFrame, right: DataFrame, *scope: str) -> DataFrame:
    """Per (scope, key): counts on both sides, and whether the key links or is ambiguous; keys are non-empty."""
    l = left.where("key <> ''").groupBy(*scope, "key").agg(F.count("*").alias("n_left"), F.min("id").alias("left_id"))  # noqa: E741
    r = right.where("key <> ''").groupBy(*scope, "key").agg(F.count("*").alias("n_right"), F.min("id").alias("right_id"))
    both = l.join(r, [*scope, "key"], "full_outer").fillna(0, ["n_left", "n_right"])
    linked = (F.col("n_left") == 1) & (F.col("n_right") == 1)
    return both.select(*scope, "key", "n_left", "n_right", linked.alias("linked"), ((F.col("n_left") > 1) | (F.col("n_right") > 1)).alias("ambiguous"), F.when(linked, F.col("left_id")).alias("left_id"), F.when(linked, F.col("right_id")).alias("right_id"))


def matched_to_unique(left: DataFrame, right: DataFrame, *scope: str) -> DataFrame:
    """Rows of left whose key stands exactly once on the right."""
    once = right.where("key <> ''").groupBy(*scope, "key").agg(F.count("*").alias("_n")).where("_n = 1").drop("_n")
    return left.join(once, [*scope, "key"], "left_semi")


def drift(previous: DataFrame, current: DataFrame, key: str, *values: str) -> DataFrame:
    """key and change (added, removed, changed) between two tables; values compare null-safe."""
    old = previous.select(F.col(key), F.struct(*values).alias("_old"))
    new = current.select(F.col(key), F.struct(*values).alias("_new"))
    both = old.join(new, key, "full_outer")
    change = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed").when(~F.col("_old").eqNullSafe(F.col("_new")), "changed")
    return both.select(key, change.alias("change")).where("change IS NOT NULL")


def manifest_merge(previous: DataFrame, current: DataFrame, key: str = "url") -> DataFrame:
    """current, but a failed fetch keeps the archive that the previous manifest had; others stay."""
    names = [c for c in current.columns if c != key]
    both = previous.select(key, F.struct(*names).alias("_p")).join(current.select(key, F.struct(*names).alias("_c")), key, "full_outer")
    keep = F.col("_c").isNull() | ((F.col("_c.status") == "failed") & F.col("_p.sha256").isNotNull())
    one = F.when(keep, F.col("_p")).otherwise(F.col("_c"))
    return both.select(key, *[one[c].alias(c) for c in names])


def sequence_mismatches(left: DataFrame, right: DataFrame) -> DataFrame:
    """Ordinals (ord, id) at which two sequences differ or one has ended."""
    l, r = left.select("ord", F.col("id").alias("left_id")), right.select("ord", F.col("id").alias("right_id"))
    return l.join(r, "ord", "full_outer").where(~F.col("left_id").eqNullSafe(F.col("right_id")))


def first_per_key(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key, by order; only the row itself is kept while grouping."""
    return rows.groupBy(key).agg(F.min_by(F.struct("*"), order).alias("_r")).select("_r.*")


def geocoded(rows: DataFrame, cache: DataFrame, in_area) -> DataFrame:
    """rows (ord, candidates array<string>) with the first cached candidate that resolves.

    cache (url_sha256, failed, place_count, lat, lon).  Failures rank: fetch_failed, place_ambiguous, place_outside,
    place_not_found.
    """
    tried = rows.select("ord", F.posexplode("candidates").alias("pos", "url")).withColumn("url_sha256", F.sha2("url", 256)).join(cache, "url_sha256", "left")
    state = (
        F.when(F.col("failed").isNull() | F.col("failed"), 1)
        .when(F.col("place_count") > 1, 2)
        .when((F.col("place_count") == 1) & ~in_area(F.col("lat"), F.col("lon")), 3)
        .when(F.coalesce("place_count", F.lit(0)) == 0, 4)
        .otherwise(0)
    )
    best = tried.withColumn("_s", state).groupBy("ord").agg(F.min(F.when(F.col("_s") == 0, F.struct("pos", "url", "lat", "lon"))).alias("hit"), F.min(F.when(F.col("_s") > 0, F.col("_s"))).alias("worst"))
    names = F.create_map(*[F.lit(x) for pair in enumerate(("fetch_failed", "place_ambiguous", "place_outside", "place_not_found"), 1) for x in pair])
    status = F.when(F.col("hit").isNotNull(), "resolved").when(F.col("worst").isNull(), "no_url").otherwise(F.element_at(names, F.col("worst")))
    return rows.join(best, "ord", "left").select("ord", status.alias("status"), F.col("hit.url").alias("url"), F.col("hit.lat").alias("lat"), F.col("hit.lon").alias("lon"))


def latest_context(nodes: DataFrame, order: str = "ord") -> DataFrame:
    """Headings carried forward in a document: nodes (doc, ord, prefecture?, temple?); a new prefecture resets the temple."""
    w = Window.partitionBy("doc").orderBy(order)
    part = nodes.withColumn("_p", F.count("prefecture").over(w)).withColumn("prefecture", F.last("prefecture", True).over(w))
    return part.withColumn("temple", F.last("temple", True).over(Window.partitionBy("doc", "_p").orderBy(order))).drop("_p")


def with_files(images: DataFrame, assets: DataFrame) -> DataFrame:
    """images (url, ...) with the local file of the last asset (ord, url, path) that has their url."""
    last = assets.groupBy("url").agg(F.max_by("path", "ord").alias("local_path"))
    return images.join(last, "url", "left")


def with_retrieval(raw: DataFrame, manifest: DataFrame) -> DataFrame:
    """raw (source_id, ...) with retrieved_at of its manifest entry."""
    return raw.join(manifest.select("source_id", "retrieved_at"), "source_id", "left")


def refreshed_manifest(previous: DataFrame, current: DataFrame, archive: DataFrame, key: str = "url") -> DataFrame:
    """manifest_merge with the checksum of the archived content (key, content) wherever there is one."""
    sums = archive.select(key, F.sha2("content", 256).alias("_sum"))
    merged = manifest_merge(previous, current, key)
    return merged.join(sums, key, "left").withColumn("sha256", F.coalesce("_sum", "sha256")).drop("_sum")


def trail_manifest(courses: DataFrame, pages: DataFrame, tracks: DataFrame) -> DataFrame:
    """A row for each course (course_id) with whether its page and its track (course_id, sha256) are archived, and its state."""
    page, track = pages.select("course_id", F.col("sha256").alias("page_sha256")), tracks.select("course_id", F.col("sha256").alias("track_sha256"))
    rows = courses.select("course_id").join(page, "course_id", "left").join(track, "course_id", "left")
    state = F.when(F.col("page_sha256").isNull(), "missing_page").when(F.col("track_sha256").isNull(), "missing_track").otherwise("complete")
    return rows.withColumn("state", state)


def trail_violations(courses: DataFrame, manifest: DataFrame, tracks: DataFrame) -> DataFrame:
    """(id, rule) of a trail archive: repeated courses, courses that the manifest lacks, checksums that differ, tracks without a line."""
    own = courses.select(F.col("course_id").alias("id"))
    have = manifest.select(F.col("course_id").alias("id"), "track_sha256")
    got = tracks.select(F.col("course_id").alias("id"), "sha256", "line_count")
    rule = lambda df, name: df.select(F.col("id").cast("string").alias("id"), F.lit(name).alias("rule"))
    found = [
        rule(own.groupBy("id").agg(F.count("*").alias("n")).where("n > 1"), "course is listed twice"),
        rule(own.join(have, "id", "left_anti"), "course is not in the manifest"),
        rule(have.join(got, "id").where(~F.col("track_sha256").eqNullSafe(F.col("sha256"))), "track checksum differs"),
        rule(got.where("line_count = 0"), "track has no line"),
    ]
    out = found[0]
    for f in found[1:]:
        out = out.unionAll(f)
    return out


def latest_routes(routes: DataFrame) -> DataFrame:
    """The last row (by ord) of each prefecture and route."""
    return routes.groupBy("prefecture", "route_id").agg(F.max_by(F.struct("*"), "ord").alias("_r")).select("_r.*")
