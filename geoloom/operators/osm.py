"""OpenStreetMap tables: tag filters, route members, relation geometry, rings, inventories."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Lodging subtypes of the tourism tag.
LODGING = ("hotel", "guest_house", "hostel", "motel", "apartment", "chalet", "alpine_hut", "wilderness_hut", "camp_site", "caravan_site")


def tag(name: str) -> Column:
    """A tag's trimmed value, null where it is missing or empty."""
    return F.nullif(F.trim(F.try_element_at("tags", F.lit(name))), F.lit(""))


def first_tag(*names: str) -> Column:
    return F.coalesce(*[tag(n) for n in names])


def clean_tags(tags: Column) -> Column:
    return F.map_filter(F.transform_values(tags, lambda k, v: F.trim(v)), lambda k, v: v != "")


def lodging(objects: DataFrame) -> DataFrame:
    return objects.where(tag("tourism").isin(*LODGING))


def hiking_routes(relations: DataFrame) -> DataFrame:
    return relations.where((tag("type") == "route") & (tag("route") == "hiking"))


def worship(objects: DataFrame) -> DataFrame:
    return objects.where(tag("amenity") == "place_of_worship")


def lodging_features(objects: DataFrame) -> DataFrame:
    """id, kind, subtype and contact properties with their fall-backs, of objects (id, tags, lat, lon)."""
    address = F.map_filter("tags", lambda k, v: k.startswith("addr:") & (F.trim(v) != ""))
    return objects.select(
        "id", "lat", "lon", tag("tourism").alias("subtype"), first_tag("name", "name:ja").alias("name"), first_tag("name:en", "int_name").alias("name_en"),
        first_tag("phone", "contact:phone").alias("phone"), first_tag("website", "contact:website", "url").alias("website"), first_tag("email", "contact:email").alias("email"),
        tag("rooms").try_cast("int").alias("rooms"), tag("beds").try_cast("int").alias("beds"), F.when(F.size(address) > 0, address).alias("address"), clean_tags(F.col("tags")).alias("raw_tags"),
    )


def subtype_warnings(objects: DataFrame) -> DataFrame:
    """id and warning of objects whose tourism tag is no known lodging subtype; empty tags make none."""
    kind = tag("tourism")
    return objects.where(kind.isNotNull() & ~kind.isin(*LODGING)).select("id", F.concat(F.lit("unknown tourism subtype: "), kind).alias("warning"))


def lodging_stats(features: DataFrame) -> DataFrame:
    """One row of counts over features (kind, subtype, name, lat, lon, phone, website, washing_machine, dryer, internet_access, wifi)."""
    n = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    empty = lambda c: n(F.coalesce(F.col(c), F.lit("")) == "")
    some = lambda c: F.col(c).isNotNull()
    unknown = F.array_sort(F.collect_set(F.when(~F.col("subtype").isin(*LODGING), F.col("subtype"))))
    return features.agg(
        F.count("*").alias("total"), *[n(F.col("kind") == k).alias(f"{k}s") for k in ("node", "way", "relation")], empty("name").alias("missing_name"),
        n(F.col("lat").isNull() | F.col("lon").isNull()).alias("missing_coordinate"), empty("phone").alias("missing_phone"), empty("website").alias("missing_website"),
        n(some("washing_machine") | some("dryer")).alias("with_laundry_tags"), n((F.coalesce("internet_access", F.lit("")) != "") | (F.coalesce("wifi", F.lit("")) != "")).alias("with_internet_tags"),
        F.array_join(unknown, ",").alias("unknown_subtypes"),
    )


#: Marks and endings of names that look like a numbered temple's but are not, and the forms of numbered names.
NOISE = ("爺神山ミニ", "別格")
HALLS = ("大師堂", "観音堂", "善女庵", "法南寺")
NUMBERED, WIDE_NUMBERED = "(?U)^第(\\d{1,2})番札所", "^第[０-９]{1,2}番札所"
SEGMENT = "(?U)^四国遍路 (\\d{1,2})番札所(.+?)~(\\d{1,2})番札所(.+)$"


def temple_candidates(objects: DataFrame) -> DataFrame:
    """Places of worship with a numbered name: id, number, name, noise (a mark), hall (an ending), wide (full-width digits)."""
    name = F.coalesce(F.try_element_at("tags", F.lit("name")), F.lit(""))
    number = F.translate(F.regexp_extract(name, NUMBERED, 1), "０１２３４５６７８９", "0123456789").cast("int")
    any_ = lambda test: F.greatest(*[F.coalesce(c, F.lit(False)) for c in test])
    return worship(objects).where(name.rlike(NUMBERED)).select(
        "id", number.alias("number"), name.alias("name"), any_([name.contains(x) for x in NOISE]).alias("noise"), any_([name.endswith(x) for x in HALLS]).alias("hall"), name.rlike(WIDE_NUMBERED).alias("wide")
    )


def route_segments(relations: DataFrame) -> DataFrame:
    """Hiking relations named after two numbered temples: the last relation of each pair of numbers."""
    name = F.coalesce(tag("name"), F.lit(""))
    part = lambda i: F.regexp_extract(name, SEGMENT, i)
    rows = hiking_routes(relations).where(name.rlike(SEGMENT)).select("id", part(1).cast("int").alias("from_number"), part(2).alias("from_name"), part(3).cast("int").alias("to_number"), part(4).alias("to_name"))
    return rows.groupBy("from_number", "to_number").agg(F.max_by(F.struct("from_name", "to_name", "id"), "id").alias("r")).select("from_number", "to_number", "r.from_name", "r.to_name", F.col("r.id").alias("relation_id"))


def segment_status(segments: DataFrame, candidates: DataFrame) -> DataFrame:
    """segments with whether a candidate without a noise mark has each number: ok or MISSING."""
    known = F.broadcast(candidates.where("NOT noise").select("number").distinct())  # two digits: 100 numbers at most
    out = segments
    for side in ("from", "to"):
        one = known.select(F.col("number").alias(f"{side}_number"), F.lit("ok").alias(f"{side}_status"))
        out = out.join(one, f"{side}_number", "left").withColumn(f"{side}_status", F.coalesce(f"{side}_status", F.lit("MISSING")))
    return out


def inventory(objects: DataFrame, relations: DataFrame) -> DataFrame:
    """One row: places of worship by religion, numbered candidates, hiking relations and numbered segments."""
    places = worship(objects).agg(F.count("*").alias("worship"), F.count_if(tag("religion") == "buddhist").alias("buddhist"))
    numbered = temple_candidates(objects).agg(F.count("*").alias("candidates"), F.countDistinct("number").alias("numbers"), F.count_if("noise").alias("noise"))
    routes = hiking_routes(relations).agg(F.count("*").alias("routes"))
    pairs = route_segments(relations).agg(F.count("*").alias("segments"))
    return places.join(F.broadcast(numbered)).join(F.broadcast(routes)).join(F.broadcast(pairs))  # one row each


def needed_ways(ways: DataFrame, relations: DataFrame) -> DataFrame:
    """Ways that are members of a relation (semi-join)."""
    refs = relations.select(F.explode("members").alias("m")).where("m.type = 'w'").select(F.col("m.ref").alias("id"))
    return ways.join(refs, "id", "left_semi")


def route_lines(relations: DataFrame, ways: DataFrame) -> DataFrame:
    """One feature for each (relation, member way) that can be a line."""
    members = hiking_routes(relations).select(F.col("id").alias("relation_id"), tag("name").alias("name"), tag("ref").alias("ref"), F.posexplode("members").alias("pos", "m")).where("m.type = 'w'")
    lines = ways.where(F.size("coords") >= 2).select(F.col("id").alias("way_id"), "coords")
    return members.join(lines, F.col("m.ref") == F.col("way_id")).select("relation_id", "name", "ref", "way_id", F.col("m.role").alias("role"), "coords")


def relation_parts(relations: DataFrame, ways: DataFrame) -> DataFrame:
    """Per relation: member ways found and missing, and the coordinate lists by role."""
    members = relations.select("id", F.posexplode("members").alias("pos", "m")).where("m.type = 'w'")
    own = ways.select(F.col("id").alias("way_id"), "coords")
    got = members.join(own, F.col("m.ref") == F.col("way_id"), "left")
    part = F.when(F.col("coords").isNotNull(), F.struct("pos", F.col("m.role").alias("role"), "coords"))
    return got.groupBy("id").agg(F.count("coords").alias("found"), F.count_if(F.col("coords").isNull()).alias("missing"), F.sort_array(F.collect_list(part)).alias("parts"))


def joined_rings(lines: list[list[tuple[float, float]]]) -> list[list[tuple[float, float]]]:
    """Closed rings made of open lines that share end points; what does not close is left out."""
    rings, open_ = [], []
    for line in lines:
        line = [tuple(p) for p in line]
        (rings if len(line) > 3 and line[0] == line[-1] else open_).append(line)
    while open_:
        ring = open_.pop(0)
        while ring[0] != ring[-1]:
            for i, other in enumerate(open_):
                if other[0] == ring[-1]:
                    ring = ring + open_.pop(i)[1:]
                elif other[-1] == ring[-1]:
                    ring = ring + open_.pop(i)[::-1][1:]
                else:
                    continue
                break
            else:
                break
        if len(ring) > 3 and ring[0] == ring[-1]:
            rings.append(ring)
    return rings


def ring_centroid(ring: list[tuple[float, float]]) -> tuple[float, float, float]:
    """Centroid and signed area."""
    area = x = y = 0.0
    for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
        cross = x1 * y2 - x2 * y1
        area, x, y = area + cross / 2, x + (x1 + x2) * cross / 6, y + (y1 + y2) * cross / 6
    if area == 0:
        return ring[0][0], ring[0][1], 0.0
    return x / area, y / area, area


def _inside(x: float, y: float, rings: list[list[tuple[float, float]]]) -> bool:
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            if (y1 > y) != (y2 > y) and x < (y - y1) * (x2 - x1) / (y2 - y1) + x1:
                odd = not odd
    return odd


def inner_point(outer: list[list], inner: list[list]) -> tuple[float, float] | None:
    """The centroid of the greatest ring, or where that is outside, the middle of the widest stretch at its height."""
    if not outer:
        return None
    big = max(outer, key=lambda r: abs(ring_centroid(r)[2]))
    x, y, _ = ring_centroid(big)
    rings = [*outer, *inner]
    if _inside(x, y, rings):
        return x, y
    cuts = sorted((y - y1) * (x2 - x1) / (y2 - y1) + x1 for r in rings for (x1, y1), (x2, y2) in zip(r, r[1:]) if (y1 > y) != (y2 > y))
    if len(cuts) < 2:
        return big[0]
    a, b = max(zip(cuts[::2], cuts[1::2]), key=lambda p: p[1] - p[0])
    return (a + b) / 2, y


def representative_points(parts: DataFrame) -> DataFrame:
    """id, lon, lat, missing, closed of relation_parts; lists of one relation only are in memory at a time."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for own in f["parts"]:
                lines = {"inner": [], "outer": []}
                for p in own if own is not None else []:
                    lines["inner" if p["role"] == "inner" else "outer"].append([(c["lon"], c["lat"]) for c in p["coords"]])
                outer, inner = joined_rings(lines["outer"]), joined_rings(lines["inner"])
                at = inner_point(outer, inner)
                if at is None and lines["outer"]:
                    first = lines["outer"][0]
                    at = first[len(first) // 2]
                out.append((at[0] if at else None, at[1] if at else None, bool(outer)))
            yield pd.DataFrame({"id": f["id"], "lon": [o[0] for o in out], "lat": [o[1] for o in out], "missing": f["missing"], "closed": [o[2] for o in out]})

    return parts.mapInPandas(run, "id long, lon double, lat double, missing long, closed boolean")
