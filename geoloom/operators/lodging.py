"""Version-1 records of both lodging sources, temples, and integrity checks: one projection each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo, text

# Vocabularies of the two sources.
PREFECTURES = {"tokushima": "徳島県", "kochi": "高知県", "ehime": "愛媛県", "kagawa": "香川県"}
ROW_STATUS = {"休業": "temporarily_closed", "閉業": "permanently_closed"}
ICONS = {
    "wash_g.png": "washing_machine", "dry_g.png": "dryer", "wifi_g.png": "wifi", "wc_g.png": "toilet", "bathtub_g.png": "bath",
    "sougei_g.png": "shuttle", "parking_g.png": "parking", "card_g.png": "card_payment",
}
KINDS = {
    "民宿･ゲストハウス": ("guesthouse",), "民宿・ゲストハウス": ("guesthouse",), "宿坊": ("temple_lodging",), "旅館": ("ryokan",), "ホテル": ("hotel",), "ビジネスホテル": ("hotel",),
    "旅館･ホテル": ("ryokan", "hotel"), "旅館・ホテル": ("ryokan", "hotel"), "通夜堂･善根宿": ("pilgrim_shelter",), "通夜堂・善根宿": ("pilgrim_shelter",), "キャンプ場": ("campground",),
}
BOTH = ("washing_machine", "dryer")
LAUNDRY = {"洗濯機": ("washing_machine",), "乾燥機": ("dryer",), "洗濯+乾燥機": BOTH, "洗濯機+乾燥機": BOTH, "洗濯乾燥": BOTH, "洗濯乾燥機": BOTH}
PAYMENT = {"現金": ("cash",), "カード": ("credit_card",), "クレジットカード": ("credit_card",), "電子マネー": ("electronic_money",), "電子決済": ("electronic_money",)}
NOTHING = ("", "未確認", "なし", "設定なし", "設定無し", "対象外", "ー")
NEGATIVE = "なし|ありません|不可|禁止|利用できません|ご遠慮|未確認"
WARNING = "array<struct<field:string,code:string,message:string,raw_value:string>>"


def of(table: dict[str, str], key: Column) -> Column:
    pairs = [F.lit(x) for p in table.items() for x in p]
    return F.try_element_at(F.create_map(*pairs), key)


def warning(field: str, code: str, message: str, value: Column) -> Column:
    return F.struct(F.lit(field).alias("field"), F.lit(code).alias("code"), F.lit(message).alias("message"), value.cast("string").alias("raw_value"))


def warned(condition: Column, item: Column) -> Column:
    return F.when(F.coalesce(condition, F.lit(False)), F.array(item)).otherwise(F.array().cast(WARNING))


def each(items: Column, make) -> Column:
    return F.coalesce(F.transform(items, make), F.array().cast(WARNING))


def has_text(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) != ""


def without_placeholder(c: Column) -> Column:
    """Null for words that say that there is no value; other values as they are."""
    return F.when(~F.coalesce(text.stripped(c), F.lit("")).isin(*NOTHING), c)


def inns_v1(raw: DataFrame, provider: str, retrieved_at: Column | None = None) -> DataFrame:
    """Version-1 records of the first source's raw rows."""
    c, sc = F.col, lambda n: F.col(f"source_context.{n}")
    room, meal, way, pay = text.rooms(c("room")), text.meals(c("meal")), text.route(c("route")), text.payment(c("payment"))

    def stay(name: str) -> Column:
        t = text.time_range(c(name))
        return F.struct(t.time.alias("time"), t.start.alias("start"), t.end.alias("end"), t.notes.alias("notes"), text.collapsed(c(name)).alias("raw_text")).alias(name)

    lines = F.filter("pricing_items", lambda x: ~x.startswith("支払い方法"))
    unknown_icon = F.filter("facilities", lambda f: of(ICONS, f.icon).isNull())
    no_meal = has_text(c("meal")) & ~(meal.breakfast.available | meal.dinner.available) & ~c("meal").contains("なし")
    warnings = F.concat(
        warned(no_meal, warning("meals", "UNRECOGNIZED_FORMAT", "Could not recognize meal availability.", c("meal"))),
        warned(has_text(c("route")) & way.from_temple.isNull(), warning("henro.route", "UNRECOGNIZED_FORMAT", "Could not safely parse temple route.", c("route"))),
        each(unknown_icon, lambda f: warning("facilities", "UNKNOWN_FACILITY", "Unmapped facility icon.", f.icon)),
        each(c("extra_details"), lambda d: warning("details", "UNKNOWN_DETAIL_FIELD", "Unknown 宿詳細 field.", d.label)),
    )
    none = F.lit(None).cast("string")
    return raw.select(
        F.lit(1).alias("schema_version"),
        F.struct(F.lit(provider).alias("provider"), none.alias("source_id"), none.alias("source_url"), (retrieved_at if retrieved_at is not None else none).alias("retrieved_at")).alias("source"),
        F.struct(c("name"), none.alias("name_kana")).alias("identity"),
        of(ROW_STATUS, sc("row_status")).alias("business_status"),
        "description",
        "notice",
        F.struct(way.from_temple.alias("from_temple"), way.to_temple.alias("to_temple"), text.collapsed(c("route")).alias("raw_route_text")).alias("henro"),
        F.struct(room.types.alias("types"), room.room_count.alias("room_count"), c("room").alias("raw_text")).alias("rooms"),
        F.struct(meal.breakfast.alias("breakfast"), meal.dinner.alias("dinner"), text.clean_punct(c("meal")).alias("raw_text")).alias("meals"),
        stay("check_in"),
        stay("check_out"),
        F.transform("facilities", lambda f: F.struct(of(ICONS, f.icon).alias("type"), f.available.alias("available"), f.remark.alias("label"), f.icon.alias("source_icon"))).alias("facilities"),
        F.struct(F.array().cast("array<string>").alias("prices"), text.empty_to_null(F.array_join(lines, "\n")).alias("raw_text")).alias("pricing"),
        F.struct(pay.methods.alias("methods"), pay.cards.alias("cards"), text.clean_punct(c("payment")).alias("raw_text")).alias("payment"),
        F.struct("phone", "website", "email").alias("contact"),
        F.struct(
            of(PREFECTURES, sc("prefecture")).alias("prefecture"), none.alias("address"),
            F.when(has_text(c("google_maps_search_url")), "pending_geocode").otherwise("source_data_incomplete").alias("map_data_status"), "google_maps_search_url", "google_maps_embed_url",
        ).alias("location"),
        F.transform("images", text.image_url).alias("images"),
        warnings.alias("_warnings"),
    )


def lodgings_v1(raw: DataFrame, provider: str, retrieved_at: Column | None = None) -> DataFrame:
    """Version-1 records of the second source's raw rows; a malformed field gives a warning, never a lost row."""
    c, ctx = F.col, lambda n: F.col(f"source_context.{n}")
    basic = lambda k: F.try_element_at("basic_data", F.lit(k))
    none = F.lit(None).cast("string")
    marker = ctx("closure_marker")
    kinds = F.create_map(*[x for k, v in KINDS.items() for x in (F.lit(k), F.array(*[F.lit(y) for y in v]))])
    terms = F.coalesce("lodging_types", F.array().cast("array<string>"))
    laundry, pay = text.keyed_states(basic("laundry"), LAUNDRY, True), text.keyed_states(basic("payment"), PAYMENT)
    methods = F.when(has_text(text.stripped(basic("emoney"))) & ~text.is_tri_state(basic("emoney")), F.filter(F.transform(F.split(basic("emoney"), ","), text.stripped), lambda x: x != ""))
    methods = F.coalesce(methods, F.array().cast("array<string>"))
    more = F.filter(F.coalesce("supplemental_facilities", F.array().cast("array<string>")), lambda x: ~text.stripped(x).isin("", "ー"))
    facility = lambda kind, status, label, own: F.struct(kind.alias("type"), status.alias("status"), label.alias("label"), own.alias("raw_text"))
    facilities = F.concat(
        F.array(
            facility(F.lit("wifi"), text.tri_state(basic("wifi")), none, basic("wifi")),
            facility(F.lit("washing_machine"), laundry.washing_machine, none, basic("laundry")),
            facility(F.lit("dryer"), laundry.dryer, none, basic("laundry")),
        ),
        F.transform(more, lambda x: facility(F.lit("supplemental"), F.when(x.rlike(NEGATIVE), "unknown").otherwise("available"), x, x)),
    )
    first = F.get("route_lines", F.lit(0))
    side = lambda s: text.route_temple(first[f"{s}num"], first[f"{s}name"], first[f"{s}km"])
    listed = text.route_temple(ctx("temple_context.number").cast("string"), ctx("temple_context.name"), none, "list_context")
    previous = F.when(first.isNull(), listed).otherwise(side("l"))
    following = F.when(first.isNotNull(), side("r"))
    bad_km = lambda t, s: t.isNotNull() & t.distance_km.isNull() & has_text(first[f"{s}km"])
    prices = text.prices(basic("price"))
    name = F.coalesce(text.empty_to_null(c("name")), ctx("list_name"))
    can_search = has_text(c("google_maps_place_embed_url")) | (has_text(name) & has_text(basic("address")))
    odd = "Could not safely normalize "
    warnings = F.concat(
        F.coalesce(c("parser_warnings").cast(WARNING), F.array().cast(WARNING)),
        each(F.filter(terms, lambda t: ~t.isin(*KINDS)), lambda t: warning("lodging_types", "UNKNOWN_TAXONOMY", f"Unknown {provider} lodging taxonomy.", t)),
        warned(has_text(basic("wifi")) & ~text.is_tri_state(basic("wifi")), warning("facilities.wifi", "UNRECOGNIZED_FORMAT", odd + "tri-state value.", basic("wifi"))),
        each(text.keyed_state_issues(basic("laundry"), LAUNDRY, True), lambda i: warning("laundry", "UNRECOGNIZED_FORMAT", odd + "keyed label or value.", i)),
        each(text.keyed_state_issues(basic("payment"), PAYMENT), lambda i: warning("payment", "UNRECOGNIZED_FORMAT", odd + "keyed label or value.", i)),
        warned(bad_km(previous, "l"), warning("henro.previous_temple.distance_km", "UNRECOGNIZED_FORMAT", odd + "route distance.", first["lkm"])),
        warned(bad_km(following, "r"), warning("henro.next_temple.distance_km", "UNRECOGNIZED_FORMAT", odd + "route distance.", first["rkm"])),
        each(F.filter(prices, lambda p: p.status == "ambiguous"), lambda p: warning("pricing.items", "UNRECOGNIZED_FORMAT", odd + "price item.", p.raw_text)),
        *[warned(text.has_invalid_clock(basic(f)), warning(f, "UNRECOGNIZED_FORMAT", "Invalid clock value was not normalized.", basic(f))) for f in ("checkin", "checkout")],
    )
    return raw.select(
        F.lit(1).alias("schema_version"),
        F.struct(F.lit(provider).alias("provider"), ctx("source_id").alias("source_id"), ctx("source_url").alias("source_url"), (retrieved_at if retrieved_at is not None else none).alias("retrieved_at"), text.modified_date(F.regexp_replace("modified_text", "[\\s　]+", "")).alias("source_modified_at")).alias("source"),
        F.struct(name.alias("name"), none.alias("name_kana")).alias("identity"),
        F.when(marker.contains("休業") & marker.contains("閉業"), "closed_or_suspended").alias("business_status"),
        F.struct(c("editorial_title").alias("title"), c("editorial_description").alias("text"), F.lit(f"{provider}_editorial").alias("provenance")).alias("description"),
        F.struct(previous.alias("previous_temple"), following.alias("next_temple"), F.coalesce("route_lines").alias("raw_route_data")).alias("henro"),
        F.array_distinct(F.flatten(F.array_compact(F.transform(terms, lambda t: F.try_element_at(kinds, t))))).alias("lodging_types"),
        text.rooms_with_total(basic("rooms"), basic("price")).alias("rooms"),
        F.struct(prices.alias("items"), text.price_notes(basic("price")).alias("notes"), basic("price").alias("raw_text")).alias("pricing"),
        text.day_time(basic("checkin")).alias("check_in"),
        text.day_time(basic("checkout"), True).alias("check_out"),
        text.parking(basic("parking")).alias("parking"),
        facilities.alias("facilities"),
        F.struct(
            pay.cash.alias("cash"), pay.credit_card.alias("credit_card"), F.when(F.size(methods) > 0, "available").otherwise(pay.electronic_money).alias("electronic_money"),
            methods.alias("electronic_money_methods"), basic("payment").alias("raw_text"), basic("emoney").alias("electronic_money_raw_text"),
        ).alias("payment"),
        F.struct(*[without_placeholder(basic(k)).alias(n) for n, k in (("phone", "tel"), ("website", "website"), ("email", "email"))]).alias("contact"),
        F.struct(
            F.coalesce(of(PREFECTURES, ctx("prefecture")), ctx("prefecture")).alias("prefecture"), basic("address").alias("address"),
            F.when(can_search, "pending_geocode").otherwise("source_data_incomplete").alias("map_data_status"), "google_maps_place_embed_url", "google_street_view_embed_url", "google_maps_directions_url",
        ).alias("location"),
        text.images(c("featured_image_url"), c("gallery_image_urls")).alias("images"),
        warnings.alias("_warnings"),
    )


def temples(spots: DataFrame) -> DataFrame:
    """Temples of spots (spot map, content map): padded id, names, place, sect, history."""
    s = lambda k: text.empty_to_null(F.trim(F.try_element_at("spot", F.lit(k))))
    t = lambda k: text.empty_to_null(F.trim(F.try_element_at("content", F.lit(k))))
    pair = lambda k, n: F.struct(t(f"{k}_ja").alias("ja"), t(f"{k}_en").alias("en")).alias(n)
    names = lambda k, n: F.struct(t(f"{k}_name_ja").alias("ja"), t(f"{k}_name_en").alias("en"), t(f"{k}_name_kana_ja").alias("kana")).alias(n)
    number = s("number").cast("int")
    return spots.select(
        F.format_string("temple-%03d", number).alias("id"), number.alias("number"), names("short", "name"), names("long", "full_name"),
        F.struct(s("latitude").cast("double").alias("latitude"), s("longitude").cast("double").alias("longitude")).alias("location"),
        F.struct(s("post_code").alias("postal_code"), s("pref").alias("prefecture"), s("address_ja").alias("ja"), s("address_en").alias("en")).alias("address"),
        t("tel_ja").alias("phone"),
        F.struct(pair("honzon", "principal_deity"), pair("syuha", "sect"), pair("kaiki", "founder"), pair("souken", "founded"), t("syukubou_ja").startswith("あり").alias("has_lodging")).alias("temple"),
        pair("rekishiyurai", "history"), s("eyecatch").alias("eyecatch"), s("modified").alias("modified_at"),
    )


def resolved_points(v1: DataFrame) -> DataFrame:
    """Records whose place is resolved and whose coordinates are valid."""
    lat, lon = F.col("location.coordinates.latitude"), F.col("location.coordinates.longitude")
    return v1.where((F.col("location.map_data_status") == "resolved") & lat.between(-90, 90) & lon.between(-180, 180))


def misplaced(v1: DataFrame) -> DataFrame:
    """Integrity violations of geocoded records: (id, rule)."""
    at, status = F.col("location.coordinates"), F.col("location.map_data_status")
    rule = F.when((status != "resolved") & at.isNotNull(), "unresolved record keeps coordinates").when((status == "resolved") & ~F.coalesce(geo.in_region(at.latitude, at.longitude), F.lit(False)), "resolved coordinates lie outside the region")
    return v1.select(F.col("source.source_id").alias("id"), rule.alias("rule")).where("rule IS NOT NULL")


def archive_violations(index: DataFrame, details: DataFrame, raw: DataFrame, v1: DataFrame) -> DataFrame:
    """(id, rule) of an archive: repeated or missing ids, failed fetches, checksums that differ, stages that lost rows."""
    ids = index.select(F.col("source_id").alias("id"))
    one = lambda df, rule: df.select(F.col("id").cast("string").alias("id"), F.lit(rule).alias("rule"))
    d = details.select(F.col("source_id").alias("id"), "status", "sha256", "content")
    found = [
        one(ids.groupBy("id").count().where("count > 1"), "index repeats an id"),
        one(ids.join(d, "id", "left_anti"), "no detail entry"),
        one(d.where(~F.col("status").isin("fetched", "skipped")), "detail was not fetched"),
        one(d.where(F.col("content").isNotNull() & ~F.sha2("content", 256).eqNullSafe(F.col("sha256"))), "detail checksum differs"),
        one(ids.join(raw.select(F.col("source_context.source_id").alias("id")), "id", "left_anti"), "raw record is missing"),
        one(ids.join(v1.select(F.col("source.source_id").alias("id")), "id", "left_anti"), "version-1 record is missing"),
    ]
    out = found[0]
    for f in found[1:]:
        out = out.unionAll(f)
    return out


def index_violations(index: DataFrame, prefectures: tuple[str, ...], summary: dict[str, int] | None = None) -> DataFrame:
    """(id, rule) of index rows (source_id, source_url, canonical_url, list_order, prefecture, temple_number).

    summary holds the counts of fetched, skipped and failed details; rules about the whole index have a null id.
    """
    one = lambda df, rule: df.select(F.col("source_id").cast("string").alias("id"), F.lit(rule).alias("rule"))
    whole = index.agg(F.count("*").alias("n"), F.collect_set("prefecture").alias("p")).select(F.lit(None).cast("string").alias("source_id"), "n", "p")
    found = [
        one(index.where(~F.col("source_url").eqNullSafe(F.col("canonical_url"))), "source url does not match the id"),
        one(index.where(~F.col("temple_number").between(1, 88)), "temple number is not of 1 to 88"),
        one(whole.where(F.size(F.array_except(F.array(*[F.lit(p) for p in prefectures]), "p")) > 0), "a prefecture is missing"),
    ]
    if summary is not None:
        found.append(one(whole.where(F.col("n") != sum(summary.get(k, 0) for k in ("fetched", "skipped", "failed"))), "detail counts differ from the index"))
    out = found[0]
    for f in found[1:]:
        out = out.unionAll(f)
    return out
