from pyspark.sql import functions as F

from geoloom.operators import lodging, trail

RAW1 = """source_context struct<prefecture:string,table_kind:string,row_status:string>, name string, description string, route string, notice string, room string, meal string,
check_in string, check_out string, payment string, phone string, website string, email string, facilities array<struct<icon:string,remark:string,available:boolean>>, pricing_items array<string>,
google_maps_search_url string, google_maps_embed_url string, images array<string>, extra_details array<struct<label:string,value:string>>"""


def test_inns(spark):
    row = (("ehime", "temple", "休業"), "宿", None, "番外", None, "個室 2部屋", "朝食 、 夕食(18:00)", "15:00〜", None, "現金", "1", None, None, [("wifi_g.png", None, True), ("x.png", None, False)], ["一泊 5000円", "支払い方法: 現金"], "u", None, ["a?b"], [("新", "v")])
    r = lodging.inns_v1(spark.createDataFrame([row], RAW1), "one").first()
    assert (r.business_status, r.rooms.room_count, r.check_in.time, r.check_out.time) == ("temporarily_closed", 2, "15:00-", None)
    assert (r.location.prefecture, r.location.map_data_status, r.pricing.raw_text) == ("愛媛県", "pending_geocode", "一泊 5000円")
    assert [f.type for f in r.facilities] == ["wifi", None] and r.images[0].url == "a"
    assert [w.code for w in r._warnings] == ["UNRECOGNIZED_FORMAT", "UNKNOWN_FACILITY", "UNKNOWN_DETAIL_FIELD"]


RAW2 = """source_context struct<source_id:string,source_url:string,list_name:string,prefecture:string,closure_marker:string,temple_context:struct<number:int,name:string>>, basic_data map<string,string>, lodging_types array<string>,
supplemental_facilities array<string>, route_lines array<struct<lnum:string,lname:string,lkm:string,rnum:string,rname:string,rkm:string>>, name string, editorial_title string, editorial_description string, modified_text string,
google_maps_place_embed_url string, google_street_view_embed_url string, google_maps_directions_url string, featured_image_url string, gallery_image_urls array<string>, parser_warnings array<struct<field:string,code:string,message:string,raw_value:string>>"""


def test_lodgings(spark):
    basic = {"wifi": "あり", "laundry": "洗濯機：200円|庭:可", "payment": "現金:可|カード:不可", "emoney": "PayPay, Suica", "price": "素泊まり：5,000円|：", "checkin": "31:00", "checkout": "9:00まで", "tel": "なし", "address": "x", "rooms": "全5室", "parking": "3台 無料"}
    row = (("7", "u", "L", "kochi", "《休業･閉業》", (5, "五")), basic, ["旅館・ホテル", "城"], ["犬は不可", "ー", "庭"], [("１", "a", "２．５", "3", "b", "?")], None, None, None, "2026年 8月 1日", None, None, None, "f?1", ["g"], None)
    empty = (None, None, None, None, None, None, None, None, None, None, None, None, None, None, None)
    a, b = lodging.lodgings_v1(spark.createDataFrame([row, empty], RAW2), "two").collect()
    assert (a.business_status, a.lodging_types, a.identity.name) == ("closed_or_suspended", ["ryokan", "hotel"], "L")
    assert (a.henro.previous_temple.number, a.henro.next_temple.distance_km) == (1, None)
    assert (a.payment.cash, a.payment.credit_card, a.payment.electronic_money, a.payment.electronic_money_methods) == ("available", "unavailable", "available", ["PayPay", "Suica"])
    assert [(f.type, f.status) for f in a.facilities] == [("wifi", "available"), ("washing_machine", "available"), ("dryer", "not_provided"), ("supplemental", "unknown"), ("supplemental", "available")]
    assert (a.contact.phone, a.source.source_modified_at, a.check_out.end, [i.role for i in a.images]) == (None, "2026-08-01", "09:00", ["featured", "gallery"])
    fields = [w.field for w in a._warnings]
    assert {"lodging_types", "laundry", "henro.next_temple.distance_km", "checkin"} <= set(fields)
    assert b.location.map_data_status == "source_data_incomplete" and b._warnings == []


def test_archive_checks(spark):
    index = spark.createDataFrame([("1",), ("2",), ("2",)], "source_id string")
    details = spark.createDataFrame([("1", "fetched", "bad", b"x"), ("2", "failed", None, None)], "source_id string, status string, sha256 string, content binary")
    raw = spark.createDataFrame([(("1",),)], "source_context struct<source_id:string>")
    v1 = spark.createDataFrame([(("1",),), (("2",),)], "source struct<source_id:string>")
    got = {(r.id, r.rule) for r in lodging.archive_violations(index, details, raw, v1).collect()}
    assert got == {("2", "index repeats an id"), ("2", "detail was not fetched"), ("1", "detail checksum differs"), ("2", "raw record is missing")}


COURSE = "source_post_id int, prefecture string, photo_title string, spots array<struct<number:string,title:string>>, placemarks array<struct<name:string,geometry:array<struct<kind:string,coordinates:array<array<double>>>>>>"


def courses(spark, **change):
    line = ("LineString", [[133.0, 33.0], [133.1, 33.1]])
    point = lambda: [("Point", [[133.0, 33.0]])]
    row = {
        "source_post_id": 42, "prefecture": "ehime", "photo_title": "Ａ寺", "spots": [("1", "A寺"), ("2", "b"), ("3", "c")],
        "placemarks": [("r", [line, line]), ("a寺", point()), ("B", point()), ("b", point()), (None, point())],
    } | change
    return spark.createDataFrame([tuple(row.values())], COURSE)


def test_trail_links_and_counters(spark):
    own = trail.checked(courses(spark))
    assert [r.segment_id for r in trail.segments(own).orderBy("seg").collect()] == ["SNT_42_L001", "SNT_42_L002"]
    features = {r.id: (r.kind, r.content_id) for r in trail.poi_features(own).collect()}
    assert features["SNT_42_P0001"] == ("tourism_spot", "SNT_42_S001") and len(features) == 4
    total = trail.counters(own).where("prefecture IS NULL").first()
    assert (total.courses, total.route_segments, total.route_coordinate_points, total.kml_pois) == (1, 2, 4, 4)
    assert (total.linked_tourism_spots, total.unmatched_tourism_spots, total.unmatched_pois, total.ambiguous_names) == (1, 2, 3, 1)
    assert (total.photo_points, total.matched_photo_points) == (1, 1)


def test_counters_read_a_course_once(spark):
    two = courses(spark).unionAll(courses(spark, prefecture="kochi", placemarks=[("r", [("LineString", [[133.0, 33.0], [133.1, 33.1]])])])).unionAll(courses(spark, source_post_id=7, prefecture=None))
    counted = trail.counters(two)
    got = {r.prefecture: (r.courses, r.route_segments, r.linked_tourism_spots, r.ambiguous_names, r.photo_points, r.matched_photo_points) for r in counted.where("prefecture IS NOT NULL").collect()}
    assert got == {"ehime": (1, 2, 1, 1, 1, 1), "kochi": (1, 1, 0, 0, 1, 1)}
    total = counted.where("prefecture IS NULL").agg(*[F.max(c).alias(c) for c in counted.columns if c != "prefecture"]).first()
    assert (total.courses, total.linked_tourism_spots, total.ambiguous_names, total.matched_photo_points) == (3, 1, 2, 3)
    assert counted._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1  # it was 20


def test_poi_features_read_a_course_once(spark):
    point, line = ("Point", [[133.0, 33.0]]), ("LineString", [[133.0, 33.0], [133.1, 33.1]])
    odd = (
        courses(spark)
        .unionAll(courses(spark, source_post_id=7, prefecture=None))
        .unionAll(courses(spark, source_post_id=8, spots=[("1", "a"), ("2", "Ａ"), ("3", ""), ("4", "d"), ("5", None)], placemarks=[("a", [point]), (None, [point]), ("（）", [line, point, (None, None)]), ("d", None), ("Ｄ", [("Point", None)])]))
        .unionAll(courses(spark, source_post_id=9, placemarks=[("x", [line, point]), ("b", [line, point])]))
        .unionAll(courses(spark, source_post_id=9, prefecture="kochi", spots=None, placemarks=[("b", [point]), None, ("c", [point, line])]))
        .unionAll(courses(spark, source_post_id=9, spots=[("1", "c"), ("2", "x")], placemarks=[]))
        .unionAll(courses(spark, source_post_id=10, placemarks=None))
    )
    found = trail.poi_features(odd)
    own = trail.links(odd).where("linked").select(F.col("right_id").alias("id"), F.col("left_id").alias("content_id"))
    want = trail.pois(odd).join(own, "id", "left").select("id", "route_id", "name", F.when(F.col("content_id").isNotNull(), "tourism_spot").otherwise("kml_poi").alias("kind"), "content_id", "position")
    assert found.dtypes == want.dtypes
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(found) == rows(want)
    assert {r.id for r in found.where("kind = 'tourism_spot'").collect()} == {"SNT_42_P0001", "SNT_8_P0004", "SNT_9_P0002", "SNT_9_P0003"}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("ArrowEvalPython") == 1  # it was two joins and four


def test_fatal_courses(spark):
    import pytest

    for bad in ({"prefecture": ""}, {"placemarks": []}, {"placemarks": [("r", [("LineString", [[133.0, 99.0], [1.0, 1.0]])])]}):
        with pytest.raises(Exception, match="course 42"):
            trail.checked(courses(spark, **bad)).collect()
    two = courses(spark)
    with pytest.raises(Exception, match="duplicate"):
        trail.checked(two.unionAll(two)).collect()


def test_temples(spark):
    spots = spark.createDataFrame([({"number": "7", "latitude": "34.1", "longitude": "134.2", "pref": " x "}, {"short_name_ja": "寺", "syukubou_ja": "ありません?"})], "spot map<string,string>, content map<string,string>")
    r = lodging.temples(spots).first()
    assert (r.id, r.name.ja, r.address.prefecture, r.temple.has_lodging) == ("temple-007", "寺", "x", True)
