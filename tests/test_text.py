import pytest
from pyspark.sql import functions as F

from geoloom.functions import text


@pytest.fixture(scope="module")
def of(spark):
    def run(function, value, *more, kind="string"):
        return spark.createDataFrame([(value,)], f"v {kind}").select(function(F.col("v"), *more).alias("x")).first()["x"]

    return run


@pytest.mark.parametrize(
    "value, want",
    [
        ("15:00〜19:00", ("15:00", "19:00", "15:00-19:00", None)),
        ("１５：００～", ("15:00", None, "15:00-", None)),
        ("9:30 応相談", ("09:30", None, "09:30", "応相談")),
        ("1500", ("15:00", None, "15:00", None)),
        ("2560", (None, None, None, "2560")),
        ("要確認", (None, None, None, "要確認")),
    ],
)
def test_time_range(of, value, want):
    assert tuple(of(text.time_range, value)) == want


def test_clock_beyond_midnight(of):
    got = of(text.day_time, "22:00-25:30")
    assert (got.start, got.end, got.start_day_offset, got.end_day_offset) == ("22:00", "01:30", 0, 1)
    bad = of(text.day_time, "31:00")
    assert (bad.time, bad.start, bad.notes) == (None, None, "31:00")
    until = of(lambda c: text.day_time(c, True), "9:00まで")
    assert (until.start, until.end, until.notes) == (None, "09:00", "by")


def test_rooms(of):
    got = of(text.rooms, "ﾄﾞﾐﾄﾘｰ2人 1部屋. 個室 ２部屋")
    assert (got.types, got.room_count) == (["ドミトリー", "個室"], 3)
    assert of(text.rooms, "相部屋 16人").room_count is None
    both = of(lambda c: text.rooms_with_total(c, F.lit(None)), "全5室 個室3室")
    assert (both.types, both.room_count) == (["private"], 5)


def test_breakfast_inherits_a_later_time(of):
    got = of(text.meals, "朝食 、 夕食 (18:00)")
    assert (got.breakfast.start, got.dinner.start) == ("18:00", "18:00")
    none = of(text.meals, "なし")
    assert not none.breakfast.available and not none.dinner.available


def test_payment(of):
    got = of(text.payment, "現金 、 カード （viza/JCB/AE）")
    assert (got.methods, got.cards) == (["cash", "card"], ["VISA", "JCB", "AE"])
    assert of(text.payment, "CAED").cards == []


def test_route(of):
    got = of(text.route, "こちらは １番霊山寺 から 2番極楽寺 へのお宿です。")
    assert (got.from_temple.number, got.from_temple.name, got.to_temple.number) == (1, "霊山寺", 2)
    assert of(text.route, "番外").from_temple is None


def test_half_kana_and_punctuation(of):
    assert of(text.normalize_half_kana, "ｶﾞｲﾄﾞ ﾎﾟｽﾄ") == "ガイド ポスト"
    assert of(text.clean_punct, "朝食 (7:00) 、 夕食") == "朝食 (7:00)、夕食"
    assert of(text.clean_punct, "現金 、 カード （VISA）") == "現金、カード（VISA）"


@pytest.mark.parametrize("value, want", [("可", "available"), ("不可", "unavailable"), (None, "not_provided"), ("  ", "not_provided"), ("？", "unknown"), ("設定無し", "not_applicable"), ("ー", "not_provided")])
def test_tri_state(of, value, want):
    assert of(text.tri_state, value) == want


def test_keyed_states(of):
    keys = {"洗濯機": ("washer",), "乾燥機": ("dryer",), "両方": ("washer", "dryer")}
    got = of(lambda c: text.keyed_states(c, keys, True), "※洗濯機：200円|乾燥機: なし\n洗濯機: 可")
    assert (got.washer, got.dryer) == ("available", "unavailable")
    assert of(lambda c: text.keyed_state_issues(c, keys), "洗濯機: 可|庭: 可|xyz") == ["庭: 可", "xyz"]


@pytest.mark.parametrize(
    "value, want",
    [
        ("素泊まり：5,000円", [("素泊まり：", "priced", 5000, 5000, "room_only")]),
        ("5000〜7000円", [("5000〜", "priced", 5000, 7000, None)]),
        ("5000円〜", [(None, "priced", 5000, None, None)]),
        ("未確認", [(None, "unknown", None, None, None)]),
        ("無料（要予約）", [(None, "free", 0, 0, None)]),
        ("個室 6000円、ドミトリー 3000円", [("個室", "priced", 6000, 6000, None), ("ドミトリー", "priced", 3000, 3000, None)]),
    ],
)
def test_prices(of, value, want):
    got = [(i.label, i.status, i.amount_yen, i.max_amount_yen, i.meal_plan) for i in of(text.prices, value)]
    assert got == [(w[0].rstrip("：") if w[0] else None, *w[1:]) for w in want]


def test_parking(of):
    got = of(text.parking, "３台 無料（要予約）")
    assert (got.space_count, got.fee_status, got.reservation_required, got.notes) == (3, "free", True, None)


def test_urls(of):
    assert tuple(of(text.image_url, "https://a/b.jpg?1")) == ("https://a/b.jpg", "https://a/b.jpg?1")
    assert of(text.marker, "x!8m2!3d33.5!4d-134.25") == (-134.25, 33.5)
    assert of(lambda c: text.query_value(c, "mid"), "https://x.y/z?mid=7&a=b") == "7"


def test_name_keys(of):
    assert of(text.name_key, "Ｔｅｓｔ・ 名（一）") == "test名一"
    assert of(text.trail_key, "「Ａ」 Ｂ") == "ab"


def test_nulls_stay_null(of):
    for f in (text.normalize_digits, text.clean_punct, text.collapsed, text.star_count, text.distance_km, text.modified_date):
        assert of(f, None) is None


@pytest.mark.parametrize("made, most", [(text.meals, 40), (text.payment, 40), (text.prices, 90)])
def test_a_text_is_read_once(spark, made, most):
    """Each regular expression stands once in the expression, not once for every value that is derived from it."""
    plan = spark.range(1).select(made(F.col("id").cast("string")).alias("x"))._jdf.queryExecution().analyzed().toString()
    n = plan.count("rlike") + plan.count("RLIKE") + plan.count("regexp_")
    assert n <= most, n
