"""Scalar text functions: Japanese forms, times, rooms, meals, prices, states, urls.

All are Column expressions; ``name_key`` alone needs Python (Spark has no Unicode normalisation).
"""

from __future__ import annotations

import unicodedata
from functools import reduce
from itertools import accumulate

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Character tables.
WIDE_DIGITS, DIGITS = "０１２３４５６７８９：", "0123456789:"
HALF_KANA = "ｱｲｳｴｵｶｷｸｹｺｻｼｽｾｿﾀﾁﾂﾃﾄﾅﾆﾇﾈﾉﾊﾋﾌﾍﾎﾏﾐﾑﾒﾓﾔﾕﾖﾗﾘﾙﾚﾛﾜｦﾝｯｬｭｮ"
FULL_KANA = "アイウエオカキクケコサシスセソタチツテトナニヌネノハヒフヘホマミムメモヤユヨラリルレロワヲンッャュョ"
VOICED = (("カキクケコサシスセソタチツテトハヒフヘホ", "ガギグゲゴザジズゼゾダヂヅデドバビブベボ", "ﾞ゛"), ("ハヒフヘホ", "パピプペポ", "ﾟ゜"))
TRAIL_MARKS = "()（）[]［］「」『』【】〔〕〈〉《》・･、，,。．."
SEPARATOR = "[-~〜～–]"
# Words and what they stand for, in order of precedence.
STATES = (
    ("可", "available"), ("あり", "available"), ("OK", "available"), ("◯", "available"), ("○", "available"),
    ("不可", "unavailable"), ("なし", "unavailable"), ("NG", "unavailable"), ("未確認", "unknown"),
    ("対象外", "not_applicable"), ("設定なし", "not_applicable"), ("設定無し", "not_applicable"),
    ("—", "not_provided"), ("–", "not_provided"), ("ー", "not_provided"),
)
PRICE_STATES = (("未確認", "unknown"), ("設定なし", "not_applicable"), ("設定無し", "not_applicable"), ("なし", "unavailable"), ("無料", "free"), ("応相談", "negotiable"))
ROOM_WORDS = "個室|相部屋|ドミトリー|ﾄﾞﾐﾄﾘｰ|和洋室|洋室|和室|キャビン|コテージ|貸し切り|別棟"
ROOM_KINDS = (("個室", "private"), ("ドミトリー", "dormitory"), ("ﾄﾞﾐﾄﾘｰ", "dormitory"), ("相部屋", "shared"))
MEAL_PLANS = (("素泊り", "room_only"), ("素泊まり", "room_only"), ("朝食付", "breakfast"), ("夕食付", "dinner"), ("2食付", "two_meals"), ("２食付", "two_meals"))
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;"))


def empty_to_null(x: Column) -> Column:
    return F.nullif(x, F.lit(""))


def stripped(x: Column) -> Column:
    """Without white space (Unicode) at both ends."""
    return F.regexp_replace(x, "(?U)^\\s+|\\s+$", "")


def collapsed(x: Column) -> Column:
    """White space runs as one blank, ends stripped, empty as null."""
    return empty_to_null(F.trim(F.regexp_replace(x, "(?U)\\s+", " ")))


def normalize_digits(x: Column) -> Column:
    return F.translate(x, WIDE_DIGITS, DIGITS)


def whole_number(x: Column) -> Column:
    return normalize_digits(stripped(x)).try_cast("int")


def normalize_half_kana(x: Column) -> Column:
    def voiced_(out: Column) -> Column:
        for plain, voiced, marks in VOICED:
            for a, b in zip(plain, voiced):
                out = F.regexp_replace(out, f"{a}[{marks}]", b)
        return out

    marked = "[" + "".join(marks for _, _, marks in VOICED) + "]"
    return let(F.translate(x, HALF_KANA, FULL_KANA), lambda t: F.when(t.rlike(marked), voiced_(t)).otherwise(t))


def clean_punct(x: Column) -> Column:
    """No blanks around Japanese commas, stops and inside full-width brackets; other runs as one."""
    tight = F.regexp_replace(F.regexp_replace(x, "[ \\t]+(?=[、。，（）])", ""), "(?<=[、。，（])[ \\t]+", "")
    return stripped(F.regexp_replace(tight, "[ \\t]+", " "))


def first_state(x: Column, table, default: str | None) -> Column:
    """What the first prefix of the table that x starts with stands for."""
    found = reduce(lambda rest, pair: F.when(x.startswith(pair[0]), pair[1]).otherwise(rest), reversed(table), F.lit(default))
    return found


def first_contained(x: Column, table) -> Column:
    return reduce(lambda rest, pair: F.when(x.contains(pair[0]), pair[1]).otherwise(rest), reversed(table), F.lit(None).cast("string"))


def tri_state(x: Column) -> Column:
    value = stripped(x)
    return F.when(F.coalesce(value, F.lit("")) == "", "not_provided").otherwise(first_state(value, STATES, "unknown"))


def is_tri_state(x: Column) -> Column:
    value = stripped(F.coalesce(x, F.lit("")))
    return reduce(lambda a, b: a | b, [value.startswith(p) for p, _ in STATES])


def is_amount(x: Column) -> Column:
    return stripped(normalize_digits(F.coalesce(x, F.lit("")))).rlike("^(?:無料|\\d[\\d,]*\\s*円)")


def labelled_items(x: Column) -> Column:
    """array<struct<label, value, item>> of ``label:value`` items between bars or line ends."""
    pattern = "(?Us)^\\s*([^:：]+?)\\s*[:：]\\s*(.*?)\\s*$"
    items = F.filter(F.split(F.coalesce(x, F.lit("")), "[|\\r\\n]+"), lambda i: stripped(i) != "")
    label = lambda i: stripped(F.regexp_replace(F.regexp_extract(i, pattern, 1), "^※+", ""))
    return F.transform(items, lambda i: F.struct(empty_to_null(label(i)).alias("label"), F.when(i.rlike(pattern), F.regexp_extract(i, pattern, 2)).alias("value"), i.alias("item")))


def let(x: Column, of) -> Column:
    """of(x) with x worked out once per row."""
    return F.get(F.transform(F.array(x), of), F.lit(0))


def keyed_states(x: Column, keys: dict[str, tuple[str, ...]], amounts: bool = False) -> Column:
    """struct of a state for each target key; the last item with a label wins."""

    def state(value: Column) -> Column:
        plain = lambda p: F.when(F.lit(amounts) & (p == "unknown") & is_amount(value), "available").otherwise(p)
        return let(tri_state(value), plain)

    targets: dict[str, list[str]] = {}
    for label, names in keys.items():
        for name in names:
            targets.setdefault(name, []).append(label)

    def of(items: Column) -> Column:
        own = lambda label: let(F.filter(items, lambda i: i.label == label), lambda got: F.when(F.size(got) > 0, state(F.try_element_at(got, F.lit(-1)).value)))
        return F.struct(*[F.coalesce(*[own(x_) for x_ in reversed(labels)], F.lit("not_provided")).alias(name) for name, labels in targets.items()])

    return let(labelled_items(x), of)


def keyed_state_issues(x: Column, keys, amounts: bool = False) -> Column:
    """Items that have no label, an unknown one, or a value that is no state."""
    known = lambda i: F.coalesce(i.label.isin(*keys), F.lit(False)) & (is_tri_state(i.value) | (F.lit(amounts) & is_amount(i.value)))
    return F.transform(F.filter(labelled_items(x), lambda i: ~known(i)), lambda i: i.item)


# Times.


def _clock(text: Column, pattern: str, hour: int, minute: int) -> Column:
    return F.concat(F.lpad(F.regexp_extract(text, pattern, hour), 2, "0"), F.lit(":"), F.regexp_extract(text, pattern, minute))


def _times(text: Column, anchor: str, compact: bool) -> Column:
    rest = "(.*)$"
    span = f"(?s){anchor}(\\d{{1,2}}):(\\d{{2}})\\s*{SEPARATOR}\\s*(\\d{{1,2}}):(\\d{{2}}){rest}"
    opened = f"(?s){anchor}(\\d{{1,2}}):(\\d{{2}})\\s*{SEPARATOR}\\s*{rest}"
    single = f"(?s){anchor}(\\d{{1,2}}):(\\d{{2}}){rest}"
    digits = f"(?s)^([01]\\d|2[0-3])([0-5]\\d)(?![0-9]){rest}"

    def made(pattern: str, last: int, end: Column, shown) -> Column:
        both = lambda t: F.struct(t.start.alias("start"), t.end.alias("end"), shown(t).alias("time"), collapsed(F.regexp_extract(text, pattern, last)).alias("notes"))
        return let(F.struct(_clock(text, pattern, 1, 2).alias("start"), end.alias("end")), both)

    none = F.lit(None).cast("string")
    # where a single time stands before a range, the range still wins; opened and single share their start
    out = F.when(text.rlike(span), made(span, 5, _clock(text, span, 3, 4), lambda t: F.concat(t.start, F.lit("-"), t.end)))
    tail = F.regexp_extract(text, single, 3)
    one = F.when(tail.rlike(f"^\\s*{SEPARATOR}"), made(opened, 3, none, lambda t: F.concat(t.start, F.lit("-")))).otherwise(made(single, 3, none, lambda t: t.start))
    out = out.when(text.rlike(single), one)
    if compact:
        out = out.when(text.rlike(digits), made(digits, 3, none, lambda t: t.start))
    return out.otherwise(F.struct(none.alias("start"), none.alias("end"), none.alias("time"), text.alias("notes")))


def time_range(x: Column) -> Column:
    """struct<start, end, time, notes> of a time or range at the beginning of x."""
    return let(collapsed(normalize_digits(x)), lambda t: _times(t, "^", True))


def time_anywhere(x: Column) -> Column:
    """struct<start, end, time, notes> of the first range, or else time, in x."""
    return let(normalize_digits(x), lambda t: _times(t, "", False))


def normalized_clock(value: Column) -> Column:
    """struct<time, day_offset>: hours from 24 on belong to a following day."""
    hour = F.split(value, ":")[0].cast("int")
    return F.when(value.isNotNull(), F.struct(F.concat(F.lpad((hour % 24).cast("string"), 2, "0"), F.lit(":"), F.split(value, ":")[1]).alias("time"), F.floor(hour / 24).cast("int").alias("day_offset")))


def has_invalid_clock(x: Column) -> Column:
    times = F.regexp_extract_all(normalize_digits(F.coalesce(x, F.lit(""))), F.lit("(?<!\\d)(\\d{1,2}:\\d{2})(?!\\d)"), 1)
    return F.exists(times, lambda t: (F.split(t, ":")[0].cast("int") > 29) | (F.split(t, ":")[1].cast("int") > 59))


def day_time(x: Column, deadline: bool = False) -> Column:
    """struct<time, start, end, start_day_offset, end_day_offset, notes, raw_text> of check-in and check-out."""
    plain, got = stripped(normalize_digits(F.coalesce(x, F.lit("")))), time_range(x)
    start, end = normalized_clock(got.start), normalized_clock(got.end)
    bad, until = has_invalid_clock(x), F.lit(deadline) & got.time.isNotNull() & plain.rlike("(?:前|まで)\\s*$")
    ok = lambda c: F.when(~bad, c)
    swap = lambda a, b: ok(F.when(until, b).otherwise(a))
    notes = F.when(bad, empty_to_null(plain)).when(until, F.when(plain.endswith("前"), "before").otherwise("by")).otherwise(got.notes)
    none_s, none_i = F.lit(None).cast("string"), F.lit(None).cast("int")
    return F.struct(
        ok(got.time).alias("time"),
        swap(start.time, none_s).alias("start"),
        swap(end.time, start.time).alias("end"),
        swap(start.day_offset, end.day_offset).alias("start_day_offset"),
        swap(end.day_offset, start.day_offset).alias("end_day_offset"),
        notes.alias("notes"),
        x.alias("raw_text"),
    ) if deadline else F.struct(ok(got.time).alias("time"), ok(start.time).alias("start"), ok(end.time).alias("end"), ok(start.day_offset).alias("start_day_offset"), ok(end.day_offset).alias("end_day_offset"), notes.alias("notes"), x.alias("raw_text"))


# Rooms, meals, payment, parking, prices.


def _all_numbers(x: Column, pattern: str) -> Column:
    return F.transform(F.regexp_extract_all(x, F.lit(pattern), 1), lambda n: n.cast("int"))


def rooms(x: Column) -> Column:
    """struct<types, room_count>: known words in order, and the sum of the counts."""
    text = normalize_digits(x)
    words = F.transform(F.regexp_extract_all(text, F.lit(f"({ROOM_WORDS})"), 1), lambda w: F.when(w == "ﾄﾞﾐﾄﾘｰ", "ドミトリー").otherwise(w))
    counts = _all_numbers(text, "(\\d+)\\s*(?:部屋|室)")
    count = F.when(F.size(counts) > 0, F.aggregate(counts, F.lit(0), lambda a, n: a + n))
    return F.struct(F.coalesce(F.array_distinct(words), F.array().cast("array<string>")).alias("types"), count.alias("room_count"))


def rooms_with_total(x: Column, price: Column) -> Column:
    """As rooms, but a stated total wins, what follows うち is not counted, and kinds are mapped."""
    text = normalize_digits(F.coalesce(x, F.lit("")))
    total = empty_to_null(F.regexp_extract(text, "(?:合計|全)\\s*(\\d+)\\s*(?:部屋|室)", 1)).cast("int")
    own = rooms(x)
    count = F.when(total.isNotNull(), total).when(text.contains("うち"), rooms(F.substring_index(text, "うち", 1)).room_count).otherwise(own.room_count)
    both = F.concat_ws("|", x, price)
    kinds = F.array_distinct(F.array_compact(F.array(*[F.when(both.contains(a), b) for a, b in ROOM_KINDS])))
    return F.struct(F.when(F.size(kinds) > 0, kinds).otherwise(own.types).alias("types"), count.alias("room_count"), x.alias("raw_text"))


def meals(x: Column) -> Column:
    """struct<breakfast, dinner>; the time is sought from the word to the end of the text."""

    def one(text: Column, word: str) -> Column:
        has = text.contains(word) & ~text.contains("なし")
        got = F.when(has, time_anywhere(F.substring(text, F.instr(text, word), F.length(text))))
        return let(F.struct(has.alias("has"), got.alias("got")), lambda g: F.struct(g.has.alias("available"), g.got.time.alias("time"), g.got.start.alias("start"), g.got.end.alias("end")))

    return let(normalize_digits(F.coalesce(x, F.lit(""))), lambda t: F.struct(one(t, "朝食").alias("breakfast"), one(t, "夕食").alias("dinner")))


def payment(x: Column) -> Column:
    """struct<methods, cards>."""
    flat_ = lambda text: F.regexp_replace(F.replace(F.upper(text), F.lit("VIZA"), F.lit("VISA")), "(?U)\\s+", "")

    def of(raw: Column, text: Column, flat: Column) -> Column:
        alone = lambda word: flat.rlike(f"(?<![A-Z]){word}(?![A-Z])")
        cards = (
            ("VISA", flat.contains("VISA")),
            ("Mastercard", flat.contains("MASTER")),
            ("JCB", flat.contains("JCB")),
            ("AE", flat.contains("AMEX") | flat.contains("AMERICANEXPRESS") | text.contains("アメリカンエクスプレス") | alone("AE")),
            ("UC", alone("UC")),
            ("DC", alone("DC")),
            ("Diners", flat.contains("DINERS")),
            ("Discover", flat.contains("DISCOVER")),
            ("UnionPay", flat.contains("UNIONPAY") | text.contains("銀聯")),
            ("PayPay", flat.contains("PAYPAY")),
            ("d払い", text.contains("D払い") | raw.contains("d払い")),
        )
        listed = lambda pairs: F.array_compact(F.array(*[F.when(c, n) for n, c in pairs]))
        return F.struct(listed((("cash", text.contains("現金")), ("card", text.contains("カード")))).alias("methods"), listed(cards).alias("cards"))

    return let(F.struct(x.alias("raw"), normalize_half_kana(x).alias("text")), lambda t: let(flat_(t.text), lambda flat: of(t.raw, t.text, flat)))


def parking(x: Column) -> Column:
    text = normalize_digits(x)
    known = "\\d+\\s*台|無料|有料|[（(]?(?:予約不要|要予約|予約必要)[）)]?"
    notes = F.regexp_replace(F.regexp_replace(text, known, ""), "(?U)^[\\s、,・/|]+|[\\s、,・/|]+$", "")
    return F.struct(
        empty_to_null(F.regexp_extract(text, "(\\d+)\\s*台", 1)).cast("int").alias("space_count"),
        F.when(text.contains("無料"), "free").when(text.contains("有料"), "paid").alias("fee_status"),
        F.when(text.contains("予約不要"), False).when(text.contains("要予約") | text.contains("予約必要"), True).alias("reservation_required"),
        empty_to_null(notes).alias("notes"),
        x.alias("raw_text"),
    )


PRICE_TYPE = "struct<label:string,status:string,amount_yen:int,min_amount_yen:int,max_amount_yen:int,surcharge:boolean,room_type:string,meal_plan:string,notes:string,raw_text:string>"
AMOUNT = "\\+?\\s*\\d[\\d,]*\\s*円"
RANGE = "(\\d[\\d,]*)\\s*円?\\s*[〜～~]\\s*(\\d[\\d,]*)\\s*円"


def _yen(x: Column) -> Column:
    return F.replace(x, F.lit(","), F.lit("")).try_cast("int")


def prices(x: Column) -> Column:
    """array of price items between bars, in order.

    Each amount of an item makes a row, labelled by the text since the one before; an item with a range makes
    one row; a wave after an amount leaves its maximum open.
    """
    item_ = lambda **k: F.struct(*[k[f.split(":")[0]].alias(f.split(":")[0]) for f in PRICE_TYPE[7:-1].split(",")])
    none_s, none_i, no = F.lit(None).cast("string"), F.lit(None).cast("int"), F.lit(False)

    head = "(?Us)^([^:：]+)\\s*[:：]\\s*(.*)$"
    words = "|".join(p for p, _ in PRICE_STATES)
    empty = F.array().cast(f"array<{PRICE_TYPE}>")

    def read(source: Column, value: Column) -> Column:
        label = F.regexp_extract(value, head, 1)
        labelled = let(label, lambda n: F.struct(F.when(n != "", F.trim(n)).alias("label"), F.when(n != "", stripped(F.regexp_extract(value, head, 2))).otherwise(value).alias("body")))
        # the text before each amount, the amounts, and what follows each
        found, between = F.regexp_extract_all(value, F.lit(f"({AMOUNT})"), 1), F.split(value, AMOUNT)
        return let(F.struct(source.alias("source"), value.alias("value"), labelled.alias("l"), first_contained(value, MEAL_PLANS).alias("plan"), value.rlike(RANGE).alias("ranged"), found.alias("found"), between.alias("gaps")), items)

    def items(t: Column) -> Column:
        return let(first_state(t.l.body, PRICE_STATES, None), lambda status: items_of(t, status))

    def items_of(t: Column, status: Column) -> Column:
        source, value, label, body, plan, ranged, found, between = t.source, t.value, t.l.label, t.l.body, t.plan, t.ranged, t.found, t.gaps
        after = empty_to_null(F.regexp_replace(F.regexp_replace(body, f"^(?:{words})", ""), "^[ （()）]+|[ （()）]+$", ""))
        zero = F.when(status == "free", 0)
        stated = item_(label=label, status=status, amount_yen=zero, min_amount_yen=zero, max_amount_yen=zero, surcharge=no, room_type=none_s, meal_plan=plan, notes=after, raw_text=source)
        told = item_(label=label, status=F.lit("descriptive"), amount_yen=none_i, min_amount_yen=none_i, max_amount_yen=none_i, surcharge=no, room_type=none_s, meal_plan=plan, notes=body, raw_text=source)
        vague = item_(label=label, status=F.lit("ambiguous"), amount_yen=none_i, min_amount_yen=none_i, max_amount_yen=none_i, surcharge=no, room_type=none_s, meal_plan=none_s, notes=none_s, raw_text=source)

        def priced(i: Column) -> Column:
            rest = F.array_join(F.concat(F.array(F.get(between, i + 1)), F.flatten(F.transform(F.filter(F.sequence(F.lit(0), F.size(found) - 1), lambda j: j > i), lambda j: F.array(F.get(found, j), F.get(between, j + 1))))), "")
            part = F.struct(F.regexp_replace(F.get(between, i), "^[、, /・]+", "").alias("before"), F.get(found, i).alias("amount"), rest.alias("rest"))
            low = lambda p: F.when(ranged, _yen(F.regexp_extract(value, RANGE, 1))).otherwise(_yen(F.regexp_extract(p.amount, "(\\d[\\d,]*)", 1)))
            return let(part, lambda p: let(low(p), lambda yen: one(p, yen)))

        def one(p: Column, low: Column) -> Column:
            high = F.when(ranged, _yen(F.regexp_extract(value, RANGE, 2))).when(p.rest.rlike("[〜～~]"), none_i).otherwise(low)
            tail = F.when(ranged, F.regexp_extract(value, f"(?s){RANGE}(.*)$", 3)).otherwise(p.rest)
            return item_(
                label=let(F.regexp_replace(p.before, "(?U)[:：、,\\s]+$", ""), empty_to_null), status=F.lit("priced"), amount_yen=low, min_amount_yen=low, max_amount_yen=high,
                surcharge=p.amount.startswith("+"), room_type=first_contained(p.before, ROOM_KINDS), meal_plan=plan,
                notes=let(F.regexp_replace(tail, "^[ 、,()（）]+|[ 、,()（）]+$", ""), empty_to_null), raw_text=source,
            )

        many = F.transform(F.filter(F.sequence(F.lit(0), F.greatest(F.size(found) - 1, F.lit(0))), lambda i: ~ranged | (i == 0)), priced)
        return F.when(status.isNotNull(), F.array(stated)).when(F.size(found) > 0, many).when((value != "") & label.isNull(), empty).when(body != "", F.array(told)).otherwise(F.array(vague))

    def of_item(source: Column) -> Column:
        return let(stripped(F.replace(normalize_digits(source), F.lit("，"), F.lit(","))), lambda value: read(source, value))

    return F.when(F.coalesce(x, F.lit("")) == "", F.array().cast(f"array<{PRICE_TYPE}>")).otherwise(F.flatten(F.transform(F.split(x, "\\|"), of_item)))


def price_notes(x: Column) -> Column:
    """Items that are neither labelled nor priced nor a state."""
    value = lambda i: stripped(F.replace(normalize_digits(i), F.lit("，"), F.lit(",")))
    plain = lambda i: (value(i) != "") & ~value(i).rlike("^[^:：]+\\s*[:：]") & ~value(i).rlike(AMOUNT) & first_state(value(i), PRICE_STATES, None).isNull()
    return F.transform(F.filter(F.split(F.coalesce(x, F.lit("")), "\\|"), plain), value)


# Routes, names, urls, ids.

ROUTE = "(?Us)(\\d+)\\s*番\\s*(.+?)\\s*から\\s*(\\d+)\\s*番\\s*(.+?)\\s*へのお宿"


def route(x: Column) -> Column:
    """struct<from_temple, to_temple>, both null where the sentence does not match."""
    temple = lambda n, name: F.when(x.rlike(ROUTE), F.struct(whole_number(F.regexp_extract(x, ROUTE, n)).alias("number"), collapsed(F.regexp_extract(x, ROUTE, name)).alias("name")))
    return F.struct(temple(1, 2).alias("from_temple"), temple(3, 4).alias("to_temple"))


def route_temple(number: Column, name: Column, distance: Column, provenance: str = "detail_route") -> Column:
    some = F.coalesce(number, name, distance).isNotNull()
    return F.when(some, F.struct(whole_number(number).alias("number"), name.alias("name"), stripped(normalize_digits(distance)).try_cast("double").alias("distance_km"), F.lit(provenance).alias("provenance")))


def image_url(x: Column) -> Column:
    full = empty_to_null(x)
    return F.struct(F.substring_index(full, "?", 1).alias("url"), full.alias("original_url"))


def images(featured: Column, gallery: Column) -> Column:
    one = lambda role: lambda u: F.struct(F.substring_index(u, "?", 1).alias("url"), u.alias("original_url"), F.lit(role).alias("role"))
    first = F.when(F.coalesce(featured, F.lit("")) != "", F.array(featured)).otherwise(F.array().cast("array<string>"))
    return F.concat(F.transform(first, one("featured")), F.transform(F.coalesce(gallery, F.array().cast("array<string>")), one("gallery")))


MARKER = "!8m2!3d(-?\\d+(?:\\.\\d+)?)!4d(-?\\d+(?:\\.\\d+)?)"


def marker(x: Column) -> Column:
    """Coordinates of a place marker in a map url."""
    return F.when(x.rlike(MARKER), F.struct(F.regexp_extract(x, MARKER, 2).cast("double").alias("longitude"), F.regexp_extract(x, MARKER, 1).cast("double").alias("latitude")))


def host_allowed(url: Column, hosts: tuple[str, ...]) -> Column:
    return F.coalesce(F.lower(F.try_parse_url(url, F.lit("HOST"))).isin(*hosts), F.lit(False))


def query_value(url: Column, name: str) -> Column:
    return F.try_parse_url(url, F.lit("QUERY"), F.lit(name))


def star_count(x: Column) -> Column:
    return F.nullif(F.length(x) - F.length(F.replace(x, F.lit("★"), F.lit(""))), F.lit(0))


def distance_km(x: Column) -> Column:
    return empty_to_null(F.regexp_extract(normalize_digits(x), "(\\d+(?:\\.\\d+)?)\\s*(?:km|ｋｍ|㎞)", 1)).cast("double")


def modified_date(x: Column) -> Column:
    p = "(\\d{4})年\\s*(\\d{1,2})月\\s*(\\d{1,2})日"
    part = lambda i: F.lpad(F.regexp_extract(x, p, i), 2, "0")
    return F.when(x.rlike(p), F.concat_ws("-", F.regexp_extract(x, p, 1), part(2), part(3)))


def yes_no_or_text(x: Column) -> Column:
    """struct<flag, text>: yes, true, 1 and no, false, 0 as a boolean, anything else as text."""
    value = F.lower(F.trim(x))
    flag = F.when(value.isin("yes", "true", "1"), True).when(value.isin("no", "false", "0"), False)
    return F.struct(flag.alias("flag"), F.when(flag.isNull(), empty_to_null(F.trim(x))).alias("text"))


#: File endings of image types, and those that a url may give.
IMAGE_TYPES = {"image/jpeg": ".jpg", "image/png": ".png", "image/webp": ".webp", "image/gif": ".gif", "image/svg+xml": ".svg"}
IMAGE_ENDINGS = (".jpg", ".jpeg", ".png", ".webp", ".gif")


def image_ending(content_type: Column, url: Column) -> Column:
    """A file's ending by its content type, or else by its url, or else .jpg."""
    base = F.lower(F.trim(F.substring_index(content_type, ";", 1)))
    known = F.coalesce(*[F.when(base == k, v) for k, v in IMAGE_TYPES.items()])
    of_url = F.lower(F.regexp_extract(F.substring_index(url, "?", 1), "[^/](\\.[^./]*)$", 1))
    return F.coalesce(known, F.when(of_url.isin(*IMAGE_ENDINGS), of_url), F.lit(".jpg"))


def escaped(x: Column) -> Column:
    return reduce(lambda t, p: F.replace(t, F.lit(p[0]), F.lit(p[1])), ESCAPES, x)


def source_code_of(name: Column) -> Column:
    """Code of the elevation source that a file name holds: the finer, the greater."""
    up = F.upper(name)
    return F.when(up.contains("DEM5A"), 4).when(up.contains("DEM5B"), 3).when(up.contains("DEM5C"), 2).when(up.contains("DEM10B"), 1).cast("tinyint")


def source_label(code: Column) -> Column:
    return F.when(code == 4, "DEM5A").when(code == 3, "DEM5B").when(code == 2, "DEM5C").when(code == 1, "DEM10B").otherwise("nodata")


@F.pandas_udf(T.StringType())
def name_key(x: pd.Series) -> pd.Series:
    """NFKC, case folded, without punctuation and white space."""

    def one(t):
        if t is None:
            return None
        return "".join(c for c in unicodedata.normalize("NFKC", t).casefold() if not c.isspace() and unicodedata.category(c)[0] != "P")

    return x.map(one)


def _trail_keys(x: pa.Array) -> pa.Array:
    drop = str.maketrans("", "", TRAIL_MARKS)
    own = x.dictionary_encode(null_encoding="encode")
    keys = ["" if t is None else "".join(unicodedata.normalize("NFKC", t).translate(drop).split()).casefold() for t in own.dictionary.to_pylist()]
    return pa.array(keys, pa.string()).take(own.indices)


@F.arrow_udf(T.StringType())
def trail_key(x: pa.Array) -> pa.Array:
    """NFKC without a fixed list of marks and white space, case folded; null as an empty key.  A batch's equal texts are worked out once."""
    return _trail_keys(x)


@F.arrow_udf(T.ArrayType(T.StringType()))
def trail_keys(x: pa.Array) -> pa.Array:
    """``trail_key`` of each text of an array; a null array as an empty one."""
    ends = list(accumulate((n or 0 for n in pc.list_value_length(x).to_pylist()), initial=0))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), _trail_keys(x.flatten()))
