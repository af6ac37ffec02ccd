"""Places in saved map answers: markers, ambiguity, request addresses and the area a place lies in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import geo
from .text import empty_to_null

# The form of a place record and of a marker, and names of prefectures.
QUOTED = '("(?:[^"\\\\]++|\\\\.)*+")'
NUMBER = "(-?\\d+(?:\\.\\d+)?)"
RECORD = f'\\[\\["(0x[0-9a-f]+:0x[0-9a-f]+)",{QUOTED},\\[{NUMBER},{NUMBER}\\],"(\\d+)"\\],{QUOTED}'
MARKER = f"!8m2!3d{NUMBER}!4d{NUMBER}"
OWN_AREA = ("徳島県", "高知県", "愛媛県", "香川県")
PREFECTURE = (
    "(北海道|東京都|京都府|大阪府|(?:青森|岩手|宮城|秋田|山形|福島|茨城|栃木|群馬|埼玉|千葉|神奈川|新潟|富山|石川|福井|山梨|長野|岐阜|静岡|愛知|三重|"
    "滋賀|兵庫|奈良|和歌山|鳥取|島根|岡山|広島|山口|徳島|香川|愛媛|高知|福岡|佐賀|長崎|熊本|大分|宮崎|鹿児島|沖縄)県)"
)
SEARCH = "https://www.google.com/maps?q="


def marker(url: Column) -> Column:
    """lat and lon of a resolved address's place marker, null without one."""
    part = lambda i: F.regexp_extract(url, MARKER, i).cast("double")
    return F.when(url.rlike(MARKER), F.struct(part(1).alias("lat"), part(2).alias("lon")))


def place_count(content: Column) -> Column:
    """Distinct places (id, lat, lon) in an answer; over 1 is ambiguous."""
    every = lambda i: F.regexp_extract_all(content, F.lit(RECORD), F.lit(i))
    return F.coalesce(F.size(F.array_distinct(F.arrays_zip(every(1).alias("a"), every(3).alias("b"), every(4).alias("c")))), F.lit(0))


def place(content: Column, final_url: Column) -> Column:
    """The one place of an answer, else the marker of its address; null if there is none or more than one."""
    got = lambda i: F.regexp_extract(content, RECORD, i)
    plain = lambda i: F.from_json(F.concat(F.lit('{"v":'), got(i), F.lit("}")), "v string").v
    none = F.lit(None).cast("string")
    at = marker(final_url)
    full = F.struct(got(3).cast("double").alias("lat"), got(4).cast("double").alias("lon"), got(1).alias("place_id"), got(5).alias("cid"), plain(6).alias("name"), plain(2).alias("address"))
    bare = F.struct(at.lat.alias("lat"), at.lon.alias("lon"), none.alias("place_id"), none.alias("cid"), none.alias("name"), none.alias("address"))
    return F.when(place_count(content) > 1, None).when(content.rlike(RECORD), full).when(at.isNotNull(), bare)


def form_encoded(x: Column) -> Column:
    """Form encoding with ~ plain and * encoded."""
    return F.replace(F.replace(F.url_encode(x), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def search_url(name: Column, address: Column) -> Column:
    return F.concat(F.lit(SEARCH), form_encoded(F.concat_ws(" ", empty_to_null(name), empty_to_null(address))))


def embed_url(url: Column) -> Column:
    """An address with its query re-encoded and set to a Japanese embedded answer; https, without fragment."""
    query = F.coalesce(F.try_parse_url(url, F.lit("QUERY")), F.lit(""))
    split = lambda p: (F.substring_index(p, "=", 1), F.regexp_extract(p, "(?s)^[^=]*=(.*)$", 1))
    again = lambda x: form_encoded(F.coalesce(F.try_url_decode(x), x))
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~split(p)[0].isin("output", "hl"))
    pairs = F.transform(kept, lambda p: F.concat(again(split(p)[0]), F.lit("="), again(split(p)[1])))
    whole = F.array_join(F.concat(pairs, F.array(F.lit("output=embed"), F.lit("hl=ja"))), "&")
    return F.concat(F.lit("https://"), F.try_parse_url(url, F.lit("AUTHORITY")), F.try_parse_url(url, F.lit("PATH")), F.lit("?"), whole)


def in_own_area(address: Column, source_address: Column, lat: Column, lon: Column) -> Column:
    """By the prefecture of the place's address, else of the source's unless it is ours, else by the outline."""
    own, said = (F.nullif(F.regexp_extract(F.coalesce(x, F.lit("")), PREFECTURE, 1), F.lit("")) for x in (address, source_address))
    return F.when(own.isNotNull(), own.isin(*OWN_AREA)).when(said.isNotNull() & ~said.isin(*OWN_AREA), False).otherwise(geo.in_polygon(lat, lon))
