import gzip
import json
import urllib.parse

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoloom.functions import places
from geoloom.operators import elevation
from geoloom.sources import tiles


def test_meshes(spark):
    elev = np.array([[1.5, np.nan, -2], [0, 3, 4]], np.float32)
    data = tiles.mesh_bytes("51346200", (33.0, 134.0, 33.5, 134.5), elev, np.array([[1, 0, 4], [2, 1, 1]]), np.array([[4, 0, 3], [1, 2, 4]]))
    files = spark.createDataFrame([(bytearray(data),)], "content binary")
    assert tuple(tiles.mesh_headers(files).first()) == ("51346200", 33.0, 134.0, 33.5, 134.5, 3, 2)
    assert [tuple(r)[1:] for r in tiles.mesh_cells(files).orderBy("row", "col").collect()] == [(0, 0, 1.5, 1, 4), (0, 1, None, 0, 0), (0, 2, -2.0, 4, 3), (1, 0, 0.0, 2, 1), (1, 1, 3.0, 1, 2), (1, 2, 4.0, 1, 4)]
    for bad in (b"XXXX" + data[4:], data[:4] + b"\x02" + data[5:]):
        with pytest.raises(ValueError):
            tiles.mesh_header(bad)


def test_tiles(spark):
    rows = [(5, 2, 3, 0, 0, 7, 4), (5, 2, 3, 255, 1, -9, 1), (10, 0, 0, 1, 2, 100, 1)]
    files = tiles.tile_files(spark.createDataFrame(rows, tiles.TILE_CELL))
    assert sorted(map(tuple, tiles.tile_cells(files).collect())) == rows
    with pytest.raises(ValueError):
        tiles.tile_parts(tiles.tile_bytes(5, 0, 0, np.zeros(4, np.int16), np.zeros(4)))


def test_archives(spark):
    pack = bytes([3, 5, 2, 1, 1, 0, 1, 10, 20, 30, 1, 0, 101])
    want = [(5, 1, 0, 10), (7, 0, 10, 20), (8, 1, 100, 30)]
    assert tiles.directory(pack) == want == tiles.directory(gzip.compress(pack), True) and list(tiles.varints(b"\xac\x02\x01")) == [300, 1]
    field = lambda n, x: bytes([n * 8 + 2, len(x)]) + x
    layer = field(1, b"way") + field(3, b"name") + field(3, b"n") + field(4, field(1, "道".encode())) + field(4, bytes([6 * 8, 5])) + field(2, field(2, bytes([0, 0, 1, 1])) + bytes([3 * 8, 2])) + field(2, b"")
    assert tiles.tile_features(gzip.compress(field(3, layer))) == [("way", {"name": "道", "n": -3}), ("way", {})]
    got = tiles.feature_rows(spark.createDataFrame([(4, bytearray(field(3, layer)))], "tile_id long, content binary")).collect()
    assert [(r.tile_id, r.layer, r.properties) for r in got] == [(4, "way", {"name": "道", "n": "-3"}), (4, "way", {})]


def test_places(spark):
    record = lambda i, name: f'[["0x{i}:0xb",{json.dumps("愛媛県 " + name)},[33.5,-134],"12"],{json.dumps(name)}'
    urls = ["http://h.test/maps?q=a+b*~&hl=en&x&output=1#f", None, "https://h.test/m"]
    data = [(record(1, 'q"\\é'), "u", urls[0]), (record(1, "a") + record(2, "a"), "!8m2!3d1!4d2", urls[1]), ("", "x!8m2!3d33.5!4d134.25", urls[2]), (None, None, None), (record(1, "a") * 2, None, None)]
    d = spark.createDataFrame(data, "c string, u string, q string").select(places.place_count(F.col("c")).alias("n"), places.place(F.col("c"), F.col("u")).alias("p"), places.embed_url(F.col("q")).alias("e"))
    a, b, c, e, f = d.collect()
    assert [x.n for x in (a, b, c, e, f)] == [1, 2, 0, 0, 1]
    assert tuple(a.p) == (33.5, -134.0, "0x1:0xb", "12", 'q"\\é', '愛媛県 q"\\é') and b.p is None and tuple(c.p)[:3] == (33.5, 134.25, None) and e.p is None and f.p.name == "a"
    pairs = [(k, v) for k, v in urllib.parse.parse_qsl("q=a+b*~&hl=en&x&output=1", keep_blank_values=True) if k not in ("hl", "output")] + [("output", "embed"), ("hl", "ja")]
    assert a.e == "https://h.test/maps?" + urllib.parse.urlencode(pairs) and b.e is None and c.e == "https://h.test/m?output=embed&hl=ja"
    s = spark.createDataFrame([("宿 一", "市*~")], "n string, a string").select(places.search_url(F.col("n"), F.col("a"))).first()[0]
    assert s == "https://www.google.com/maps?q=" + urllib.parse.quote_plus("宿 一 市*~")
    area = spark.createDataFrame([("x愛媛県", None), ("東京都", None), (None, "大阪府"), (None, "香川県"), (None, None)], "a string, s string")
    assert [r[0] for r in area.select(places.in_own_area(F.col("a"), F.col("s"), F.lit(33.5), F.lit(133.5))).collect()] == [True, False, False, True, True]


def test_sample_points(spark):
    rows = elevation.sample_points(spark, (0.0, 10.0, 1.0, 20.0), 3).orderBy("ord").collect()
    s = 42
    s ^= (s << 13) % 2**64
    s ^= s >> 7
    s ^= (s << 17) % 2**64
    assert rows[0].lat == s / (2**64 - 1) and len(rows) == 3 and all(0 <= r.lat <= 1 and 10 <= r.lon <= 20 for r in rows)
