"""The training-data operators against brute force, libraries and held-out rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from geoloom.llm import (
    components, language_id, near_dedup, packing, pieces, quality_classifier, quality_rules,
    queries, substring_dedup, suffix_dedup, token_files, tokens, topk,
)
from geoloom.llm.common import fresh_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(random_, n):
    return " ".join("".join(random_.choice("abcdeéß") for _ in range(random_.randint(1, 6))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    """Copies, near copies, shared passages, ties, repeated rows, nulls, empties, a very long text."""
    r = random.Random(3)
    base, passage = words(r, 400), words(r, 90)
    near = base.split()
    near[200] = "edited"
    out = [(0, base), (1, base), (2, " ".join(near)), (3, words(r, 120) + " " + passage), (4, passage + "\n" + words(r, 120)), (5, words(r, 60) + " " + passage + " " + words(r, 60))]
    out += [(6, None), (7, ""), (8, "  \n\t"), (9, "a"), (10, "漢字 é 🎉 " + passage), (11, "x " * 3000), (12, "x " * 3000 + "y"), (13, words(r, 20000)), (14, words(r, 14)), (15, "1 2 3 !!"), (15, "1 2 3 !!"), (None, base), (None, None)]
    out += [(100 + i, words(r, 150)) for i in range(20)]
    out += [(200 + i, " ".join(w if r.random() > 0.01 else "changed" for w in base.split())) for i in range(15)]
    return [(i, t, None if i is None else "en", "s", None if t is None else len(t)) for i, t in out]


@pytest.fixture(scope="module")
def sf(spark, rows, tmp_path_factory):
    """A folder of tables: documents with further columns whose names clash with inner ones."""
    d = tmp_path_factory.mktemp("tables")
    docs = spark.createDataFrame(rows, DOCS)
    for c in ("home", "kind", "blob", "score", "rank", "x", "key", "bands"):
        docs = docs.selectExpr("*", f"1 AS {c}")
    docs.repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(3, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    r = random.Random(5)
    vec = [(i, [r.uniform(-1, 1) for _ in range(8)], 0) for i in range(0, 900, 3)] + [(900, [1.0] * 8, 0), (901, [1.0] * 8, 0), (902, [1.0] * 8, 0), (1000, None, 0), (1001, [None] * 8, 0), (1002, [math.nan] * 8, 0), (1003, [math.inf] * 8, 0), (1004, [1.0], 0), (None, [1.0] * 8, 0)]
    spark.createDataFrame(vec, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 AS v", "2 AS task").write.parquet(f"{d}/embeddings.parquet")
    return str(d)


@pytest.fixture(scope="module")
def empty(spark, sf, tmp_path_factory):
    d = tmp_path_factory.mktemp("empty")
    for t in ("documents", "labels", "embeddings"):
        spark.read.parquet(f"{sf}/{t}.parquet").limit(0).write.parquet(f"{d}/{t}.parquet")
    return str(d)


def removed(units, size):
    """Per (doc, unit list): flags of what a smaller document has."""
    first = {}
    for i, u in units:
        if i is not None:
            for s in range(len(u) - size + 1):
                w = u[s : s + size]
                first[w] = min(i, first.get(w, i))
    out = []
    for i, u in units:
        flags = [False] * len(u)
        if i is not None:
            for s in range(len(u) - size + 1):
                if first[u[s : s + size]] < i:
                    flags[s : s + size] = [True] * size
        out.append(flags)
    return out


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_empty_tables(spark, empty, name):
    assert queries.QUERIES[name](spark, empty).collect() == []


def test_op1(spark, sf, rows):
    units = [(i, tuple((t or "").encode().split())) for i, t, *_ in rows]
    want = Counter((i, len(u), sum(f), hashlib.sha256(b" ".join(w for w, x in zip(u, f) if not x)).hexdigest()) for (i, u), f in zip(units, removed(units, 13)))
    assert Counter(tuple(r) for r in substring_dedup.op1_substring_dedup(spark, sf).collect()) == want


def test_op10(spark, sf, rows):
    units = [(i, (t or "").encode()) for i, t, *_ in rows]
    want = Counter()
    for (i, u), f in zip(units, removed(units, 50)):
        runs = sum(a and not b for a, b in zip(f, [False, *f]))
        want[i, len(u), sum(f), runs, hashlib.sha256(bytes(c for c, x in zip(u, f) if not x)).hexdigest()] += 1
    assert Counter(tuple(r) for r in suffix_dedup.op10_suffix_dedup(spark, sf).collect()) == want


def test_op2(spark, sf, rows):
    got = defaultdict(list)
    for r in quality_rules.op2_quality_rules(spark, sf).collect():
        got[r.doc_id].append(r)
    for i, t, *_ in rows:
        w = (t or "").replace("\t", " ").replace("\n", " ").split(" ")
        w = [x for x in w if x]
        tri = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        rep = {p for k in range(len(w) - 2) if tri[tuple(w[k : k + 3])] > 1 for p in (k, k + 1, k + 2)}
        lines = [x for x in (t or "").split("\n") if x.strip(" \t")]
        want = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(rep), len(w) < 50 or 100 * len(rep) > 50 * len(w))
        assert any(tuple(r)[1:7] == want and (not r.kept or not r.base_failed) for r in got[i])
    assert sum(map(len, got.values())) == len(rows)


def test_op2_ablations(spark, sf):
    led = quality_rules.ledger(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"))
    own = [r.failed for r in led.select("failed").collect()]
    for r in quality_rules.ablations(led, 2).collect():
        bit = next(1 << b for b, (name, _) in quality_rules.RULES.items() if name == r.rule)
        mask = quality_rules.mask(2)
        assert r.n_failed == sum(bool(x & bit) for x in own)
        assert r.n_only == sum(x & mask == bit for x in own)
        assert r.n_kept_without == sum(not x & mask & ~bit for x in own)


def test_op2_filter_keeps_texts(spark, sf, rows):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {r.doc_id: r.text for r in quality_rules.passing(docs).collect()}
    assert set(kept) == {r.doc_id for r in quality_rules.op2_quality_rules(spark, sf).where("kept").collect()}
    assert all(kept[i] == t for i, t, *_ in rows if i in kept and i is not None)


@pytest.mark.parametrize("block, shard", [(1 << 25, 1 << 24), (200, 4000)])
def test_op3(spark, sf, block, shard):
    v = {r.vec_id: np.floor(1024 * np.array(r.embedding, float)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").where("vec_id IS NOT NULL AND vec_id < 1000").collect()}
    want = set()
    for q in (i for i in v if i % 100 == 0):
        best = sorted((-int(v[q] @ v[c]), c) for c in v if c != q)[:10]
        want |= {(q, k + 1, c, -s) for k, (s, c) in enumerate(best)}
    got = topk.top_k(spark.read.parquet(f"{sf}/embeddings.parquet"), block_bytes=block, shard_bytes=shard).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_tokens_equal_the_library():
    own, r = tokens.encoder(tokens.default_tokenizer()), random.Random(1)
    alphabet = "ab é　 \t\n\r\x1c\x85\xa0!'s12３漢​. œ,<|endoftext|>"
    texts = ["".join(r.choice(alphabet) for _ in range(r.choice([0, 3, 9, 60]))) for _ in range(3000)] + [None, ""]
    ids, counts = own.encode(texts)
    for t, got in zip(texts, np.split(ids, np.cumsum(counts)[:-1])):
        assert got.tolist() == own.tokenizer.encode(t or "", add_special_tokens=False).ids


def test_tokens_survive_a_full_store():
    own, r = tokens.ChunkEncoder(tokens.default_tokenizer(), entries=50), random.Random(2)
    for _ in range(5):
        texts = [words(r, 100) for _ in range(3)]
        ids, counts = own.encode(texts)
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [own.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_op4(spark, sf, rows):
    encode = tokens.encoder(tokens.default_tokenizer()).tokenizer.encode
    ids = {}
    for i, t, *_ in rows:
        ids.setdefault(i, Counter())[tuple(encode(t or "", add_special_tokens=False).ids) + (0,)] += 1
    got = token_files.op4_token_files(spark, sf).collect()
    assert len(got) == len(rows)
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
        assert (r.n_tokens, r.ids_crc32) in {(len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for x in ids[r.doc_id]}
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start) if r.doc_id is not None]
    assert order == sorted(order)


def test_op4_lookup_reaches_the_files(spark, sf):
    path = fresh_path(spark, "lookup")
    token_files.write_token_files(spark.read.parquet(f"{sf}/documents.parquet"), path, tokens.default_tokenizer())
    found = token_files.lookup(spark, path, [3])
    assert [r.doc_id for r in found.collect()] == [3]
    assert "PushedFilters: [In(doc_id, [3])" in found._jdf.queryExecution().toString() or "EqualTo(doc_id,3)" in found._jdf.queryExecution().toString()


def test_op8(spark, sf, rows):
    encode = tokens.encoder(tokens.default_tokenizer()).tokenizer.encode
    whole = Counter((i, tuple(encode(t or "", add_special_tokens=False).ids) + (1,)) for i, t, *_ in rows)
    got = packing.op8_packing(spark, sf).collect()
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append(r)
    for own in bins.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == np.cumsum([0, *[r.length for r in own]])[:-1].tolist()
    total = sum(r.length for r in got)
    assert total == sum(len(x) * n for (_, x), n in whole.items())
    sizes = [sum(r.length for r in own) for own in bins.values()]
    padded = sum(n if n & (n - 1) == 0 else 2048 for n in sizes)
    assert max(sizes) <= 2048 and padded <= 1.02 * total
    for (i, x), n in whole.items():
        own = [r for r in got if r.doc_id == i and r.doc_tokens == len(x)]
        assert sum(r.length for r in own if zlib.crc32(np.array(x[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32) >= n * len(x)


def test_packing_cuts():
    for n in range(1, 5000):
        assert sum(packing.cut(n)) == n and max(packing.cut(n)) <= 2048


def test_op6(spark, sf, rows):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    want = Counter((i, len(x := sp.encode(t or "")), zlib.crc32(np.array(x, "<u4").tobytes()), True) for i, t, *_ in rows)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32, r.exact) for r in pieces.op6_pieces(spark, sf).collect()) == want
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    back = pieces.decoded_texts(pieces.encoded_pieces(docs, pieces.default_model()), pieces.default_model()).collect()
    assert Counter(tuple(r) for r in back) == Counter((i, t or "") for i, t, *_ in rows)


def test_pieces_equal_the_library():
    import sentencepiece

    own, sp, r = pieces.piece_encoder(pieces.default_model()), sentencepiece.SentencePieceProcessor(model_file=pieces.default_model()), random.Random(4)
    texts = ["".join(r.choice("ab é　 \t\n\r\x1c!'s12３漢. œ,▁theing🎉") for _ in range(r.choice([0, 3, 9, 90]))) for _ in range(4000)] + [None, "a" + " " * 70 + "b" * 80]
    ids, counts = own.encode(texts)
    for t, got in zip(texts, np.split(ids, np.cumsum(counts)[:-1])):
        assert got.tolist() == sp.encode(t or "")


def test_suffix_ranks():
    data = np.frombuffer(b"banana\0bandana", np.uint8)
    left = np.array([*range(7, 0, -1), *range(7, 0, -1)])
    rank = suffix_dedup.suffix_ranks(data, left, 8)
    ends = [i + k for i, k in enumerate(left.tolist())]
    own = [bytes(data[i : e])[:8] for i, e in enumerate(ends)]
    assert [sorted(set(own)).index(x) for x in own] == rank.tolist()


def test_op7(spark, small, sf, rows):
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = language_id.op7_language_id(spark, small).collect()
    held = [r for r in got if r.held_out]
    assert held and sum(docs[r.doc_id] == r.lang_pred for r in held) >= 0.95 * len(held)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    own = Counter((r.doc_id, r.lang_pred) for r in language_id.op7_language_id(spark, sf).collect())
    assert own[6, "und"] == own[7, "und"] == own[8, "und"] == 1 and own[15, "und"] == 2 and sum(own.values()) == len(rows)


def test_suffix_automaton_knows_all_substrings():
    text = [random.Random(9).randint(0, 2) for _ in range(60)]
    state, symbol, to = language_id.suffix_automaton(text)
    table = {(a, b): c for a, b, c in zip(state.tolist(), symbol.tolist(), to.tolist())}

    def known(s):
        state = language_id.ROOT
        for c in s:
            state = table.get((state, c))
            if state is None:
                return False
        return True

    have = {tuple(text[a:b]) for a in range(60) for b in range(a, 61)}
    for n in range(1, 6):
        for s in np.ndindex(*[3] * n):
            assert known(s) == (s in have)


def test_op5(spark, small, sf, rows):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    got = quality_classifier.op5_quality_classifier(spark, small).collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= 0.8 * len(held)
    assert len(quality_classifier.op5_quality_classifier(spark, sf).collect()) == len(rows)


def test_pooled_never_falls():
    r = np.random.default_rng(0)
    counts = r.integers(0, 5, 100).astype(float)
    fit = quality_classifier.pooled(counts * r.uniform(0, 1, 100), counts)
    assert (np.diff(fit) >= 0).all()


def test_op9(spark, sf, rows):
    sets = {}
    for i, t, *_ in rows:
        w = (t or "").split()
        if i is not None and w:
            sets[i] = Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4)))
    parent = {i: i for i, *_ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b:
                common = sum((sets[a] & sets[b]).values())
                if common >= 0.8 * (sum(sets[a].values()) + sum(sets[b].values()) - common):
                    x, y = sorted((find(a), find(b)))
                    parent[y] = x
    got = near_dedup.op9_near_dedup(spark, sf).collect()
    assert len(got) == len(rows)
    assert all(r.class_id == (None if r.doc_id is None else find(r.doc_id)) for r in got)


def test_crowded_buckets_are_split(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "CROWD", 4)
    r = random.Random(8)
    base = words(r, 300).split()
    docs = [(i, " ".join(w if r.random() > 0.004 else f"e{i}" for w in base)) for i in range(40)]
    got = near_dedup.classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {x.class_id for x in got} == {0}


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    assert {r.node: r.root for r in components.components(links).collect()} == {**{i: 0 for i in range(1, 41)}, 101: 100}


def test_pipeline_stages(spark, sf, rows):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = docs.count()
        docs = stage(spark, docs, sf)
        if name != "packing":
            assert docs.columns == corpus_pipeline.COLUMNS
            docs = spark.createDataFrame(docs.collect(), docs.schema)
        kept = {r.doc_id for r in docs.select("doc_id").collect()}
        if name == "language_id":
            assert kept == {i for i, t, *_ in rows if t and any(c.isalpha() for c in t)}
        elif name == "quality_rules":
            assert not kept & {9, 11, 12, 14, 15} and {0, 1, 2, 3, 4, 5, 13} <= kept
        elif name == "near_dedup":
            assert 0 in kept and not kept & {1, 2} and {3, 4, 5, 13} <= kept
            units = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
        elif name == "suffix_dedup":
            want = {i: bytes(c for c, x in zip(u, f) if not x).decode(errors="ignore") for (i, u), f in zip(units, removed(units, 50)) if i is not None}
            assert {r.doc_id: r.text for r in docs.where("doc_id IS NOT NULL").collect()} == want
        elif name == "packing":
            ids = {r[0]: tokens.encoder(tokens.default_tokenizer()).tokenizer.encode(r[1], add_special_tokens=False).ids + [1] for r in last}
            assert {r.doc_id: r.doc_tokens for r in docs.where("doc_id IS NOT NULL").collect()} == {i: len(x) for i, x in ids.items() if i is not None}
            for r in docs.where("doc_id IS NOT NULL").collect():
                assert r.ids_crc32 == zlib.crc32(np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes())
        assert name == "packing" or docs.count() <= before
        last = None if name == "packing" else [(r.doc_id, r.text or "") for r in docs.collect()]


def test_near_copies_in_a_crowd_of_half_similar_texts(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "CROWD", 16)
    r = random.Random(5)
    template = [f"t{i}" for i in range(300)]
    docs = []
    for k in range(100):
        own = template + [f"u{k}_{i}" for i in range(70)]
        copy = list(own)
        for _ in range(4):
            copy[r.randrange(300, 370)] = f"z{r.random()}"
        docs += [(2 * k, " ".join(own)), (2 * k + 1, " ".join(copy))]
    got = {x.doc_id: x.class_id for x in near_dedup.classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert all(v in (k, k - 1) for k, v in got.items()) and sum(got[2 * k + 1] == 2 * k for k in range(100)) >= 95


def template_pairs(seed, pairs, shared, own, edits):
    """Near copies 2k, 2k + 1, all of one template; the rest of the words are a pair's own."""
    r = random.Random(seed)
    docs = []
    for k in range(pairs):
        text = [f"t{i}" for i in range(shared)] + [f"u{k}_{i}" for i in range(own)]
        copy = list(text)
        for i in range(edits):
            copy[shared + own * (2 * i + 1) // (2 * edits)] = f"z{k}_{i}"
        docs += [(2 * k, " ".join(text)), (2 * k + 1, " ".join(copy))]
    return docs


def test_near_copies_in_one_bucket_of_a_template(spark):
    docs = template_pairs(6, 400, 330, 50, 3)
    got = {x.doc_id: x.class_id for x in near_dedup.classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {i: i - i % 2 for i in range(800)}


def test_near_copies_in_different_parts_of_a_crowd(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "CROWD", 8)
    docs = template_pairs(7, 400, 330, 50, 3)
    got = {x.doc_id: x.class_id for x in near_dedup.classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {i: i - i % 2 for i in range(800)}


def test_copies_after_a_row_without_doc_id(spark):
    base = words(random.Random(4), 300)
    docs = [(None, base), (1, base), (2, base), (3, base + " end"), (4, "other words " * 9)]
    got = near_dedup.classes(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)).collect()
    assert sorted((x.doc_id or 0, x.class_id or 0) for x in got) == [(0, 0), (1, 1), (2, 1), (3, 1), (4, 4)]


def spoken(r, letters, n):
    """n characters of words drawn from few."""
    known = ["".join(r.choice(letters) for _ in range(k % 5 + 2)) for k in range(40)]
    return lambda: " ".join(r.choice(known) for _ in range(n))[:n]


def test_op7_learns_from_short_long_and_unmeasured_texts(spark):
    r = random.Random(12)
    short, long, plain = spoken(r, "abcde", 60), spoken(r, "defgh", 20000), spoken(r, "ghijk", 900)
    docs = [(i, short(), "aa", 60) for i in range(30)] + [(100 + i, long(), "bb", 20000) for i in range(3)] + [(200 + i, plain(), "cc", None) for i in range(9)]
    got = language_id.identified(spark.createDataFrame(docs, "doc_id long, text string, lang string, n_chars long"), language_id.F.lit(True)).collect()
    assert len(got) == len(docs) and all(x.lang_pred == x.lang for x in got)


def test_op7_sample_is_the_first_of_each_language_by_hash(spark):
    """Repeats of a document count once, also where one document has a third of all rows."""
    F = language_id.F
    rows = [(i, "ab " * (5 + i % 200), "xy"[i % 2]) for i in range(9000)] + [(7, "ab " * 90, "y")] * 4500 + [(8, "  ", "x"), (9, None, "x"), (10, "ab", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    got = sorted((r.own, r["rank"], r.text) for r in language_id.chosen_texts(docs, F.lit(True)).collect())
    hashes = dict(docs.select("doc_id", F.xxhash64("doc_id")).distinct().collect())
    want = []
    for lang in "xy":
        best = {}
        for i, text, own in rows:
            if own == lang and text and text.strip():
                item = (0 if 200 <= len(text) <= 8000 else 1, len(text), text)
                best[i] = min(best.get(i, item), item)
        order = sorted(best, key=lambda i: (best[i][0], hashes[i], i))[: language_id.SHORT_DOCS]
        want += [(lang, k, best[i][2]) for k, i in enumerate(order, 1) if k <= language_id.SAMPLE_DOCS or best[i][1] < 200]
    assert got == sorted(want)


def test_pipeline_drops_what_no_language_parses(spark):
    import corpus_pipeline

    r = random.Random(13)
    one, two = spoken(r, "abcdefghijklm", 400), spoken(r, "abcdefghijklm", 400)
    docs = [(i, one(), "aa") for i in range(70)] + [(100 + i, two(), "bb") for i in range(70)]
    noise = "".join(r.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(190))
    docs += [(200, noise, "aa"), (201, "ѪѬѮ ѰѲѴ" * 20, "bb"), (202, two()[:190], "aa"), (203, one()[:190], None), (204, two()[:20], "aa"), (205, "12 34", "aa")]
    rows = [(i, t, g, "s", len(t)) for i, t, g in docs]
    got = {x.doc_id: x.lang for x in corpus_pipeline.identify_language(spark, spark.createDataFrame(rows, DOCS), "").collect()}
    assert got == {i: g for i, _, g in docs[:140]} | {202: "bb", 203: "aa", 204: "aa"}


def test_op3_repeated_ids_and_large_components(spark):
    big = [[40001.3, 9007199.254741, 1.0], [-3.5, 2.25, 1e6], [9007199.0, 40001.0, -1.0]]
    rows = [(100, big[0]), (100, big[1]), (100, big[1]), (7, big[2]), (7, big[0]), (200, [1.0, 0.0, 0.0]), (300, [5.0])]
    whole = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows]
    want = []
    for q in (100, 200, 300):
        own = min(v for i, v in whole if i == q)
        best = sorted((-sum(a * b for a, b in zip(own, v)), i) for i, v in whole if i != q and len(v) == len(own))[:10]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted(tuple(r) for r in got) == want
    assert topk.products(np.array([[40961331, 9223372036]]), np.array([[9223372036, 40961331]])).tolist() == [[2 * 40961331 * 9223372036]]
    with pytest.raises(OverflowError):
        topk.products(np.array([[1 << 40]]), np.array([[1 << 40]]))


def greedy_phrases(sample, text):
    n = i = 0
    while i < len(text):
        k = 1
        while i + k < len(text) and text[i : i + k + 1] in sample:
            k += 1
        i, n = i + k, n + 1
    return n


def test_op7_parses_like_brute_force():
    r = random.Random(21)
    samples = {g: "".join(r.choice("abcdefgh "[j : j + 5]) for _ in range(1500)) for j, g in enumerate("xyz")}
    model = language_id.CrossParser(samples)
    as_text = lambda x: "".join(map(chr, model.symbols(x).tolist()))
    texts = ["".join(r.choice("abcdefghq漢 ") for _ in range(n)) for n in (1, 2, 255, 256, 257, 511, 700, 4000)] + ["abc" * 700]
    names, _, bits, _ = model.predict(texts)
    for t, name, b in zip(texts, names, bits):
        own = {g: greedy_phrases(as_text(samples[g]), as_text(t)) * math.log2(len(as_text(samples[g]))) / len(as_text(t)) for g in samples}
        assert b == pytest.approx(min(own.values())) and name == min(own, key=lambda g: (own[g], g))


def test_op7_edges_grow_with_the_sample_only():
    sample = "".join(chr(0x4E00 + i % 3500) for i in range(7000))
    model = language_id.CrossParser({"a": sample, "b": "plain words " * 300})
    assert sum(e.keys.nbytes + e.to.nbytes + e.first.nbytes + e.table.nbytes for e in model.edges) < 8_000_000
    assert model.predict([sample[100:400], "words plain", None, "123"])[0] == ["a", "b", "und", "und"]


def test_longest_previous_factors_equal_brute_force():
    r = random.Random(31)
    docs = [bytes(r.choice(b"ab") for _ in range(r.randint(1, 40))) for _ in range(30)]
    docs += [docs[3] + docs[5], docs[3] + b"a", docs[7], docs[7]]
    ids = [r.randint(0, 20) for _ in docs]
    data, sizes = np.frombuffer(b"".join(docs), np.uint8), np.array([len(x) for x in docs])
    left, doc = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(data)), np.repeat(np.array(ids), sizes)
    got = suffix_dedup.longest_previous_factors(data, left, doc, np.arange(len(data)), 50)
    suffixes = [(i, x[k:]) for i, x in zip(ids, docs) for k in range(len(x))]
    for (i, x), n in zip(suffixes, got.tolist()):
        common = [next((k for k, (c, d) in enumerate(zip(x, y)) if c != d), min(len(x), len(y))) for j, y in suffixes if j < i]
        assert n == min(50, max(common, default=0))


def test_passages_do_not_trust_hashes(spark, monkeypatch):
    """With content hashes of one bit, in a task and in a shard, results stay those of brute force."""
    from geoloom.llm import passages

    cut = passages.phrases
    monkeypatch.setattr(passages, "phrases", lambda *a: (*(x := cut(*a))[:4], x[4] & np.uint64(1), x[5]))
    r = random.Random(41)
    vocabulary = [words(r, 1) for _ in range(12)]
    docs = [(i, " ".join(r.choice(vocabulary) for _ in range(60))) for i in range(30)]
    docs += [(100 + i, t) for i, t in docs[:5]]
    one = substring_dedup.resolved(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1), substring_dedup.KIND, substring_dedup.automaton_match, 100, substring_dedup._digests, substring_dedup.SCHEMA)
    flags = removed([(i, tuple(t.encode().split())) for i, t in docs], 13)
    assert {x.doc_id: x.n_removed for x in one.collect()} == {i: sum(f) for (i, _), f in zip(docs, flags)}


def test_recurring_windows_with_one_hash():
    monkey = substring_dedup.mix
    try:
        substring_dedup.mix = lambda h: h & np.uint64(0)
        codes = np.array([1, 2, 3, 9, 1, 2, 3, 4, 5, 6])
        at = np.array([0, 4, 7])
        assert sorted(substring_dedup.recurring(np.array([0, 1, 2]), codes, at, 3).tolist()) == [0, 7]
    finally:
        substring_dedup.mix = monkey


def test_pieces_of_blanks_and_long_words_equal_the_library():
    import sentencepiece

    own, sp = pieces.piece_encoder(pieces.default_model()), sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    texts = [" " * n for n in range(1, 70)] + [" " * n + "the" for n in range(70)] + [" " * n + "漢 x" for n in range(40)] + [" " * 100_000, "a" + " " * 99_999 + "b", "ab" * 20_000]
    ids, counts = own.encode(texts)
    for t, got in zip(texts, np.split(ids, np.cumsum(counts)[:-1])):
        assert got.tolist() == sp.encode(t)


def test_op5_equals_dense_ridge(spark):
    """Partition-summed normal equations, solved, against one dense least-squares problem over all rows."""
    r = np.random.default_rng(3)
    d = len(quality_classifier.NAMES)
    x = r.normal(size=(400, d))
    y = (x[:, 0] + x[:, 1] ** 2 > 1).astype(float)
    rows = spark.createDataFrame([(a.tolist(), float(b)) for a, b in zip(x, y)], "x array<double>, y double").repartition(5)
    model = quality_classifier.fitted(rows)
    z = quality_classifier.Fourier(x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3))(x)
    wide = np.vstack([z, math.sqrt(quality_classifier.RIDGE) * np.eye(z.shape[1])])
    want = np.linalg.lstsq(wide, np.append(y, np.zeros(z.shape[1])), rcond=None)[0]
    assert np.allclose(model.raw(x), z @ want, atol=1e-6)
    score = model.score(x)
    assert (np.diff(score[np.argsort(model.raw(x))]) >= -1e-12).all() and ((score >= 0.3) == (y > 0)).mean() > 0.85


def test_op2_ledger_in_the_query(spark, sf):
    rows = quality_rules.op2_quality_rules(spark, sf).collect()
    assert all(r.base_failed == bool(r.failed & quality_rules.mask(1)) and r.kept == (not r.failed & (quality_rules.mask(1) | quality_rules.mask(quality_rules.POLICY))) for r in rows)
    by = {r.rule: r.n_failed for r in quality_rules.quality_ablations(spark, sf).collect()}
    assert by == {name: sum(bool(r.failed >> b & 1) for r in rows) for b, (name, _) in quality_rules.RULES.items() if b in quality_rules.POLICIES[quality_rules.POLICY]}


def _repeated_words(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    t = [tuple(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 4 else []
    return len({i + k for i, x in enumerate(t) if t.count(x) > 1 for k in range(3)})


@pytest.mark.parametrize("bits", [64, 1, 0])
def test_op2_repeated_words_whatever_the_hash(spark, monkeypatch, bits):
    """Windows are told apart by their words where hashes meet, and no text of all windows is sorted."""
    f = quality_rules.F
    own = f.xxhash64
    if bits < 64:
        monkeypatch.setattr(f, "xxhash64", lambda *c: f.shiftleft(own(*c), 64 - bits) if bits else f.lit(0).cast("long"))
    r = np.random.default_rng(5)
    texts = [None, "", " ", "a", "a b c", "a a a a", "a b c a b c", "\x0b a b\ta b a\nb a ", "ab c d a bc d ab c d", "é é é É"] + [" ".join(r.choice(list("abcdé"), n)) for n in (4, 9, 30, 80, 200)]
    rows = quality_rules.measured(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    got = {x.doc_id: (x.n_words, x.word_chars, x.n_repeat_words) for x in rows.collect()}
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    assert got == {i: (len(w), sum(map(len, w)), _repeated_words(texts[i])) for i, w in enumerate(words)}
    assert "xxhash64" in rows._jdf.queryExecution().optimizedPlan().toString() or not bits  # windows were sorted as texts


def test_pipeline_of_an_empty_table_and_without_labels(spark, sf, empty, rows):
    import corpus_pipeline

    assert corpus_pipeline.run(spark, empty).collect() == []
    bare = spark.createDataFrame([(i, t, None, s, n) for i, t, _, s, n in rows], DOCS)
    kept = corpus_pipeline.identify_language(spark, bare, "").collect()
    assert {r.doc_id for r in kept} == {i for i, t, *_ in rows if t and any(c.isalpha() for c in t)}


def test_pipeline_deletes_what_it_wrote_on_the_way(spark, sf):
    import corpus_pipeline
    from geoloom.llm import common

    before = len(common._made)
    out = corpus_pipeline.run(spark, sf)
    assert out.count() and len(common._made) - before <= 2  # the last stage's input


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from geoloom.llm.common import shared_dir

    conf = SimpleNamespace(get=lambda *_: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(SimpleNamespace(sparkContext=SimpleNamespace(getConf=lambda: conf, master="spark://h:7077"), conf=conf))
