"""MinHash near-dedup by improved consistent weighted sampling (ICWS).

1. Shingles are five words in a row (all words, where a text has fewer).  Their document frequencies are
   counted over all documents in ``BUCKETS`` hash buckets; a shingle's weight is its count in the text times
   1 + ``DAMPING`` * idf, idf in 0..1.  The damping keeps large groups of copies, whose common shingles are
   frequent for that reason alone, near the similarity that the plain shingles give.
2. Each distinct text gets BANDS * ROWS ICWS samples: equal for two texts with the probability of
   their weighted Jaccard similarity.  Bands of ROWS samples make buckets.
3. In a bucket, the tree of greatest agreement of the samples joins its texts (n - 1 pairs for n texts,
   never all): two texts that a chain of similar ones joins are joined by similar pairs of the tree too.  A
   bucket of over ``CROWD`` texts is dealt into parts that all hold its first text, otherwise in every band.
   That only bounds the first trees: pairs of different parts are left to step 5, whatever the bucket's size.
4. Every pair is verified by the weighted Jaccard similarity of the two whole texts, ``SIMILAR`` at least.
5. Verified pairs join texts to groups.  Where a bucket still holds texts of several groups, whatever of these
   texts could still be similar is verified too (``remaining_pairs``): in an order of all shingles, the rarer first, two similar texts have their first
   common shingle early in both, and the weights from there on bound what they can have in common.  So no
   pair that shares a bucket is left out: it is verified, in one group already, or known to be under ``SIMILAR``.
6. Verified pairs and equal texts make classes, found by stars (``components``).

Cases: texts without words (or null) are classes of their own; a null doc_id gets a null class; rows
that share a doc_id are one document; equal texts are one class; an empty table gives no rows; further
columns are ignored.  Texts of any length are read whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batches, frugal, materialized, shuffle_partitions, table
from .components import components
from .passages import mix, words_of
from .tokens import prefix_hashes, span_hashes

WORDS, SIMILAR, DAMPING = 5, 0.8, 0.25
BANDS, ROWS = 10, 4
BUCKETS, CROWD = 1 << 18, 2048
#: Entries of the table of random numbers that a sample looks up; shingles sampled at a time.
TABLE, BLOCK = 1 << 16, 1 << 16
#: Least agreement of samples for a pair to be verified.
PLAUSIBLE = 0.5
#: What rounding may add to a bound of weights.
SLACK = 1e-4


def shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, hash and count of each distinct shingle, ordered by text and hash."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    n = len(texts)
    none = np.zeros(0, np.int64)
    if not len(data):
        return none, none.astype(np.uint64), none
    starts, stops, words = words_of(data, np.cumsum([len(x) for x in texts]))
    if not len(starts):
        return none, none.astype(np.uint64), none
    own = span_hashes(prefix_hashes(data), starts, stops)
    text = np.repeat(np.arange(n), words)
    ends = np.cumsum(words)
    left = ends[text] - np.arange(len(own))  # words from here to the text's end
    h = own.copy()
    for i in range(1, WORDS):
        h[:-i] = np.where(left[:-i] > i, mix(h[:-i]) + own[i:], h[:-i])
    first = np.zeros(len(own), bool)
    first[(ends - words)[words > 0]] = True
    keep = (left >= WORDS) | (first & (words[text] < WORDS))
    h, text = mix(h[keep]), text[keep]
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    at = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (text[1:] != text[:-1])))
    return text[at], h[at], np.diff(np.append(at, len(h)))


def _added(parts: DataFrame, kind: type) -> np.ndarray | None:
    """The sum of arrays that come as (p, sums binary), in a tree; one comes to the driver."""

    def add(frame: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, kind) for x in frame.column("sums").to_pylist())
        return pa.table({"p": pa.array([frame.column("p")[0].as_py()], pa.int32()), "sums": pa.array([total.tobytes()], pa.binary())})

    for width in (1024, 32, 1):
        parts = parts.withColumn("p", F.col("p") % width).groupBy("p").applyInArrow(add, "p int, sums binary")
    found = [np.frombuffer(r[0], kind) for r in parts.select("sums").collect()]
    return sum(found) if found else None


def weights_table(docs: DataFrame) -> np.ndarray:
    """The factor 1 + DAMPING * idf of each hash bucket, from all texts of docs."""

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros(BUCKETS + 1, np.int64)
        for batch in batches(rows, 2_000_000):
            text, h, _ = shingles([(x or "").encode() for x in batch.column("text").to_pylist()])
            total[:-1] += np.bincount(h >> np.uint64(46), minlength=BUCKETS)
            total[-1] += len(np.unique(text))
        if total[-1]:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["p", "sums"])

    total = _added(docs.select("text").mapInArrow(frugal(count), "p int, sums binary"), np.int64)
    if total is None:
        return np.ones(BUCKETS, np.float32)
    n = int(total[-1])
    idf = np.clip(np.log((n + 1) / (total[:-1] + 1)) / np.log(n + 1), 0, 1)
    return (1 + DAMPING * idf).astype(np.float32)


class Sampler:
    """ICWS with random numbers looked up by a hash of the shingle and the sample's number."""

    def __init__(self, factor: np.ndarray):
        random = np.random.default_rng(11)
        self.factor = factor
        self.r = random.gamma(2, 1, TABLE).astype(np.float32)
        self.one_by_r = 1 / self.r
        self.beta = random.uniform(0, 1, TABLE).astype(np.float32)
        self.c = (np.log(random.gamma(2, 1, TABLE)) - self.r).astype(np.float32)
        self.odd = random.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def weights(self, h: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return counts * self.factor[(h >> np.uint64(46)).astype(np.int64)]

    def _block(self, text: np.ndarray, h: np.ndarray, logw: np.ndarray, out: np.ndarray) -> None:
        start = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
        sizes = np.diff(np.append(start, len(text)))
        names = text[start]
        for j, odd in enumerate(self.odd):
            at = ((h * odd) >> np.uint64(48)).astype(np.int32)
            r, beta = self.r[at], self.beta[at]
            step = np.floor(logw * self.one_by_r[at] + beta)
            value = self.c[at] - r * (step - beta)
            least = np.minimum.reduceat(value, start)
            hit = np.flatnonzero(value == np.repeat(least, sizes))
            chosen = hit[np.searchsorted(hit, start)]  # ties go to the smaller hash
            out[names, j] = mix(h[chosen] + step[chosen].astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def samples(self, n: int, text: np.ndarray, h: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """A row of samples of each of n texts; 0 where a text has no shingle."""
        out = np.zeros((n, BANDS * ROWS), np.uint64)
        logw = np.log(self.weights(h, counts)).astype(np.float32)
        a = 0
        while a < len(text):  # whole texts, about BLOCK shingles
            b = int(np.searchsorted(text, text[min(a + BLOCK, len(text)) - 1], "right"))
            self._block(text[a:b], h[a:b], logw[a:b], out)
            a = b
        return out


def sketches(docs: DataFrame, factor: np.ndarray) -> DataFrame:
    """doc_id, key (of equal texts), bands (array<long>) and samples (16 bits each) of each row.

    bands is null for texts without words, for texts that the task has met before, and without doc_id.
    """

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, met = Sampler(factor), set()
        for batch in batches(rows, 2_000_000):
            raw = [(x or "").encode() for x in batch.column("text").to_pylist()]
            keys = [hashlib.md5(x).digest() for x in raw]
            fresh = []
            for i, (k, named) in enumerate(zip(keys, batch.column("doc_id").is_valid().to_pylist())):
                if named and k not in met:
                    met.add(k)
                    fresh.append(i)
            text, h, counts = shingles([raw[i] for i in fresh])
            got = own.samples(len(fresh), text, h, counts)
            some = np.zeros(len(fresh), bool)
            some[text] = True
            bands = got.reshape(len(fresh), BANDS, ROWS)
            key = np.arange(BANDS, dtype=np.uint64)[None, :].repeat(len(fresh), 0)
            for i in range(ROWS):
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + bands[:, :, i])
            out_bands: list = [None] * len(raw)
            out_samples: list = [None] * len(raw)
            short = got.astype(np.uint16)
            for k, i in enumerate(fresh):
                if some[k]:
                    out_bands[i], out_samples[i] = key[k].view(np.int64), short[k].tobytes()
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(keys, pa.binary()), pa.array(out_bands, pa.list_(pa.int64())), pa.array(out_samples, pa.binary())], names=["doc_id", "key", "bands", "samples"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(frugal(run), "doc_id long, key binary, bands array<long>, samples binary")


def tree_pairs(ids: np.ndarray, samples: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of the tree of greatest agreement, the plausible ones; ties go to smaller ids."""
    order = np.argsort(ids)
    ids, samples = ids[order], samples[order]
    n, out = len(ids), []
    best = (samples == samples[0]).sum(axis=1)
    near, done = np.zeros(n, np.int64), np.zeros(n, bool)
    done[0] = True
    for _ in range(n - 1):
        i = int(np.argmax(np.where(done, -1, best)))
        done[i] = True
        if best[i] >= PLAUSIBLE * samples.shape[1]:
            out.append((int(ids[near[i]]), int(ids[i])))
        agree = (samples == samples[i]).sum(axis=1)
        more = agree > best
        best[more], near[more] = agree[more], i
    return out


def _dealt(rows: DataFrame) -> DataFrame:
    """rows (g, rep, samples) with parts of their buckets.

    A bucket of over CROWD texts is dealt into parts that all hold its first text.
    """
    counted = rows.groupBy("g").agg(F.count("*").alias("many"), F.min(F.struct("rep", "samples")).alias("lead")).where(F.col("many") > CROWD)
    crowds = materialized(counted.select("g", F.ceil(F.col("many") / CROWD).cast("int").alias("parts"), "lead.rep", "lead.samples"), "crowds")
    part = F.coalesce(F.pmod(F.xxhash64("rep", "g"), F.col("parts")), F.lit(0)).cast("int")
    own = rows.join(crowds.select("g", "parts"), "g", "left").select("g", part.alias("part"), "rep", "samples")
    leads = crowds.select("g", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "rep", "samples")
    return own.unionAll(leads)


def whole_groups(rows: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows, ordered by keys, again: no group of equal keys is cut."""
    held = None
    for batch in rows:
        now = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        if not now.num_rows:
            continue
        last = np.flatnonzero(np.any([(x := np.asarray(now.column(k))) != x[-1] for k in keys], axis=0))
        cut = int(last[-1]) + 1 if len(last) else 0
        if cut:
            yield now.slice(0, cut)
        held = now.slice(cut)
    if held is not None and held.num_rows:
        yield held


def _pairs(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    both = np.unique(np.array(pairs, np.int64).reshape(-1, 2), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(both[:, i]) for i in (0, 1)], names=["a", "b"])


def candidate_pairs(texts: DataFrame) -> DataFrame:
    """a, b of pairs worth verifying among texts (rep, bands, samples); a = b for each text that shares a bucket."""
    n = shuffle_partitions(texts.sparkSession)
    dealt = _dealt(texts.select(F.explode("bands").alias("g"), "rep", "samples"))

    def run(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches_, ["g", "part"]):
            g, part, rep = (np.asarray(rows.column(c)) for c in ("g", "part", "rep"))
            at = np.flatnonzero(np.append(True, (g[1:] != g[:-1]) | (part[1:] != part[:-1])))
            ends = np.append(at[1:], len(g))
            several = ends - at > 1
            out = []
            if several.any():
                keep = np.repeat(several, ends - at)
                some = rows.filter(pa.array(keep))
                data = np.frombuffer(b"".join(some.column("samples").to_pylist()), np.uint16).reshape(some.num_rows, BANDS * ROWS)
                rep, size = rep[keep], (ends - at)[several]
                for b, s in zip(np.cumsum(size).tolist(), size.tolist()):
                    ids, first = np.unique(rep[b - s : b], return_index=True)
                    if len(ids) > 1:
                        out += tree_pairs(ids, data[b - s : b][first]) + [(i, i) for i in ids.tolist()]
            yield _pairs(out)

    dealt = dealt.repartition(n, "g", "part").sortWithinPartitions("g", "part")
    return dealt.mapInArrow(frugal(run), "a long, b long").distinct()


def verified(pairs: DataFrame, texts: DataFrame, factor: np.ndarray) -> DataFrame:
    """The pairs (a, b) whose texts' (rep, text) weighted Jaccard similarity is SIMILAR at least."""
    both = pairs.join(texts.select(F.col("rep").alias("a"), F.col("text").alias("ta")), "a").join(texts.select(F.col("rep").alias("b"), F.col("text").alias("tb")), "b")

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weigh = Sampler(factor)
        for wide in rows:
            for batch in batches(iter([wide]), 1_000_000, "ta"):
                n = batch.num_rows
                raw = [(x or "").encode() for c in ("ta", "tb") for x in batch.column(c).to_pylist()]
                text, h, counts = shingles(raw)
                w = weigh.weights(h, counts)
                pair, second = text % n, text >= n
                order = np.lexsort((second, h, pair))
                pair, h, w = pair[order], h[order], w[order]
                twice = np.flatnonzero((pair[1:] == pair[:-1]) & (h[1:] == h[:-1]))
                common = np.bincount(pair[twice], np.minimum(w[twice], w[twice + 1]), n)
                total = np.bincount(pair, w, n) - common
                good = np.flatnonzero(common >= SIMILAR * np.maximum(total, 1e-9) - 1e-6)
                yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(good)) for c in ("a", "b")], names=["a", "b"])

    return both.select("a", "b", "ta", "tb").mapInArrow(frugal(run), "a long, b long")


def early_shingles(texts: list[bytes], factor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, hash, weight of the whole text and weight from here on, of each shingle that can be the first
    one, rarer before commoner, that the text has in common with a similar text."""
    text, h, counts = shingles(texts)
    if not len(h):
        return text, h, np.zeros(0), np.zeros(0)
    f = factor[(h >> np.uint64(46)).astype(np.int64)]
    order = np.lexsort((h, -f, text))
    text, h, w = text[order], h[order], (counts * f)[order].astype(np.float64)
    total = np.bincount(text, w, len(texts))
    ends = np.cumsum(total)
    rest = ends[text] - np.cumsum(w) + w
    keep = rest >= SIMILAR * total[text] - SLACK
    return text[keep], h[keep], total[text[keep]], rest[keep]


def sharing_pairs(rep: np.ndarray, own: np.ndarray, total: np.ndarray, rest: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pairs of different groups among texts with one shingle, as far as the weights from it on let them be similar.

    The pairs within the largest group are not looked at.
    """
    order = np.argsort(total, kind="stable")
    rep, own, total, rest = rep[order], own[order], total[order], rest[order]
    names, many = np.unique(own, return_counts=True)
    largest = own == names[many.argmax()]
    others = np.flatnonzero(~largest)
    lows = np.searchsorted(total, SIMILAR * total[others] - SLACK)
    highs = np.searchsorted(total, (total[others] + SLACK) / SIMILAR, "right")
    for i, a, b in zip(others.tolist(), lows.tolist(), highs.tolist()):
        least = SIMILAR / (1 + SIMILAR) * (total[a:b] + total[i]) - SLACK
        found = (np.minimum(rest[a:b], rest[i]) >= least) & (own[a:b] != own[i]) & (largest[a:b] | (np.arange(a, b) > i))
        x = int(rep[i])
        for y in rep[a:b][found].tolist():
            yield (x, y) if x < y else (y, x)


def remaining_pairs(texts: DataFrame, factor: np.ndarray) -> DataFrame:
    """a, b of pairs from different groups among texts (rep, own: its group, text) that may be similar."""
    n = shuffle_partitions(texts.sparkSession)

    def spread(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for wide in rows:
            for batch in batches(iter([wide]), 1_000_000):
                text, h, total, rest = early_shingles([(x or "").encode() for x in batch.column("text").to_pylist()], factor)
                at = pa.array(text)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), batch.column("rep").take(at), batch.column("own").take(at), pa.array(total), pa.array(rest)], names=["g", "rep", "own", "total", "rest"])

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in whole_groups(rows, ["g"]):
            g, rep, own, total, rest = (np.asarray(group.column(c)) for c in ("g", "rep", "own", "total", "rest"))
            at = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
            ends = np.append(at[1:], len(g))
            mixed = np.minimum.reduceat(own, at) != np.maximum.reduceat(own, at)
            out: list[tuple[int, int]] = []
            for a, b in zip(at[mixed].tolist(), ends[mixed].tolist()):
                for pair in sharing_pairs(rep[a:b], own[a:b], total[a:b], rest[a:b]):
                    out.append(pair)
                    if len(out) >= 1_000_000:
                        yield _pairs(out)
                        out = []
            yield _pairs(out)

    early = texts.select("rep", "own", "text").mapInArrow(frugal(spread), "g long, rep long, own long, total double, rest double")
    return early.repartition(n, "g").sortWithinPartitions("g").mapInArrow(frugal(run), "a long, b long").distinct()


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (the least doc_id of its class) and text_id (of its equal texts), a row each."""
    factor = weights_table(docs)
    rows = materialized(sketches(docs, factor), "sketches")
    keys = rows.where(F.col("doc_id").isNotNull()).groupBy("key").agg(F.min("doc_id").alias("rep"))
    sampled = rows.where(F.col("bands").isNotNull() & F.col("doc_id").isNotNull()).groupBy("key").agg(F.min(F.struct("doc_id", "bands", "samples")).alias("one"))
    named = materialized(keys.join(sampled, "key").select("key", "rep", "one.bands", "one.samples"), "texts")
    pairs = materialized(candidate_pairs(named.select("rep", "bands", "samples")), "pairs")
    # the texts that share a bucket, read once: what is verified below is among them
    shared = pairs.where("a = b").select(F.col("a").alias("rep"))
    own = docs.select(F.col("doc_id").cast("long").alias("rep"), F.col("text").cast("string"), F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("key"))
    texts = materialized(own.join(shared.join(named.select("rep", F.lower(F.hex("key")).alias("key")), "rep"), ["rep", "key"], "left_semi").dropDuplicates(["rep"]), "whole")
    groups = materialized(components(verified(pairs.where("a <> b"), texts, factor)), "groups")
    # of them, those in a bucket that still holds texts of several groups
    placed = named.join(shared, "rep", "left_semi").select("rep", F.explode("bands").alias("g")).join(groups, F.col("rep") == F.col("node"), "left").select("g", "rep", F.coalesce("root", "rep").alias("own"))
    placed = materialized(placed, "placed")
    mixed = placed.groupBy("g").agg(F.min("own").alias("low"), F.max("own").alias("high")).where("low < high").select("g")
    apart = placed.join(mixed, "g", "left_semi").select("rep", "own").distinct()
    more = materialized(remaining_pairs(texts.join(apart, "rep"), factor).join(pairs, ["a", "b"], "left_anti"), "more")
    links = components(groups.select(F.col("node").alias("a"), F.col("root").alias("b")).unionAll(verified(more, texts, factor)))
    of_text = named.join(links, F.col("rep") == F.col("node"), "left").select("key", "rep", F.coalesce("root", "rep").alias("class"))
    found = rows.select("doc_id", "key").join(of_text, "key", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("class", "doc_id"))
    return found.select("doc_id", own.alias("class_id"), F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id")).alias("text_id"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents"))
