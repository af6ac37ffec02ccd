"""Quality scores: random Fourier features of document statistics, ridge regression, isotonic steps.

1. ``statistics``: one pass over the texts gives each document's statistics (shares of character classes,
   word lengths, repetition); they are written once, a few numbers a document.
2. The labelled rows' statistics are standardised and mapped to ``FEATURES`` random cosines, whose inner
   products approximate a Gaussian kernel.  Every partition adds up its part of the normal equations,
   the parts are summed in a tree, and the driver solves one system of fixed size.
3. The raw scores of the labelled rows are counted in ``BINS`` bins of fixed width; pooling adjacent
   violators over the bins gives a calibration that never falls.

Labels, lang, source and doc_id are never inputs of a score.

Cases: null and empty texts have zero statistics and a score like any other; a null doc_id is not learned from nor held
out; repeated rows are each scored; a doc_id with several labels counts with each; labels that are null are
left out; texts of any length are measured whole; without labelled rows every score is 0.5; an empty table gives no rows; further columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batches, frugal, materialized, table
from .language_id import fold
from .passages import words_of
from .tokens import prefix_hashes, span_hashes

FEATURES, BANDWIDTH, RIDGE, SEED = 256, 4.0, 1e-2, 7
BINS, LOW, HIGH = 512, -0.5, 1.5
FOLDS, HELD_OUT, THRESHOLD = 5, 0, 0.3
CLASSES = {"upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "marks": b"#*$%&<>", "bar": b"|", "bang": b"!", "stop": b".,;:?", "space": b" ", "line": b"\n", "wide": range(128, 256), "other": b"@_/\\=+-()[]{}\"'~^"}
NAMES = [*CLASSES, "words", "word_mean", "word_spread", "distinct", "commonest", "pairs_repeated", "marked_words", "line_mean"]


def _class_table() -> np.ndarray:
    out = np.zeros(256, np.int64)
    for i, x in enumerate(CLASSES.values()):
        out[list(x)] = i + 1
    return out


def _per_text(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(owner, values, n)


def text_statistics(texts: list[str | None]) -> np.ndarray:
    """A row of statistics (NAMES) of each text."""
    raw = [(x or "").encode() for x in texts]
    data, n = np.frombuffer(b"".join(raw), np.uint8), len(raw)
    sizes = np.array([len(x) for x in raw], np.int64)
    ends = np.cumsum(sizes)
    kinds = len(CLASSES) + 1
    owner = np.repeat(np.arange(n, dtype=np.int64) * kinds, sizes)
    owner += _class_table()[data]
    shares = np.bincount(owner, minlength=n * kinds).reshape(n, kinds)[:, 1:] / np.maximum(sizes, 1)[:, None]
    lines = shares[:, list(CLASSES).index("line")] * sizes + 1
    del owner
    starts, stops, words = words_of(data, ends) if len(data) else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(n, np.int64))
    many = np.maximum(words, 1)
    text = np.repeat(np.arange(n), words)
    lengths = (stops - starts).astype(float)
    mean = _per_text(lengths, text, n) / many
    spread = np.sqrt(np.maximum(_per_text(lengths**2, text, n) / many - mean**2, 0))

    def repeats(keys: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct keys of each text, and how often its commonest key stands."""
        if not len(keys):
            return np.zeros(n), np.zeros(n)
        order = np.lexsort((keys, owner))
        k, o = keys[order], owner[order]
        at = np.flatnonzero(np.append(True, (k[1:] != k[:-1]) | (o[1:] != o[:-1])))
        most = np.zeros(n)
        np.maximum.at(most, o[at], np.diff(np.append(at, len(k))).astype(float))
        return np.bincount(o[at], minlength=n), most

    keys = span_hashes(prefix_hashes(data), starts, stops) if len(starts) else np.zeros(0, np.uint64)
    distinct, most = repeats(keys, text)
    pair = np.flatnonzero(text[1:] == text[:-1])
    pairs, _ = repeats(keys[pair] * np.uint64(31) + keys[pair + 1] if len(pair) else keys[:0], text[pair])
    marked = np.isin(data[stops - 1], np.frombuffer(b"#*$%&|<>!", np.uint8)) if len(stops) else np.zeros(0, bool)
    rest = [np.log1p(words), np.minimum(mean, 60), np.minimum(spread, 60), distinct / many, most / many, 1 - pairs / np.maximum(words - 1, 1), _per_text(marked.astype(float), text, n) / many, np.log1p(words / lines)]
    out = np.column_stack([shares, *rest])
    out[words == 0, len(CLASSES) :] = 0
    return out


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and x (array<double>) of each row."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, 2_000_000):
            x = text_statistics(batch.column("text").to_pylist())
            lists = pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), x.ravel())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], names=["doc_id", "x"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(frugal(run), "doc_id long, x array<double>")


class Fourier:
    """Standardises statistics and maps them to cosines of random directions."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray):
        random = np.random.default_rng(SEED)
        self.mean, self.scale = mean, scale
        self.directions = random.normal(0, 1 / BANDWIDTH, (len(mean), FEATURES))
        self.phases = random.uniform(0, 2 * np.pi, FEATURES)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.column_stack([np.sqrt(2 / FEATURES) * np.cos(z @ self.directions + self.phases), np.ones(len(z))])


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.asarray(batch.column("x").flatten()).reshape(batch.num_rows, len(NAMES))


def normal_equations(rows: DataFrame, features: Fourier) -> tuple[np.ndarray, np.ndarray]:
    """The sums of z z' and z y over rows (x, y), added by partition and then in a tree."""
    size = FEATURES + 1

    def part(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros((size, size + 1))
        for batch in batches_:
            z = features(_matrix(batch))
            total[:, :-1] += z.T @ z
            total[:, -1] += z.T @ np.asarray(batch.column("y"), np.float64)
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["p", "sums"])

    def add(frame: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.float64) for x in frame.column("sums").to_pylist())
        return pa.table({"p": pa.array([frame.column("p")[0].as_py()], pa.int32()), "sums": pa.array([total.tobytes()], pa.binary())})

    parts, width = rows.mapInArrow(part, "p int, sums binary"), 1 << 20
    while width > 32:  # at most 32 sums come to the driver
        width = max(32, width >> 5)
        parts = parts.withColumn("p", F.col("p") % width)
        if width <= 1024:
            parts = parts.groupBy("p").applyInArrow(add, "p int, sums binary")
    total = sum((np.frombuffer(r[0], np.float64) for r in parts.select("sums").collect()), np.zeros(size * (size + 1))).reshape(size, size + 1)
    return total[:, :-1], total[:, -1]


def pooled(sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Isotonic fit: means of adjacent bins, pooled until they never fall; empty bins take a neighbour's."""
    blocks: list[list[float]] = []
    for i in np.flatnonzero(counts):
        blocks.append([sums[i], counts[i], i])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            s, c, i0 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s, blocks[-1][1] + c, i0]
    fit, start = np.zeros(len(counts)), 0
    for s, c, end in blocks:
        fit[start : int(end) + 1] = s / c
        start = int(end) + 1
    fit[start:] = fit[start - 1] if start else 0.5
    return fit


def bin_of(raw: np.ndarray) -> np.ndarray:
    return np.clip((raw - LOW) / (HIGH - LOW) * BINS, 0, BINS - 1).astype(np.int64)


class Model:
    def __init__(self, features: Fourier, weights: np.ndarray, steps: np.ndarray | None = None):
        self.features, self.weights, self.steps = features, weights, steps

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated; within a step the raw score still orders a little."""
        raw = self.raw(x)
        return np.clip(0.999 * self.steps[bin_of(raw)] + 0.001 * np.clip((raw - LOW) / (HIGH - LOW), 0, 1), 0, 1)


def fitted(rows: DataFrame) -> Model | None:
    """The model of labelled rows (x array<double>, y double)."""
    d = len(NAMES)
    moments = rows.agg(F.count("*"), *[f(F.get("x", F.lit(i))) for i in range(d) for f in (F.avg, F.stddev_pop)]).first()
    if not moments[0]:
        return None
    m = np.array(moments[1:], np.float64).reshape(d, 2)
    features = Fourier(m[:, 0], np.maximum(m[:, 1], 1e-3))
    a, b = normal_equations(rows, features)
    model = Model(features, np.linalg.solve(a + RIDGE * np.eye(len(a)), b))

    def count(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(BINS), np.zeros(BINS)
        for batch in batches_:
            at = bin_of(model.raw(_matrix(batch)))
            sums += np.bincount(at, np.asarray(batch.column("y"), np.float64), BINS)
            counts += np.bincount(at, minlength=BINS)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at]), pa.array(counts[at])], names=["bin", "s", "c"])

    bins = rows.mapInArrow(count, "bin long, s double, c double").groupBy("bin").agg(F.sum("s"), F.sum("c")).collect()
    sums, counts = np.zeros(BINS), np.zeros(BINS)
    for i, s, c in bins:
        sums[i], counts[i] = s, c
    model.steps = pooled(sums, counts)
    return model


def scored(stats: DataFrame, model: Model | None) -> DataFrame:
    """doc_id and score of each row of stats."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            score = model.score(_matrix(batch)) if model else np.full(batch.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], names=["doc_id", "score"])

    return stats.select("doc_id", "x").mapInArrow(run, "doc_id long, score double")


def classified(docs: DataFrame, labels: DataFrame, trained: Column, label: str = "quality") -> DataFrame:
    """doc_id and score of all docs; learns from the labels of the documents where ``trained`` holds."""
    stats = materialized(statistics(docs), "statistics")
    known = labels.where(F.col(label).isNotNull() & trained).select("doc_id", F.col(label).cast("double").alias("y"))
    rows = materialized(stats.where(trained).join(known, "doc_id").select("x", "y"), "labelled")
    return scored(stats, fitted(rows))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fold(F.col("doc_id"), FOLDS) == HELD_OUT
    found = classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), F.coalesce(~out, F.lit(False)))
    return found.select("doc_id", F.coalesce(out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
