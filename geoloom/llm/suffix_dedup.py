"""Suffix-array dedup: bytes under a string that an earlier document holds are removed.

The phrases of a bucket (see ``passages``) are put in suffix order by prefix doubling, with the lengths that
neighbours have in common (both to the depth of a window).  The longest previous factor of a position, over
smaller documents, is what it has in common with the previous or the next position in suffix order whose document is
smaller, whichever is more; where it reaches the window's length, the later copy goes and the first one stays.

Cases: a null text is an empty one; texts shorter than a window are kept whole; rows without doc_id are
kept whole and take nothing from others; rows that repeat a doc_id (ties) do not remove each other; an empty
table gives no rows; further columns are ignored.  Texts of any length are treated whole.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import table
from .passages import Kind, Spans, covered, resolved

WINDOW, GRAM = 50, 20
#: Bytes of phrases that are put in suffix order at once.
SORTED_BYTES = 1_000_000
KIND = Kind("bytes", WINDOW, GRAM, merge=True)
SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def suffix_levels(data: np.ndarray, left: np.ndarray, depth: int) -> list[tuple[int, np.ndarray]]:
    """Depths and ranks of the suffixes by so many bytes, the last one ``depth``; suffixes end where ``left`` bytes are left."""
    n = len(data)
    wide = np.zeros(n + 8, np.uint64)
    wide[:n] = data.astype(np.uint64) + np.uint64(1)
    key = np.zeros(n, np.uint64)
    for i in range(7):  # 7 symbols of 9 bits
        key = (key << np.uint64(9)) | np.where(left > i, wide[i : n + i], 0)
    out, done = [(7, np.unique(key, return_inverse=True)[1])], 7
    while done < depth:
        step, rank = min(done, depth - done), out[-1][1].astype(np.uint64)
        next_ = np.zeros(n, np.uint64)
        next_[: n - step] = np.where(left[: n - step] > step, rank[step:] + np.uint64(1), 0)
        done += step
        out.append((done, np.unique(rank * np.uint64(n + 2) + next_, return_inverse=True)[1]))
    return out


def suffix_ranks(data: np.ndarray, left: np.ndarray, depth: int) -> np.ndarray:
    """Rank of each suffix by its first ``depth`` bytes."""
    return suffix_levels(data, left, depth)[-1][1]


def common_lengths(data: np.ndarray, left: np.ndarray, levels: list[tuple[int, np.ndarray]], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many bytes the suffixes at a and b have in common, at most the depth of the last level."""
    depth, rank = levels[-1]
    most = np.minimum(np.minimum(left[a], left[b]), depth)
    out = np.where(rank[a] == rank[b], most, 0)
    open_ = np.flatnonzero(rank[a] != rank[b])
    x, y = a[open_], b[open_]
    got, last = np.zeros(len(x), np.int64), len(data) - 1
    for size, rank in levels[-2::-1]:  # each level's depth is twice the one before, so it fits once
        got += size * ((got < most[open_]) & (rank[np.minimum(x + got, last)] == rank[np.minimum(y + got, last)]))
    going = np.ones(len(x), bool)
    for _ in range(levels[0][0] - 1):
        going &= (got < most[open_]) & (data[np.minimum(x + got, last)] == data[np.minimum(y + got, last)])
        got += going
    out[open_] = np.minimum(got, most[open_])
    return out


def before_smaller(doc: np.ndarray, common: np.ndarray) -> np.ndarray:
    """What each position has in common with the nearest one before it whose document is smaller, 0 if there is none.

    common[i] is what i has in common with i - 1.  All positions jump at once over stretches known to be no smaller.
    """
    at, least = np.arange(len(doc)) - 1, common.copy()
    going = np.flatnonzero(at >= 0)
    going = going[doc[at[going]] >= doc[going]]
    while len(going):
        over = at[going]
        least[going], at[going] = np.minimum(least[going], least[over]), at[over]
        going = going[at[going] >= 0]
        going = going[doc[at[going]] >= doc[going]]
    return np.where(at >= 0, least, 0)


def longest_previous_factors(data: np.ndarray, left: np.ndarray, doc: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """For positions ``at``: the longest string (to ``depth``) that begins there and at one of them in a smaller document."""
    levels = suffix_levels(data, left, depth)
    by = np.lexsort((doc[at], levels[-1][1][at]))
    order = at[by]
    common = np.append(0, common_lengths(data, left, levels, order[1:], order[:-1])) if len(order) else np.zeros(0, np.int64)
    previous = before_smaller(doc[order], common)
    following = before_smaller(doc[order][::-1], np.append(0, common[:0:-1]))[::-1] if len(order) else previous
    out = np.zeros(len(at), np.int64)
    out[by] = np.maximum(previous, following)
    return out


def previous_factor_match(doc: np.ndarray, windows: np.ndarray, body: np.ndarray, sizes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows whose longest previous factor, over smaller documents, is as long as a window."""
    ends = np.cumsum(sizes)
    phrase = np.repeat(np.arange(len(sizes)), sizes)
    left = ends[phrase] - np.arange(len(body))
    at = np.flatnonzero(left >= window)
    gone = at[longest_previous_factors(body, left, doc[phrase], at, window) >= window]
    return phrase[gone], gone - (ends - sizes)[phrase[gone]]


def kept_text(raw: bytes, spans: tuple[np.ndarray, np.ndarray] | None) -> tuple[bytes, int, int]:
    """What is left of a text, how many bytes went, and in how many runs."""
    if spans is None:
        return raw, 0, 0
    a, b = covered(*spans, WINDOW, len(raw))
    keep = [raw[x:y] for x, y in zip([0, *b.tolist()], [*a.tolist(), len(raw)])]
    return b"".join(keep), int((b - a).sum()), len(a)


def _digests(docs: pa.RecordBatch, spans: Spans) -> pa.RecordBatch:
    out = []
    for d, x in zip(docs.column("doc_id").to_pylist(), docs.column("text").to_pylist()):
        raw = (x or "").encode()
        kept, gone, runs = kept_text(raw, spans.get((d, zlib.crc32(raw))) if spans else None)
        out.append((d, len(raw), gone, runs, hashlib.sha256(kept).hexdigest()))
    cols = list(zip(*out)) or [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 4 + [pa.string()])], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _documents(docs: pa.RecordBatch, spans: Spans) -> pa.RecordBatch:
    texts = []
    for d, x in zip(docs.column("doc_id").to_pylist(), docs.column("text").to_pylist()):
        raw = (x or "").encode()
        own = spans.get((d, zlib.crc32(raw)))
        texts.append(x if own is None else kept_text(raw, own)[0].decode(errors="ignore"))
    docs = docs.set_column(docs.column_names.index("text"), "text", pa.array(texts, pa.string()))
    return docs.set_column(docs.column_names.index("n_chars"), "n_chars", pa.array([None if x is None else len(x) for x in texts], pa.int64()))


def deduplicated(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text, lang, source, n_chars) with the later copies cut out of the texts.

    A character that loses some of its bytes goes whole.
    """
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    return resolved(docs, KIND, previous_factor_match, SORTED_BYTES, _documents, schema, ("lang", "source", "n_chars"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolved(table(spark, sf_dir, "documents"), KIND, previous_factor_match, SORTED_BYTES, _digests, SCHEMA)
