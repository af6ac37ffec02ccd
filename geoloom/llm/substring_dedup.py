"""Substring dedup by repeated-phrase automata.

Phrases of all documents are dealt to shards by their content (see ``passages``; a phrase whose minimizer
one document alone has cannot recur and is left out).  In a shard, the words get exact numbers; windows of ``WINDOW``
words whose hash several documents have are confirmed as recurring and compiled, word by word, into an
Aho-Corasick automaton; every phrase of the shard then streams through it.  The hits alone decide: the first
document of a passage is the least one that it was found in, and an occurrence in a larger document is
removed, with all words it covers.

Cases: a null text has no words; texts of fewer than 13 words are kept whole; rows without doc_id are kept whole
and take nothing from others; rows that repeat a doc_id (ties) do not remove each other, each loses what smaller ones
have; an empty table gives no rows; further columns are ignored.  Texts of any length are treated whole.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import table
from .passages import Kind, Spans, covered, mix, resolved
from .tokens import powers, ragged

WINDOW, GRAM = 13, 5
#: Bytes of phrases in a shard of the automata.
SHARD_BYTES = 400_000
KIND = Kind("words", WINDOW, GRAM, merge=False)
SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def recurring(doc: np.ndarray, codes: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    """Places of one window of each content that several documents have; all of them where only the hash is the same."""
    up, down = powers(len(codes) + 1)
    prefix = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up[: len(codes)], out=prefix[1:])
    key = mix((prefix[at + window] - prefix[at]) * down[at])
    order = np.argsort(key, kind="stable")
    edge = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1]))
    owner = doc[order]
    several = np.minimum.reduceat(owner, edge) < np.maximum.reduceat(owner, edge)
    sizes = np.diff(np.append(edge, len(order)))
    lead = np.repeat(at[order[edge]], sizes)
    odd = np.zeros(len(order), bool)
    for i in range(window):
        odd |= codes[at[order] + i] != codes[lead + i]
    return np.concatenate([at[order[edge[several]]], at[order[odd & np.repeat(several, sizes)]]])


def automaton_match(doc: np.ndarray, windows: np.ndarray, body: np.ndarray, sizes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows that also stand in a phrase of a smaller document, located by an automaton."""
    import ahocorasick

    numbers: dict[bytes, int] = {}
    words = [numbers.setdefault(x, len(numbers)) for x in body.tobytes().split(b" ")[:-1]]
    codes, counts = np.array(words, np.int64), windows + window - 1
    ends = np.cumsum(counts)
    at, phrase = ragged(ends - counts, windows), np.repeat(np.arange(len(doc)), windows)
    patterns = recurring(doc[phrase], codes, at, window).tolist()
    none = np.zeros(0, np.int64)
    if not patterns:
        return none, none
    machine = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for i, a in enumerate(patterns):
        machine.add_word(tuple(words[a : a + window]), i)
    machine.make_automaton()
    found, lasts, owners = [], [], []
    for p, (a, b) in enumerate(zip((ends - counts).tolist(), ends.tolist())):
        for last, i in machine.iter(tuple(words[a:b])):
            found.append(i), lasts.append(last), owners.append(p)
    found, lasts, owners = np.array(found, np.int64), np.array(lasts, np.int64), np.array(owners, np.int64)
    first = np.full(len(patterns), np.iinfo(np.int64).max)
    np.minimum.at(first, found, doc[owners])
    later = doc[owners] > first[found]
    return owners[later], lasts[later] - window + 1


def _digests(docs: pa.RecordBatch, spans: Spans) -> pa.RecordBatch:
    out = []
    for d, x in zip(docs.column("doc_id").to_pylist(), docs.column("text").to_pylist()):
        raw = (x or "").encode()
        words = raw.split()  # bytes split at exactly the six characters
        own, gone, n = spans.get((d, zlib.crc32(raw))) if spans else None, 0, len(words)
        if own is not None:
            a, b = covered(*own, WINDOW, n)
            gone = int((b - a).sum())
            words = [w for s, e in zip([0, *b.tolist()], [*a.tolist(), n]) for w in words[s:e]]
        out.append((d, n, gone, hashlib.sha256(b" ".join(words)).hexdigest()))
    cols = list(zip(*out)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 3 + [pa.string()])], names=["doc_id", "n_words", "n_removed", "kept_sha256"])


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolved(table(spark, sf_dir, "documents"), KIND, automaton_match, SHARD_BYTES, _digests, SCHEMA)
