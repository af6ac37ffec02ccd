"""Language identification by cross-parsing.

For each language a suffix automaton is built over a bounded sample of labelled text.  A text is
parsed, greedily, into the longest strings that the automaton knows (a symbol that it doesn't know is a phrase of
its own); a language's cross-entropy estimate is phrases * log2(length of its sample) / symbols, and the
language with the least wins.  numpy steps through many stretches of ``STRETCH`` symbols at once, each from the
beginning of a phrase; a stretch whose predecessor ends within a phrase is stepped through again
from there until both parses are at one state, so the phrases are those of one parse of the whole text.
An automaton has a table for the commonest ``DENSE`` letters of its sample and hashed edges for the others, so memory
grows with the samples, not with the letters of all languages.

Symbols are lower-case letters; everything between letters is one blank.

Learning: ``SAMPLE_DOCS`` documents of each language by the hash of doc_id, of ``SAMPLE_CHARS`` characters if
there are such, then others.  All give an equal share of ``LANGUAGE_CHARS`` characters from their start; where
that is under half of it, up to ``SHORT_DOCS`` shorter texts are joined, so that each labelled language with a
letter is learned.  Lengths are those of text.  These bounds do not depend on the corpus.

Cases: null texts and texts without a letter give ``und`` with score 0; ties go to the language whose name is
first; a null doc_id is neither learned from nor held out; repeated rows are each predicted, and learned
once (of texts with one doc_id and lang, the shortest that fits); texts of any length
are parsed whole; with no labelled text all texts are ``und``; an empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import batches, frugal, kept, table

SAMPLE_DOCS, SAMPLE_CHARS, LANGUAGE_CHARS = 64, (200, 8000), 24_000
SHORT_DOCS = 1000
STRETCH = 256
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"
#: The state between phrases, and the automaton's root.
BETWEEN, ROOT = 0, 1
#: Columns of a transition table, two of them for other letters and for no symbol; a mark of states that begin a phrase.
DENSE, OTHER, PAD = 32, 0, 1
BEGINS = np.int32(1 << 30)


def fold(doc_id: Column, folds: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def suffix_automaton(symbols: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """State, symbol and next state of each edge of the automaton of all substrings; states from ROOT."""
    links, lengths, edges = [-1], [0], [{}]
    last = 0
    for s in symbols:
        now = len(links)
        links.append(0), lengths.append(lengths[last] + 1), edges.append({})
        p = last
        while p >= 0 and s not in edges[p]:
            edges[p][s] = now
            p = links[p]
        if p >= 0:
            q = edges[p][s]
            if lengths[q] == lengths[p] + 1:
                links[now] = q
            else:
                clone = len(links)
                links.append(links[q]), lengths.append(lengths[p] + 1), edges.append(dict(edges[q]))
                while p >= 0 and edges[p].get(s) == q:
                    edges[p][s] = clone
                    p = links[p]
                links[q] = links[now] = clone
        last = now
    sizes = [len(x) for x in edges]
    state = np.repeat(np.arange(len(edges)), sizes)
    symbol = np.fromiter((s for x in edges for s in x), np.int64, sum(sizes))
    to = np.fromiter((t for x in edges for t in x.values()), np.int64, sum(sizes))
    return state + ROOT, symbol, to + ROOT


class Edges:
    """Next states by state and symbol: a table for common symbols, linear probing for the rest."""

    def __init__(self, state: np.ndarray, symbol: np.ndarray, to: np.ndarray, alphabet: int):
        self.alphabet = alphabet
        self.first = np.full(alphabet, BETWEEN, np.int32)  # the state that a phrase begins with
        own = state == ROOT
        self.first[symbol[own]] = to[own]
        common = np.argsort(-np.bincount(symbol, minlength=alphabet), kind="stable")[: DENSE - 2]
        self.column = np.full(alphabet, OTHER, np.int32)
        self.column[common] = np.arange(2, 2 + len(common))
        self.column[0] = PAD
        states = int(max(state.max(initial=ROOT), to.max(initial=ROOT))) + 1
        table = np.zeros((states, DENSE), np.int32)
        table[:, 2 : 2 + len(common)] = self.first[common] | BEGINS
        table[:, PAD] = np.arange(states)
        dense = self.column[symbol] > PAD
        table[state[dense], self.column[symbol[dense]]] = to[dense]
        self.table = table.ravel()
        state, symbol, to = state[~dense], symbol[~dense], to[~dense]
        bits = int(2 * len(to) + 1).bit_length()
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.to = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)
        key = state * alphabet + symbol
        at, left = self._home(key), np.arange(len(key))
        while len(left):
            free = self.keys[at[left]] < 0
            at[left[~free]] = (at[left[~free]] + 1) & self.mask
            want = left[free]
            places, won = np.unique(at[want], return_index=True)
            self.keys[places], self.to[places] = key[want[won]], to[want[won]]
            left = np.concatenate([left[~free], np.delete(want, won)])

    def _home(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def _rare(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Next states, marked where a phrase begins, by the hashed edges."""
        key = state.astype(np.int64) * self.alphabet + symbol
        at = self._home(key)
        out, open_ = self.first[symbol] | BEGINS, np.arange(len(key))
        while len(open_):
            got = self.keys[at[open_]]
            found = open_[got == key[open_]]
            out[found] = self.to[at[found]]
            open_ = open_[(got != key[open_]) & (got >= 0)]
            at[open_] = (at[open_] + 1) & self.mask
        return out

    def step(self, state: np.ndarray, symbol: np.ndarray, column: np.ndarray, rare: bool) -> np.ndarray:
        """Next states, marked where a phrase begins; symbol 0 changes nothing."""
        out = self.table[state * np.int32(DENSE) + column]
        if rare:
            at = np.flatnonzero(column == OTHER)
            out[at] = self._rare(state[at], symbol[at])
        return out

    def phrases(self, symbols: np.ndarray, leads: np.ndarray) -> np.ndarray:
        """Phrases that begin in each stretch; symbols[i] has symbol i of every stretch, leads says where texts begin."""
        columns = self.column[symbols]
        rare = (columns == OTHER).any(axis=1)
        got = np.empty(symbols.shape, np.int32)
        state = np.full(len(leads), BETWEEN, np.int32)
        for i, (symbol, column) in enumerate(zip(symbols, columns)):
            got[i] = self.step(state, symbol, column, rare[i])
            state = got[i] & ~BEGINS
        ends, began = state, np.full(len(leads), BETWEEN, np.int32)
        while True:
            rows = np.flatnonzero(~leads & (np.append(BETWEEN, ends[:-1]) != began))
            if not len(rows):
                return (got >> 30).sum(axis=0)
            now = ends[rows - 1]
            began[rows] = now
            for i in range(len(symbols)):
                new = self.step(now, symbols[i, rows], columns[i, rows], rare[i])
                now = new & ~BEGINS
                other = now != got[i, rows] & ~BEGINS
                got[i, rows] = new
                rows, now = rows[other], now[other]
                if not len(rows):
                    break
            ends[rows] = now


class CrossParser:
    """Automata of all languages.  Symbol 0 pads, 1 is a blank, 2 a letter that no sample has."""

    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(samples)
        letters = sorted({c for x in samples.values() for c in x.lower() if c.isalpha()})
        number = {c: i + 3 for i, c in enumerate(letters)}
        self.table = np.array([number.get(chr(c).lower()[0], 2) if chr(c).isalpha() else 1 for c in range(0x110000)], np.int32)
        self.edges, self.bits = [], []
        for name in self.languages:
            text = self.symbols(samples[name])
            self.edges.append(Edges(*suffix_automaton(text.tolist()), len(letters) + 3))
            self.bits.append(math.log2(max(len(text), 2)))

    def symbols(self, text: str) -> np.ndarray:
        out = self.table[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
        blank = out == 1
        return out[~(blank & np.append(True, blank[:-1]))]

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """The language and the score of each text, its bits a symbol in that language, and its symbols."""
        own = [self.symbols(x) if x else np.zeros(0, np.int32) for x in texts]
        sizes = np.array([len(x) for x in own], np.int64)
        some = np.array([bool((x > 1).any()) for x in own], bool)
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts)), sizes
        parts = -(-sizes // STRETCH)
        grid = np.zeros((int(parts.sum()), STRETCH), np.int32)
        starts = np.cumsum(parts) - parts
        flat = grid.ravel()
        for x, a in zip(own, (starts * STRETCH).tolist()):
            flat[a : a + len(x)] = x
        columns = np.ascontiguousarray(grid.T)
        leads = np.zeros(len(grid), bool)
        leads[starts[parts > 0]] = True
        text = np.repeat(np.arange(len(texts)), parts)
        bits = np.full((len(texts), len(self.languages)), np.inf)
        for k, edges in enumerate(self.edges):
            total = np.bincount(text, edges.phrases(columns, leads), len(texts))
            bits[:, k] = total * self.bits[k] / np.maximum(sizes, 1)
        least = bits.argmin(axis=1)
        best = bits[np.arange(len(texts)), least]
        second = np.partition(bits, 1, axis=1)[:, 1] if len(self.languages) > 1 else np.full(len(texts), np.inf)
        score = np.where(some, 1 - best / np.maximum(best + second, 1e-12), 0.0)
        return [self.languages[i] if s else UNKNOWN for i, s in zip(least.tolist(), some.tolist())], score, np.where(some, best, 0.0), sizes


def chosen_texts(docs: DataFrame, trained: Column) -> DataFrame:
    """own (the language), rank and text of the documents that are learned from: SHORT_DOCS a language at most.

    The hashes of doc_id are counted in classes that each hold a sixth of what is left (without repeats), so all classes up to
    the one in which a language's sample ends hold little more than the sample: only those rows are shuffled and
    ranked, however many rows and tasks there are.
    """
    text, h = F.col("text").cast("string"), F.xxhash64("doc_id")
    size = F.length(text)
    later = F.when(size.between(*SAMPLE_CHARS), 0).otherwise(1)
    part = (h.cast("double") + F.lit(2.0**63) + 1) / F.lit(2.0**64)
    place = (later * 512 + 256 - F.floor(-4 * F.log2(part))).cast("int")
    named = docs.select("doc_id", "lang", "text").where(trained & F.col("lang").isNotNull() & (F.col("lang") != UNKNOWN) & text.rlike("\\p{L}"))
    rows = named.select("doc_id", "lang", text.alias("text"), size.alias("n"), later.alias("later"), h.alias("h"), place.alias("place"))
    counts = rows.groupBy("lang", "place").agg(F.approx_count_distinct("h").alias("many"))
    before = F.coalesce(F.sum("many").over(Window.partitionBy("lang").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    last = counts.withColumn("before", before).where(F.col("before") < 2 * SHORT_DOCS).groupBy(F.col("lang").alias("own")).agg(F.max("place").alias("last"))
    near = rows.join(F.broadcast(last), F.col("lang") == F.col("own")).where("place <= last")  # a row a language is broadcast
    near = near.select("own", "h", "doc_id", F.struct("later", "n", F.substring("text", 1, SAMPLE_CHARS[1]).alias("text")).alias("one"))
    near = near.groupBy("own", "h", "doc_id").agg(F.min("one").alias("one"))
    rank = F.row_number().over(Window.partitionBy("own").orderBy("one.later", "h", "doc_id"))
    few = near.withColumn("rank", rank).where(F.col("rank") <= SHORT_DOCS)
    return few.where((F.col("rank") <= SAMPLE_DOCS) | (F.col("one.n") < SAMPLE_CHARS[0])).select("own", "rank", "one.text")


def learned_samples(docs: DataFrame, trained: Column) -> dict[str, str]:
    """A bounded sample of labelled text of each language: its letters are learned."""
    texts = chosen_texts(docs, trained)
    out: dict[str, str] = {}
    found = [r for r in sorted(texts.collect(), key=lambda r: (r[0], r[1], r[2] or "")) if r[2]]
    whole = Counter(own for own, _, text in found if len(text) >= SAMPLE_CHARS[0])
    for least in (SAMPLE_CHARS[0], 1):
        for own, _, text in found:
            if least <= len(text) and (least > 1 or len(text) < SAMPLE_CHARS[0] and len(out.get(own, "")) < LANGUAGE_CHARS // 2):
                out[own] = out.get(own, "") + " " + (text[: LANGUAGE_CHARS // whole[own]] if least > 1 else text)
    return out


def identified(docs: DataFrame, trained: Column) -> DataFrame:
    """docs with lang_pred, score, bits (a symbol) and symbols; learns from the rows of docs where ``trained`` holds."""
    samples = learned_samples(docs, trained)
    columns = [c for c in docs.columns if c not in ("lang_pred", "score", "bits", "symbols")]
    rows = docs.select(*[F.col(f"`{c}`") for c in columns])
    key = hash(tuple(sorted(samples.items())))

    def run(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = kept(key, lambda: CrossParser(samples))
        for batch in batches(batches_, 2_000_000):
            names, score, bits, symbols = model.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(score), pa.array(bits), pa.array(symbols)], names=[*columns, "lang_pred", "score", "bits", "symbols"])

    return rows.mapInArrow(frugal(run), T.StructType([*rows.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("bits", T.DoubleType()), T.StructField("symbols", T.LongType())]))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = fold(F.col("doc_id"), FOLDS) == HELD_OUT
    found = identified(docs, F.coalesce(~out, F.lit(False)))
    return found.select("doc_id", F.coalesce(out, F.lit(False)).alias("held_out"), "lang_pred", "score")
