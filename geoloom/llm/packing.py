"""Harmonic packing of documents into sequences of at most ``capacity`` tokens.

A document's ids are cut into full sequences; what remains is cut greedily into pieces of
capacity // i tokens, i the smallest with such a piece no longer than the rest, until less than
``SMALL`` tokens remain.  A piece of length l belongs to class i = capacity // l, and a bin of class i
takes exactly i pieces, so a bin of an exact class wastes less than i tokens and one of a small class
less than 1 / (i + 1) of it.  Each worker fills the bins of its own partition and nothing is shuffled.  The
pieces that are left in open bins at a partition's end are laid one after another (cut where a
sequence ends), and the last stretch is cut into powers of two, which need no padding.

Cases: a null text is an empty one (its end id alone); null and repeated doc_ids are kept as they are,
a row each, as ties have no order; a text of any length is encoded whole and cut; an empty table gives no
rows; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batches, frugal, table
from .tokens import default_tokenizer, encoder, slices

CAPACITY, END_ID, SMALL = 2048, 1, 128
COLUMNS = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def cut(length: int, capacity: int = CAPACITY, small: int = SMALL) -> list[int]:
    """Lengths of the pieces of a document of ``length`` tokens."""
    pieces = [capacity] * (length // capacity)
    rest = length % capacity
    while rest >= small:
        pieces.append(capacity // -(-capacity // rest))
        rest -= pieces[-1]
    return pieces + [rest] * (rest > 0)


class Packer:
    """Bins of one partition.  A piece is (doc_id, start, its ids, tokens of the document)."""

    def __init__(self, partition: int, capacity: int = CAPACITY):
        self.capacity, self.next, self.open = capacity, partition << 40, defaultdict(list)
        self.out: list[tuple] = []

    def close(self, pieces: list[tuple]) -> None:
        at = 0
        for doc, start, ids, tokens in pieces:
            self.out.append((doc, start, len(ids), zlib.crc32(ids), tokens, self.next, at))
            at += len(ids)
        self.next += 1

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        start = 0
        for n in cut(len(ids), self.capacity):
            count = self.capacity // n
            self.open[count].append((doc, start, ids[start : start + n], len(ids)))
            start += n
            if len(self.open[count]) == count:
                self.close(self.open.pop(count))

    def finish(self) -> None:
        """Lays what open bins hold in a row of sequences, the last ones as long as powers of two."""
        rest = [x for count in sorted(self.open) for x in self.open[count]]
        self.open.clear()
        total = sum(len(x[2]) for x in rest)
        sizes = [self.capacity] * (total // self.capacity) + [1 << b for b in range(self.capacity.bit_length(), -1, -1) if (total % self.capacity) >> b & 1]
        rest.reverse()
        for size in sizes:
            pieces = []
            while size:
                doc, start, ids, tokens = rest.pop()
                pieces.append((doc, start, ids[:size], tokens))
                if len(ids) > size:
                    rest.append((doc, start + size, ids[size:], tokens))
                size -= len(pieces[-1][2])
            self.close(pieces)


def packed(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """A row for each piece of docs (doc_id, text)."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own, packer = encoder(tokenizer), Packer(TaskContext.get().partitionId(), capacity)

        def flush() -> pa.RecordBatch:
            cols = list(zip(*packer.out)) or [()] * 7
            packer.out = []
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in cols], names=[x.split()[0] for x in COLUMNS.split(", ")])

        for batch in batches(rows, 8_000_000):
            texts, docs_ = batch.column("text").to_pylist(), batch.column("doc_id").to_pylist()
            for a, b in slices(texts):
                ids, counts = own.encode(texts[a:b])
                ends = np.cumsum(counts)
                flat = np.insert(ids, ends, end_id).astype("<u4")
                at = 0
                for doc, n in zip(docs_[a:b], (counts + 1).tolist()):
                    packer.add(doc, flat[at : at + n])
                    at += n
                yield flush()
        packer.finish()
        yield flush()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(frugal(run), COLUMNS)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"), default_tokenizer())
