"""Token-ID output: ORC files of integer ids, and reading them back.

Files hold ``part`` (the file's place in the order of doc_id), ``pos`` (place in the file), ``doc_id``,
``n_tokens`` and ``ids`` (array<int>; ORC packs integers with run-length encoding).  Each file has row
indexes and a Bloom filter on doc_id; stripes are read in parallel, and a filter on doc_id skips
files, stripes and row groups by their statistics and Bloom filters (``lookup``).

Cases: a null text is an empty one, which still gets its end id; a null doc_id sorts first; rows that
repeat a doc_id are each written, in an order that the file fixes; an empty table gives no rows;
further columns are ignored.  A text of any length is encoded whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import batches, fresh_path, frugal, shuffle_partitions, table
from .tokens import default_tokenizer, encoder, slices

END_ID = 0
#: Bytes of a stripe and rows of a row group.
STRIPE_BYTES, ROW_GROUP = 16 << 20, 1000
SCHEMA = "doc_id long, pos long, n_tokens long, ids array<int>"


def encoded(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """doc_id, pos (place in its partition), n_tokens and ids of each row, the end id appended."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, pos = encoder(tokenizer), 0
        for batch in batches(rows, 8_000_000):
            texts = batch.column("text").to_pylist()
            for a, b in slices(texts):
                ids, counts = own.encode(texts[a:b])
                ends = np.cumsum(counts)
                flat = np.insert(ids, ends, end_id).astype(np.int32)
                offsets = np.concatenate([[0], np.cumsum(counts + 1)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array(np.arange(pos, pos + b - a)), pa.array(counts + 1), pa.ListArray.from_arrays(offsets, flat)],
                    names=["doc_id", "pos", "n_tokens", "ids"],
                )
                pos += b - a

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(frugal(run), SCHEMA)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Writes the ids of docs (doc_id, text) to ORC files in ascending doc_id order."""
    n = shuffle_partitions(docs.sparkSession)
    ordered = docs.select("doc_id", "text").repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id")
    (
        encoded(ordered, tokenizer, end_id)
        .select(F.spark_partition_id().alias("part"), "pos", "doc_id", "n_tokens", "ids")
        .write.option("orc.compress", "ZSTD")
        .option("orc.stripe.size", STRIPE_BYTES)
        .option("orc.row.index.stride", ROW_GROUP)
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", 0.01)
        .orc(path)
    )


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """The stored rows of some documents; the filter reaches the ORC reader."""
    return spark.read.orc(path).where(F.col("doc_id").isin(doc_ids))


def digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each stored row, from the files alone."""
    stored = spark.read.schema("part int, pos long, doc_id long, n_tokens long, ids array<int>").orc(path)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            ids = batch.column("ids")
            flat, at = np.asarray(ids.values).astype("<u4", copy=False), np.asarray(ids.offsets)
            crc = [zlib.crc32(flat[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            sizes = np.diff(at).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("part"), batch.column("pos"), batch.column("doc_id"), pa.array(sizes), pa.array(crc, pa.int64())], names=["part", "pos", "doc_id", "n_tokens", "ids_crc32"])

    rows = stored.select("part", "pos", "doc_id", "ids").mapInArrow(frugal(run), "part int, pos long, doc_id long, n_tokens long, ids_crc32 long")
    sizes = stored.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # a row for each file
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    within = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("pos")) - F.col("n_tokens")
    return rows.withColumn("within", within).join(before, "part").select("doc_id", (F.col("before") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, default_tokenizer())
    return digests(spark, path)
