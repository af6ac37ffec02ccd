"""What the operators share: input tables, the shared folder, materialised tables, batches."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all machines share: ``spark.checkpoint.dir``.

    Where it is unset, a session on one machine (``local``, as in tests) gets a new one; on a cluster it must be set.
    """
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
        found = f"file://{tempfile.mkdtemp(prefix='llm-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


#: Folders made by this driver and not yet deleted, in their order.
_made: list[str] = []


def fresh_path(spark: SparkSession, name: str) -> str:
    _made.append(f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}")
    return _made[-1]


def materialized(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again: cuts lineage, survives lost executors."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    give_back()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> tuple[DataFrame, str]:
    """``materialized(make(), name)`` and its folder; the tables that ``make`` wrote on the way are deleted then."""
    before = len(_made)
    out = materialized(make(), name)
    dropped(spark, _made[before:-1])
    return out, _made[-1]


def dropped(spark: SparkSession, paths: list[str]) -> None:
    for path in list(paths):
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        _made.remove(path)


#: The one large object (an encoder, a model) that a Python worker keeps between tasks.
_kept: dict = {}


def kept(key, make: Callable[[], object]):
    """The object of a key; another key's object is let go, as workers outlive the stage they were used in."""
    if key not in _kept:
        _kept.clear()
        give_back()
        _kept[key] = make()
    return _kept[key]


def give_back() -> None:
    """Returns free memory of this process to the machine."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL(None).malloc_trim(0)


def frugal(run: Callable) -> Callable:
    """A function over Arrow batches whose worker returns its free memory after each task."""

    @functools.wraps(run)
    def wrapped(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(rows)
        give_back()

    return wrapped


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def batches(rows: Iterator[pa.RecordBatch], most: int = 24_000_000, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The rows again, each batch cut so that its texts have about ``most`` bytes (one row at least)."""
    for batch in rows:
        if batch.num_rows == 0:
            continue
        texts = batch.column(column)
        start, size = 0, 0
        for i, n in enumerate(pa.compute.binary_length(texts).fill_null(0).to_pylist()):
            if size and size + n > most:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        yield batch.slice(start)
