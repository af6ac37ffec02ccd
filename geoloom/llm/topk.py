"""Exact top-k search by integer inner product: tiles of queries times shards of vectors.

Queries are dealt into blocks of about ``BLOCK_BYTES``, vectors into shards of about ``SHARD_BYTES``, and every block meets
every shard in a group of its own (a vector is sent once for each block, a query once for each shard), so a task
holds one block and one shard and nothing comes to the driver but two counts.  In a group the block is multiplied
tile by tile, the k best of each tile are kept by partial selection, and the shards' lists are merged in a tree:
first within groups of shards, then over groups.  Ties go to the smaller vec_id.

Products are exact: in float64 where no sum can reach 2**53, otherwise in 64-bit integers; where a sum could reach
2**63 the job fails with a message.

Cases: a vector that is null, or holds a null, NaN or infinite component, takes no part, nor does a row
without vec_id; rows that share the query's vec_id are the query's own; of several vectors under a query's
vec_id the least (component by component) is the query; a repeated vec_id is a candidate as often as it stands, and
may fill several ranks; vectors of another length than the query's are no candidates of it; an empty table gives no
rows; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd  # noqa: F401  (Arrow's group functions need it)
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import give_back, table

K, EVERY, SCALE = 10, 100, 1024
#: Bytes of the vectors of a block of queries and of a shard; queries and vectors of a tile.
BLOCK_BYTES, SHARD_BYTES, TILE, WIDE = 32 << 20, 16 << 20, 512, 8192
FOUND = "query_id long, vec_id long, score long, shard int"
EXACT, MOST = 2.0**53, 2.0**63


def usable(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and v, the components as floor(scale * x) in integers, of the rows that take part."""
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * F.lit(scale)).cast("long"))
    return vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & whole).select(F.col("vec_id").cast("long"), scaled.alias("v"))


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best scores, ties to smaller ids, by partial selection."""
    if len(scores) > k:
        least = scores[np.argpartition(scores, len(scores) - k)[len(scores) - k]]
        above, equal = np.flatnonzero(scores > least), np.flatnonzero(scores == least)
        need = k - len(above)
        if len(equal) > need:
            equal = equal[np.argpartition(ids[equal], need - 1)[:need]]
        places = np.concatenate([above, equal])
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((ids[places], -scores[places]))]


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """All inner products of rows of integers, exactly."""
    reach = [np.abs(x.astype(np.float64)).max(axis=0, initial=0) for x in (queries, vectors)]
    bound = float(reach[0] @ reach[1])  # no inner product is farther from 0
    if bound < EXACT:
        return (queries.astype(np.float64) @ vectors.astype(np.float64).T).astype(np.int64)
    if bound >= MOST:
        raise OverflowError("an inner product may take more than 64 bits")
    return queries @ vectors.T


def _rows(frame: pa.Table, name: str, vector: str) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Ids and matrix of the vectors of each length."""
    lists = frame.column(vector).combine_chunks()
    ids, sizes = np.asarray(frame.column(name).combine_chunks()), np.asarray(lists.value_lengths())
    values, ends = np.asarray(lists.flatten()), np.cumsum(sizes)
    out = {}
    for n in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == n)
        out[n] = ids[at], values[(ends[at] - n)[:, None] + np.arange(n)]
    return out


def _search(k: int):
    """The cogroup function: each query's k best vectors of a shard."""

    def run(key: tuple, block: pa.Table, shard: pa.Table) -> pa.Table:
        found: list[tuple[int, np.ndarray, np.ndarray]] = []
        vectors = _rows(shard, "id", "of") if block.num_rows and shard.num_rows else {}
        for n, (names, matrix) in (_rows(block, "vec_id", "v") if vectors else {}).items():
            ids, own = vectors.get(n, (np.zeros(0, np.int64), np.zeros((0, n), np.int64)))
            for a in range(0, len(names), TILE):
                top: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(names[a : a + TILE])
                for b in range(0, len(ids), WIDE):
                    scores, part = products(matrix[a : a + TILE], own[b : b + WIDE]), ids[b : b + WIDE]
                    for i, q in enumerate(names[a : a + TILE].tolist()):
                        other = np.flatnonzero(part != q)
                        at = other[best(scores[i][other], part[other], k)]
                        s, v = np.concatenate([top[i][0], scores[i][at]]), np.concatenate([top[i][1], part[at]])
                        at = np.lexsort((v, -s))[:k]
                        top[i] = s[at], v[at]
                found += [(q, s, v) for q, (s, v) in zip(names[a : a + TILE].tolist(), top)]
        many = [len(s) for _, s, _ in found]
        column = lambda i: np.concatenate([x[i] for x in found]) if found else np.zeros(0, np.int64)
        names = np.repeat(np.array([q for q, _, _ in found], np.int64), many)
        give_back()
        return pa.table([pa.array(names, pa.int64()), pa.array(column(2), pa.int64()), pa.array(column(1), pa.int64()), pa.array(np.full(sum(many), key[1].as_py(), np.int32))], names=["query_id", "vec_id", "score", "shard"])

    return run


def top_k(vectors: DataFrame, every: int = EVERY, k: int = K, block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """query_id, rank, vec_id, score of the k best vectors for each row whose vec_id every divides."""
    rows = usable(vectors)
    count = rows.agg(F.sum(F.size("v").cast("long") * 8), F.sum(F.when(F.col("vec_id") % every == 0, F.size("v").cast("long") * 8))).first()
    shards, blocks = max(-(-(count[0] or 0) // shard_bytes), vectors.sparkSession.sparkContext.defaultParallelism), max(-(-(count[1] or 0) // block_bytes), 1)
    # places by row number, which a repeated vec_id does not crowd
    dealt = rows.select(F.col("vec_id").alias("id"), F.col("v").alias("of"), F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("int").alias("shard")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    found = asked.groupBy("block", "shard").cogroup(dealt.groupBy("block", "shard")).applyInArrow(_search(k), FOUND)
    order = [F.col("score").desc(), F.col("vec_id")]
    tree = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", F.col("shard") % 16).orderBy(*order))).where(F.col("rank") <= k)
    return (
        tree.select("query_id", "vec_id", "score")
        .withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order)))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


OP3_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), q AS (
  SELECT vec_id, min(e) AS e FROM v WHERE vec_id % 100 = 0 GROUP BY vec_id
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(coalesce(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
  FROM q JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e)
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rk FROM s
)
SELECT query_id, CAST(rk AS INT) AS rank, vec_id, score FROM r WHERE rk <= 10
"""
