"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialized


def _with_least(links: DataFrame, least: DataFrame) -> DataFrame:
    """links (u, v) with m, the least of u.

    The key goes over in another form: the join then has an exchange of its own on both sides, so Spark can split a
    node with very many links among tasks, which it cannot where an aggregate by the key feeds the join.
    """
    return links.join(least.select(F.bitwise_not("u").alias("w"), "m"), F.col("u") == F.bitwise_not("w")).drop("w")


def _stars(links: DataFrame) -> DataFrame:
    """One large-star and one small-star step over links (u, v), u > v."""
    both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    large = _with_least(both, least).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    small = _with_least(large, least)
    return small.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """node, root (the least node of its component) for every node of links (a, b long) but the roots.

    Needs about as many rounds as the logarithm of the longest chain; each round is written to the
    shared folder.  A node with very many links is pre-aggregated, and its join can be split.
    """
    now = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now, last = materialized(now, "links"), None
    for _ in range(rounds):
        mark = now.agg(F.count("*"), F.sum(F.col("u").cast("decimal(38,0)")), F.sum(F.col("v").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == last:
            break
        last = mark
        now = materialized(_stars(now), "links")
    else:
        raise RuntimeError("links did not settle")
    return now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
