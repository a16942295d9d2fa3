"""Connected components of an edge list, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commentlens.session import once


def components(edges: DataFrame) -> DataFrame:
    """Smallest node of every node's component: rows ``node, root`` for nodes with edges (runs jobs).

    ``edges`` has ``a`` and ``b``. A large star ties every node's larger
    neighbours to its smallest one, a small star its smaller neighbours; the
    two alternate until nothing changes, after about as many rounds as the
    logarithm of the longest path. Each round's edges are written to the shared
    folder, so a lost executor costs one round. No more rows than edges arise.
    """
    now = once(_ordered(edges), "edges")
    state = _state(now)
    while True:
        after = once(_small_star(_large_star(now)), "edges")
        now, before, state = after, state, _state(after)
        if state == before:
            return now.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root")).union(
                now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
            ).groupBy("node").agg(F.min("root").alias("root"))


def _ordered(edges: DataFrame) -> DataFrame:
    pair = edges.where(F.col("a") != F.col("b"))
    return pair.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy(F.col("a").alias("u")).agg(F.least(F.min("b"), F.col("u")).alias("m"))
    larger = both.where(F.col("b") > F.col("a")).withColumnsRenamed({"a": "u", "b": "v"})
    return _ordered(larger.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    below = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    least = below.groupBy("u").agg(F.min("v").alias("m"))
    moved = below.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return _ordered(moved.union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))))
