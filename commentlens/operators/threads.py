"""Who takes part in the threads of an author."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def root_id() -> Column:
    """Thread of a comment: its own id when it has no ancestor."""
    return F.when(F.col("ancestorId") == -1, F.col("id")).otherwise(F.col("ancestorId"))


def thread_rows(comments: DataFrame) -> DataFrame:
    return comments.select(root_id().alias("root_id"), "authorId")


def interactions_with(threads: DataFrame, author_id, distinct: bool = False) -> DataFrame:
    """Interactions of every other author with one author.

    Equals the self join of the threads: each comment of another author counts
    once per comment of the selected author in the same thread (once at all
    with ``distinct``). The selected author's comments are first counted per
    thread, so the join has one row per thread on that side and the result is
    summed map-side.
    """
    own = threads.where(F.col("authorId") == author_id).groupBy("root_id").agg(F.count(F.lit(1)).alias("_own"))
    others = threads.where(F.col("authorId") != author_id)
    weight = F.lit(1) if distinct else F.col("_own")
    return (
        others.join(own, "root_id")
        .groupBy("authorId")
        .agg(F.sum(weight).cast("long").alias("total_interactions"))
    )
