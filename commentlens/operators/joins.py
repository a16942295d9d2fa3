"""Equi-joins of facts with dimensions.

No broadcast hints on tables that grow: Spark and AQE broadcast a side when
its size allows and split skewed partitions otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def on_keys(left: DataFrame, right: DataFrame, pairs: dict[str, str], how: str = "inner") -> DataFrame:
    """Join on differently named keys; the right keys are dropped afterwards."""
    renamed = right
    for i, (_, r) in enumerate(pairs.items()):
        renamed = renamed.withColumnRenamed(r, f"_key{i}")
    cond = reduce(lambda a, b: a & b, [left[l] == renamed[f"_key{i}"] for i, l in enumerate(pairs)])
    return left.join(renamed, cond, how).drop(*[f"_key{i}" for i in range(len(pairs))])


def with_names(
    facts: DataFrame, authors: DataFrame, key: str = "authorId", name: str = "displayName", how: str = "inner"
) -> DataFrame:
    """Attach the display name of an author column under ``name``."""
    names = authors.select(F.col("author_id").alias("_author"), F.col("displayName").alias(name))
    return facts.join(names, F.col(key) == F.col("_author"), how).drop("_author")


def with_both_names(
    pairs: DataFrame, authors: DataFrame, author: str = "author_id", liker: str = "liker_id"
) -> DataFrame:
    """Attach author and liker names from the same dimension, with distinct columns."""
    named = with_names(pairs, authors, author, "author_name")
    return with_names(named, authors, liker, "liker_name")


def members(df: DataFrame, key: str, wanted: DataFrame, wanted_key: str | None = None) -> DataFrame:
    """Rows whose key occurs in ``wanted`` (left semi)."""
    keys = wanted.select(F.col(wanted_key or key).alias("_wanted"))
    return df.join(keys, F.col(key) == F.col("_wanted"), "left_semi")


def non_members(df: DataFrame, keys: list[str], known: DataFrame) -> DataFrame:
    """Rows whose key does not occur in ``known`` (left anti)."""
    return df.join(known.select(*keys), keys, "left_anti")


def name_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` that are not in ``right``."""
    return left.subtract(right)


def split_hot_join(
    facts: DataFrame, dimension: DataFrame, key: str, how: str = "inner", share: int = 200
) -> DataFrame:
    """Join facts to a dimension that has one row per key, hot keys apart (runs a job).

    Keys that hold more than 1/``share`` of the rows are at most ``share`` many,
    so their dimension rows are broadcast whatever the data size; every other
    key takes the ordinary shuffle join. Exact for inner and left joins.
    """
    if how not in ("inner", "left"):
        raise ValueError("split_hot_join supports inner and left joins")
    counts = facts.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = facts.where(F.col(key).isNotNull()).agg(F.count(F.lit(1)).alias("_t"))
    hot = [r[0] for r in counts.where(F.col("_n") * share > total.scalar()).select(key).limit(share).collect()]
    if not hot:
        return facts.join(dimension, key, how)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    spread = facts.where(is_hot).join(F.broadcast(dimension.where(F.col(key).isin(hot))), key, how)
    usual = facts.where(~is_hot).join(dimension, key, how)
    return usual.unionByName(spread)


def orphans(comments: DataFrame, titles: DataFrame, key: str = "ft_id", title: str = "title") -> DataFrame:
    """Comments without a (non-null) title."""
    known = titles.where(F.col(title).isNotNull())
    return non_members(comments, [key], known)


def replace_titles(comments: DataFrame, titles: DataFrame) -> DataFrame:
    """Replace the comments' titles by those of a title table with one row per id."""
    return comments.drop("title").join(titles.select("ft_id", "title"), "ft_id", "left")


def null_safe(value: Column) -> Column:
    """A predicate where null counts as false."""
    return F.coalesce(value, F.lit(False))
