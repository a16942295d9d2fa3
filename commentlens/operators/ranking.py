"""Top-n with ties, globally and per group, and frequency order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def top_n(df: DataFrame, value: str, n: int) -> DataFrame:
    """Rows whose ``value`` is among the ``n`` largest, ties at the cut included.

    The n-th largest value comes from a distributed top-k; a scalar subquery
    then filters. No window gathers the rows in one task, and any number of
    ties stays distributed.
    """
    cut = df.select(value).where(F.col(value).isNotNull()).orderBy(F.desc(value)).limit(n).agg(F.min(value).alias("cut"))
    return df.where(F.col(value) >= cut.scalar())


def top_n_per_group(df: DataFrame, group: str | list[str], value: str, n: int) -> DataFrame:
    """Rows ranked within the ``n`` largest of their group, ties included.

    The rank filter is pushed below the shuffle as a per-task group limit, so a
    large group arrives already cut.
    """
    keys = [group] if isinstance(group, str) else group
    rank = F.rank().over(W.partitionBy(*keys).orderBy(F.desc(value)))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def first_rows(df: DataFrame, order: list[Column | str], n: int) -> DataFrame:
    """First ``n`` rows of a full order (a distributed top-k)."""
    return df.orderBy(*order).limit(n)


def frequency_table(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """Distinct values with their row counts, most frequent first."""
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(name))
    return counted.orderBy(F.desc(name), F.asc(column))
