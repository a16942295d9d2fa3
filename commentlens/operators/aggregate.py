"""Counts, totals, shares, ordered concatenation, column totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commentlens.functions.clock import wall_clock
from commentlens.operators.numbering import number_within
from commentlens.session import once


def count_by(df: DataFrame, keys: list[str], name: str = "n", of: str | None = None) -> DataFrame:
    """Row count per group; ``of`` counts the non-null values of one column instead."""
    counted = F.count(F.col(of)) if of else F.count(F.lit(1))
    return df.groupBy(*keys).agg(counted.alias(name))


def having(df: DataFrame, value: str, more_than: float) -> DataFrame:
    """Groups strictly above a threshold."""
    return df.where(F.col(value) > more_than)


def total_by(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(value).alias(name))


def share_of_group(df: DataFrame, group: str, value: str, name: str = "share") -> DataFrame:
    """Value divided by its group's total.

    The totals are a small aggregate joined back, so a large group is never
    gathered in one window partition. The input is stored once.
    """
    df = once(df, "shares")
    totals = df.groupBy(group).agg(F.sum(value).alias("_total"))
    return df.join(totals, group).withColumn(name, F.col(value) / F.col("_total")).drop("_total")


def concat_parts(
    df: DataFrame, group: str, text: str, order: list[str], rows_per_part: int = 1000, sep: str = ""
) -> DataFrame:
    """Concatenate each group's texts in order, in parts of a fixed row count (runs a job).

    Reading the parts of a group in order of ``part`` and joining them with
    ``sep`` gives the whole text. A part is at most ``rows_per_part`` rows, so a
    huge group becomes many bounded cells and never one unbounded cell; the
    parts of a group are gathered by group and part, so by many tasks.
    """
    held = df.where(F.col(text).isNotNull()).select(group, text, *[c for c in order if c not in (group, text)])
    placed = number_within(held, group, order, "_position")
    part = F.floor((F.col("_position") - 1) / F.lit(rows_per_part)).cast("long")
    pieces = F.array_sort(F.collect_list(F.struct("_position", F.col(text).alias("_text"))))
    joined = F.array_join(F.transform(pieces, lambda p: p["_text"]), sep)
    return placed.groupBy(F.col(group), part.alias("part")).agg(joined.alias("text"))


def with_row_total(df: DataFrame, columns: list[str], name: str = "total") -> DataFrame:
    """Sum of some columns in each row, null as zero."""
    total = sum((F.coalesce(F.col(c), F.lit(0)) for c in columns[1:]), F.coalesce(F.col(columns[0]), F.lit(0)))
    return df.withColumn(name, total)


def nonzero_columns(df: DataFrame, columns: list[str]) -> list[str]:
    """Names of the columns that hold any value other than zero (runs one aggregate job)."""
    row = df.agg(*[F.bool_or(F.coalesce(F.col(c) != 0, F.lit(False))).alias(c) for c in columns]).first()
    return [c for c in columns if row[c]]


def drop_zero_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop the listed columns that are zero in every row (runs one aggregate job)."""
    keep = set(nonzero_columns(df, columns))
    return df.select(*[c for c in df.columns if c not in columns or c in keep])


def activity_profile(comments: DataFrame, zone: str = "UTC", offset_hours: int = 3) -> DataFrame:
    """Comments per author by hour of day and by weekday (Monday=0), one scan and one shuffle."""
    local = wall_clock("createdAt", zone, offset_hours)
    timed = comments.select("authorId", F.hour(local).alias("hour"), F.weekday(local).alias("dow"))
    cells = timed.groupingSets([["authorId", "hour"], ["authorId", "dow"]], "authorId", "hour", "dow").agg(
        F.count(F.lit(1)).alias("n"), F.grouping("hour").alias("_by_dow")
    )
    by_dow = F.col("_by_dow") == 1
    return cells.select(
        "authorId",
        F.when(by_dow, F.lit("dow")).otherwise(F.lit("hour")).alias("kind"),
        F.when(by_dow, F.col("dow")).otherwise(F.col("hour")).alias("bucket"),
        "n",
    )
