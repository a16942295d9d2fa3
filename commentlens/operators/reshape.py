"""Long to wide, wide to long, transpose, unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commentlens.operators.numbering import number_rows


def pivot_sum(df: DataFrame, rows: str, columns: str, values: list, measure: str, fill: float | None = None) -> DataFrame:
    """One column per listed value, holding the sum of ``measure``.

    The value list is given, so no extra job looks for it.
    """
    wide = df.groupBy(rows).pivot(columns, values).agg(F.sum(measure))
    return wide if fill is None else wide.na.fill(fill)


def transpose_long(df: DataFrame, row: str, column: str, value: str) -> DataFrame:
    """Transpose of a long matrix: swap the two keys."""
    return df.select(F.col(column).alias(row), F.col(row).alias(column), value)


def unpivot(df: DataFrame, keys: list[str], columns: list[str], name: str, value: str) -> DataFrame:
    """Wide to long, rows without a value dropped."""
    return df.unpivot(keys, columns, name, value).where(F.col(value).isNotNull())


def stack_list(df: DataFrame, keys: list[str], items: str, name: str) -> DataFrame:
    """One row per list element; null elements and empty lists vanish."""
    return df.select(*keys, F.explode(items).alias(name)).where(F.col(name).isNotNull())


def repeat_by_length(df: DataFrame, key: str, items: str) -> DataFrame:
    """Repeat the key once for each list element."""
    return df.select(key, F.explode(items)).select(key)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union by name; columns missing on one side become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def side_by_side(
    left: DataFrame, right: DataFrame, left_order: list[str | Column], right_order: list[str | Column], suffix: str = "_2", position: str | None = None
) -> DataFrame:
    """The columns of two tables next to each other, row by row in their own orders (runs jobs).

    Each table is numbered through by its own range partitions, and the numbers
    are joined. Where one table is longer, the columns of the other are null.
    Columns of the second table whose names the first one has too get
    ``suffix``. ``position`` keeps the row number, from 0, under that name.
    """
    taken = set(left.columns)
    renamed = right.withColumnsRenamed({c: f"{c}{suffix}" for c in right.columns if c in taken})
    if len(set(left.columns) | set(renamed.columns)) < len(left.columns) + len(renamed.columns):
        raise ValueError(f"columns clash even with the suffix {suffix!r}")
    first = number_rows(left, left_order, "_at")
    second = number_rows(right, right_order, "_at").withColumnsRenamed({c: f"{c}{suffix}" for c in right.columns if c in taken})
    joined = first.join(second, "_at", "full_outer")
    kept = [*left.columns, *renamed.columns]
    return joined.select(*([(F.col("_at") - 1).alias(position)] if position else []), *kept)
