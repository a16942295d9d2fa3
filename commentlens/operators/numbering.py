"""Numbering rows and keys in a global order without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from commentlens.session import cut_lineage

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def _placed(df: DataFrame, order: list[str | Column]) -> DataFrame:
    """Rows range-partitioned and sorted, with their partition ``_part`` and place in it ``_place``, written once (runs a job)."""
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    stored = cut_lineage(
        df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id()),
        "numbered",
    )
    place = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return stored.withColumns({"_part": F.shiftright("_place", _ROW_BITS), "_place": place})


def _offsets(sizes: DataFrame) -> DataFrame:
    """Rows before each partition: ``_part, _before``. One row per range partition, so it is bounded by that setting."""
    before = F.sum("_size").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    return sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))


def number_rows(df: DataFrame, order: list[str | Column], name: str = "row_no") -> DataFrame:
    """Number the rows 1, 2, ... in ``order`` (runs a job).

    Rows are range-partitioned and sorted, so a row's number is its place in
    its partition plus the sizes of the partitions before. The sorted rows are
    written once, so sizes and places always come from the same layout. Only
    one size per partition is gathered.
    """
    placed = _placed(df, order)
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    numbered = placed.join(F.broadcast(_offsets(sizes)), "_part")
    return numbered.withColumn(name, F.col("_before") + F.col("_place") + 1).drop("_place", "_part", "_before")


def dense_codes(df: DataFrame, key: str, name: str = "code") -> DataFrame:
    """Integer code of each distinct key in key order: rows ``(key, code)`` (runs a job)."""
    return number_rows(df.select(key).where(F.col(key).isNotNull()).distinct(), [key], name)


def with_dense_code(df: DataFrame, key: str, name: str = "code") -> DataFrame:
    """Attach the dense code of ``key`` to every row (runs a job)."""
    return df.join(dense_codes(df, key, name), key)


def number_within(df: DataFrame, group: str, order: list[str], name: str = "position") -> DataFrame:
    """Number the rows of each group 1, 2, ... in ``order`` (runs a job); rows without a group are left out.

    A large group spreads over several range partitions and stays spread: its
    rows meet the group's first number by partition *and* group, never by group
    alone. What is gathered by group is one row per partition that holds it.
    """
    placed = _placed(df.where(F.col(group).isNotNull()), [group, *order])
    pieces = cut_lineage(
        placed.groupBy("_part", group).agg(F.count(F.lit(1)).alias("_size"), F.min("_place").alias("_first")), "pieces"
    )
    sizes = pieces.groupBy("_part").agg(F.sum("_size").alias("_size"))
    located = pieces.join(F.broadcast(_offsets(sizes)), "_part")
    starts = located.groupBy(group).agg(F.min(F.col("_before") + F.col("_first")).alias("_start"))
    known = located.join(starts, group).select("_part", group, (F.col("_before") - F.col("_start")).alias("_shift"))
    joined = placed.join(known, ["_part", group])
    return joined.withColumn(name, F.col("_place") + F.col("_shift") + 1).drop("_place", "_part", "_shift")
