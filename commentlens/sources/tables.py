"""The warehouse: named tables, parameterised SQL, profiles, yearly results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException


# Errors of a folder that isn't there or holds no files yet; any other is a fault.
_ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


class MissingTable(LookupError):
    """The table asked for does not exist."""


def read_table(spark: SparkSession, name: str, root: str | None = None) -> DataFrame:
    """A catalog table, or the Parquet folder ``root/name``."""
    if root is None:
        if not spark.catalog.tableExists(name):
            raise MissingTable(f"no table named {name}")
        return spark.table(name)
    try:
        return spark.read.parquet(f"{root}/{name}")
    except AnalysisException as error:
        if error.getCondition() not in _ABSENT:
            raise
        raise MissingTable(f"no table named {name} below {root}") from error


def run_sql(spark: SparkSession, query: str, args: dict | None = None, **frames: DataFrame) -> DataFrame:
    """SQL with bound parameters (``:name``) and frames (``{name}``); nothing is pasted into the text."""
    return spark.sql(query, args=args, **frames)


def save_table(df: DataFrame, name: str, root: str | None = None, partition_by: list[str] | None = None) -> None:
    """Create or replace a table."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if root is None:
        writer.saveAsTable(name)
    else:
        writer.parquet(f"{root}/{name}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:t)", args={"t": name})


def save_years(df: DataFrame, path: str) -> None:
    """Write yearly results; a repeated year replaces itself and leaves the others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(path)


def profile(df: DataFrame) -> DataFrame:
    """Row count and non-null count of every column, in one pass: ``(column, type, non_null, total)``."""
    kinds = dict(df.dtypes)
    counted = df.agg(F.count(F.lit(1)).alias("_total"), *[F.count(F.col(c)).alias(c) for c in df.columns])
    cells = [
        F.struct(F.lit(c).alias("column"), F.lit(kinds[c]).alias("type"), F.col(c).alias("non_null"), F.col("_total").alias("total"))
        for c in df.columns
    ]
    return counted.select(F.inline(F.array(*cells)))
