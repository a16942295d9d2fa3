"""Landed JSON documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_documents(spark: SparkSession, path: str, schema: str, one_per_file: bool = False) -> DataFrame:
    """JSON documents with a fixed schema; one per line, or one per file."""
    return spark.read.schema(schema).option("multiLine", one_per_file).json(path)


def read_trees(spark: SparkSession, path: str, fields: str = "FT_ID STRING, title STRING") -> DataFrame:
    """Lines of JSON with a nested ``comments`` field, which is kept as a variant."""
    raw = spark.read.schema(f"{fields}, comments VARIANT").json(path)
    return raw.withColumnRenamed("FT_ID", "ft_id")


def parse_trees(df: DataFrame, text: str) -> DataFrame:
    """Replace a JSON text column by the variant ``comments``; unreadable text becomes null."""
    return df.withColumn("comments", F.try_parse_json(text)).drop(text)
