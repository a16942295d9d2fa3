"""Delimited files: reading, writing, folders of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commentlens.functions.links import collection_id
from commentlens.operators.dedupe import first_per_key
from commentlens.operators.joins import null_safe
from commentlens.operators.reshape import union_all
from commentlens.sources.landing import INGEST, landed


def read_indexed_csv(spark: SparkSession, path: str, schema: str, columns: list[str] | None = None, index: str = "_index") -> DataFrame:
    """Comma files with a leading index column, which is dropped."""
    df = spark.read.schema(f"{index} STRING, {schema}").option("header", True).csv(path).drop(index)
    return df if columns is None else df.select(*columns)


def read_semicolon(spark: SparkSession, path: str, schema: str, multi_line: bool = True, batch: int | None = None) -> DataFrame:
    """``;`` files in UTF-8 whose quoted fields may hold quotes and line ends.

    A multi-line file is read by one task, so land many moderate files; without
    embedded line ends pass ``multi_line=False`` and files split freely. With a
    ``batch`` number the rows carry the place at which they landed (``ingest``).
    """
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", ";")
        .option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .csv(path)
    )
    return rows if batch is None else landed(rows, batch)


def write_semicolon(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    writer = df.write.mode(mode).option("header", True).option("sep", ";").option("quote", '"')
    writer.option("escape", '"').option("quoteAll", True).option("emptyValue", "").csv(path)


def read_link_lists(spark: SparkSession, folder: str) -> DataFrame:
    """Headerless link files; the file stem becomes the topic.

    One row per link (the first topic in name order), links holding ``http``
    left out, with the encoded collection id.
    """
    stem = F.regexp_extract(F.col("_metadata.file_name"), r"^([^.]*)", 1)
    links = spark.read.schema("ft_hash STRING").csv(folder).select("ft_hash", stem.alias("topic"))
    return clean_links(links)


def clean_links(links: DataFrame) -> DataFrame:
    """Dedupe links, drop full addresses, add the collection id."""
    once = first_per_key(links.where(F.col("ft_hash").isNotNull()), ["ft_hash"], ["topic"])
    kept = once.where(~null_safe(F.col("ft_hash").contains("http")))
    return kept.withColumn("collection_id", collection_id("ft_hash"))


def read_named(
    spark: SparkSession, folder: str, schema: str, name_part: str, index: str = "_index", batch: int | None = None
) -> DataFrame:
    """All files of a folder whose name contains ``name_part``, with their landing order if ``batch`` is given."""
    reader = spark.read.schema(f"{index} STRING, {schema}").option("header", True).option("pathGlobFilter", f"*{name_part}*")
    rows = reader.option("multiLine", True).option("escape", '"').csv(folder)
    return (rows if batch is None else landed(rows, batch)).drop(index)


def merge_authors(frames: list[DataFrame], key: str = "id", name: str = "displayName") -> DataFrame:
    """Union author tables, one row per id: the first landed where all carry their places, else the smallest name."""
    if all(INGEST in f.columns for f in frames):
        rows = union_all([f.select(key, name, INGEST) for f in frames])
        return first_per_key(rows, [key], [INGEST, name]).drop(INGEST)
    return first_per_key(union_all(frames).select(key, name), [key], [name])


def write_per_topic(df: DataFrame, path: str, topic: str = "topic") -> None:
    """One folder per topic, all topics in one pass."""
    df.write.mode("overwrite").partitionBy(topic).parquet(path)
