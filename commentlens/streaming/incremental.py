"""Incremental loads of landed files with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from commentlens.plans import keyed
from commentlens.plans.loading import append_new, shaped
from commentlens.schemas import KEYS, TABLES
from commentlens.sources.landing import INGEST, numbered, with_source


def raw_stream(spark: SparkSession, folder: str, schema: str, files_per_batch: int = 1000, multi_line: bool = True) -> DataFrame:
    """New ``;`` files of a folder as a stream, with the file and block of each row."""
    rows = (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("sep", ";")
        .option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", '"')
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(folder)
    )
    return with_source(rows)


def load_stream(
    spark: SparkSession,
    folder: str,
    root: str,
    kind: str,
    checkpoint: str,
    schema: str | None = None,
    files_per_batch: int = 1000,
    multi_line: bool = True,
    index: dict | None = None,
) -> StreamingQuery:
    """Load what has landed since the last run into one table, then stop.

    One query and one checkpoint per table. Of rows with one key the first
    landed wins: by micro-batch, then file name and position. A batch that is
    replayed after a failure meets its own rows in the key check and adds
    nothing. ``index`` makes the target a keyed table (``buckets``,
    ``expected_keys``), so a batch reads no more of it than its keys need.
    """
    source = raw_stream(spark, folder, schema or TABLES["authors" if kind == "authors" else "raw_comments"], files_per_batch, multi_line)
    table = None if index is None else keyed.create(spark, root, kind, KEYS[kind], **index)

    def write(batch: DataFrame, number: int) -> None:
        rows = shaped(numbered(batch, number), kind, [INGEST])
        if table is None:
            append_new(rows, root, kind)
        else:
            keyed.append(table, rows)

    return (
        source.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
