"""The order in which raw rows landed.

A row's place is ``struct(batch, file, start, row)``: the number of its load,
the file it came in, the start of its block in the file and its position among
the rows of the block. Batches are numbered by the caller or by the stream;
files of a batch follow one another by name, as land times are too coarse and
change when files are copied. The structs compare in this order, so "the first
row wins" is a minimum, whatever the rows hold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INGEST = "ingest"


def with_source(df: DataFrame) -> DataFrame:
    """Add ``_file`` and ``_start`` to rows just read from files; also for streams."""
    return df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"))


def numbered(df: DataFrame, batch: int = 0, name: str = INGEST) -> DataFrame:
    """Turn ``_file`` and ``_start`` into the place ``name``.

    Must come before any shuffle: rows of a block are read by one task, in
    order, and so are the numbers they get here.
    """
    place = F.struct(
        F.lit(batch).cast("long").alias("batch"),
        F.col("_file").alias("file"),
        F.col("_start").alias("start"),
        F.monotonically_increasing_id().alias("row"),
    )
    return df.withColumn(name, place).drop("_file", "_start")


def landed(df: DataFrame, batch: int = 0, name: str = INGEST) -> DataFrame:
    """Rows just read from files with their place."""
    return numbered(with_source(df), batch, name)
