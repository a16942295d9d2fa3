"""Pieces that several operators use."""

from __future__ import annotations

import hashlib
import importlib
import pkgutil
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the white space that parts words.
SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def word_count(text: str | Column) -> Column:
    """Number of words of a text, 0 for null: runs of anything but white space."""
    column = F.col(text) if isinstance(text, str) else text
    found = F.regexp_count(column, F.lit(f"[^{SPACE}]+"))
    return F.coalesce(found.cast("long"), F.lit(0).cast("long"))


def by_value(module_name: str) -> None:
    """Send this package's Python functions to workers by value.

    Workers then need not have the package on their path.
    """
    package = importlib.import_module(module_name.rpartition(".")[0])
    for found in pkgutil.iter_modules(package.__path__, f"{package.__name__}."):
        cloudpickle.register_pickle_by_value(importlib.import_module(found.name))


def free(name: str, taken: Iterable[str]) -> str:
    """``name``, or the first of ``name_2``, ``name_3``, ... that no column has."""
    used, number, found = set(taken), 1, name
    while found in used:
        number += 1
        found = f"{name}_{number}"
    return found


def digest(values: Iterator[str]) -> str:
    return hashlib.sha256(",".join(values).encode()).hexdigest()


def slices(batch: pa.RecordBatch, column: int, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Stretches of a batch whose texts have about ``most`` bytes, or one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).cumsum(dtype="int64")
    start = 0
    while start < batch.num_rows:
        done = int(sizes[start - 1]) if start else 0
        end = max(int(sizes.searchsorted(done + most, side="right")), start + 1)
        yield batch.slice(start, end - start)
        start = end


BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python in batches of a thousand rows at most, as they may be long."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) > BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)
