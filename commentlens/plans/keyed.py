"""Tables that are appended to by key, with an index of the keys they hold.

Rows lie in folders by a hash of their key. Beside them is an index: Bloom
filters, one per bucket and segment, of 32,768 bits each, made and merged by
Spark's bitmap aggregates. A batch asks the index of its buckets first. Keys that
the index doesn't know are new for sure; for the others the rows of their buckets
are read, key columns only. So a small batch of new rows reads a few folders of
the table, whatever the table's size, and a repeated batch reads its own.

The index is appended to before the rows. A load that fails in between leaves
keys in the index whose rows are missing; they are looked up, not found and
appended by the next run. ``reindex`` merges the parts of the index, with more
segments for a table that has outgrown it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from commentlens.plans.loading import new_rows
from commentlens.session import once
from commentlens.sources.tables import MissingTable, read_table

BUCKET = "key_bucket"
BITS = 32768  # of one bitmap aggregate
PROBES = 4
KEYS_PER_SEGMENT = 3000  # about eleven bits a key: one key in a hundred is looked up in vain


@dataclass(frozen=True)
class KeyedTable:
    """Where a keyed table lies and how its keys are dealt."""

    root: str
    name: str
    keys: tuple[str, ...]
    buckets: int
    segments: int

    @property
    def path(self) -> str:
        return f"{self.root}/{self.name}"

    @property
    def index_path(self) -> str:
        return f"{self.root}/_keyed/{self.name}/segments={self.segments}"


def create(
    spark: SparkSession, root: str, name: str, keys: list[str], buckets: int = 256, expected_keys: int = 10_000_000
) -> KeyedTable:
    """Set up a keyed table below ``root`` (runs a job). An existing one is returned as it is."""
    try:
        return opened(spark, root, name)
    except MissingTable:
        pass
    segments = max(-(-expected_keys // (buckets * KEYS_PER_SEGMENT)), 1)
    return _settle(spark, KeyedTable(root, name, tuple(keys), buckets, segments))


def _settle(spark: SparkSession, table: KeyedTable) -> KeyedTable:
    row = [(list(table.keys), table.buckets, table.segments)]
    settings = spark.createDataFrame(row, "keys ARRAY<STRING>, buckets INT, segments INT")
    settings.write.mode("overwrite").parquet(f"{table.root}/_keyed/{table.name}/_settings")
    return table


def opened(spark: SparkSession, root: str, name: str) -> KeyedTable:
    """The keyed table ``name`` below ``root``, or :class:`MissingTable`."""
    row = read_table(spark, f"_keyed/{name}/_settings", root).first()
    return KeyedTable(root, name, tuple(row["keys"]), row["buckets"], row["segments"])


def _places(table: KeyedTable) -> dict[str, Column]:
    """Bucket, segment and bits of a row's key; missing parts of a key count like any value."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("\0")) for k in table.keys]
    first, second = F.xxhash64(*parts), F.xxhash64(F.lit(1), *parts)
    bits = [F.shiftright(second, 15 * i).bitwiseAND(F.lit(BITS - 1)) for i in range(PROBES)]
    return {
        BUCKET: F.pmod(first, F.lit(table.buckets)).cast("int"),
        "_segment": F.pmod(F.shiftrightunsigned(first, 24), F.lit(table.segments)).cast("int"),
        "_bits": F.array(*bits),
    }


def index_of(table: KeyedTable, rows: DataFrame) -> DataFrame:
    """Bloom filters ``key_bucket, _segment, _set`` of rows that carry their places."""
    bits = rows.select(BUCKET, "_segment", F.explode("_bits").alias("_bit"))
    return bits.groupBy(BUCKET, "_segment").agg(F.bitmap_construct_agg("_bit").alias("_set"))


def _has(bit: Column) -> Column:
    """Whether a bit of ``_set`` is set."""
    byte = F.conv(F.hex(F.substring(F.col("_set"), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (bit % 8).cast("int")) == 1


def flagged(table: KeyedTable, rows: DataFrame, buckets: list[int]) -> DataFrame:
    """Rows with ``_maybe``: false for keys that the table doesn't hold.

    ``buckets`` are those of the rows; the index is read there only.
    """
    spark = rows.sparkSession
    try:
        parts = read_table(spark, table.index_path[len(table.root) + 1 :], table.root)
    except MissingTable:
        return rows.withColumn("_maybe", F.lit(False))
    merged = parts.where(F.col(BUCKET).isin(buckets)).groupBy(BUCKET, "_segment").agg(F.bitmap_or_agg("_set").alias("_set"))
    joined = rows.join(merged, [BUCKET, "_segment"], "left")
    found = F.lit(True)
    for i in range(PROBES):
        found = found & _has(F.col("_bits")[i])
    return joined.withColumn("_maybe", F.col("_set").isNotNull() & found).drop("_set")


def stored_keys(spark: SparkSession, table: KeyedTable, buckets: list[int]) -> DataFrame:
    """Keys that the table holds in some buckets; only their folders are read."""
    return read_table(spark, table.name, table.root).where(F.col(BUCKET).isin(buckets)).select(*table.keys)


def _buckets(rows: DataFrame) -> list[int]:
    return sorted(r[0] for r in rows.select(BUCKET).distinct().collect())  # as many as there are buckets, at most


def unseen(table: KeyedTable, batch: DataFrame) -> DataFrame:
    """Rows of a batch, one per key, that the table doesn't hold, with their buckets (runs jobs).

    The other parts of a key's place are hashes, made where they are read.
    """
    spark = batch.sparkSession
    columns = [*batch.columns, BUCKET]
    placed = once(batch.withColumn(BUCKET, _places(table)[BUCKET]), "batch")
    asked = once(flagged(table, placed.withColumns(_places(table)), _buckets(placed)).select(*columns, "_maybe"), "asked")
    suspects = asked.where("_maybe")
    near = _buckets(suspects)
    fresh = asked.where("NOT _maybe")
    if near:
        try:
            held = stored_keys(spark, table, near)
            fresh = fresh.unionByName(new_rows(suspects, held, list(table.keys)))
        except MissingTable:  # the index was written, the rows never were
            fresh = asked
    return fresh.drop("_maybe")


def append(table: KeyedTable, batch: DataFrame) -> int:
    """Append the rows whose keys the table lacks; returns their number (runs jobs).

    ``batch`` has one row per key. Appending it again adds nothing.
    """
    new = once(unseen(table, batch), "new")
    count = new.count()
    if count:
        index = index_of(table, new.withColumns(_places(table)))
        index.repartition(BUCKET).write.mode("append").partitionBy(BUCKET).parquet(table.index_path)
        # one file a bucket and batch
        new.repartition(BUCKET).write.mode("append").partitionBy(BUCKET).parquet(table.path)
    return count


def read(spark: SparkSession, table: KeyedTable) -> DataFrame:
    return read_table(spark, table.name, table.root).drop(BUCKET)


def reindex(spark: SparkSession, table: KeyedTable, expected_keys: int) -> KeyedTable:
    """Build the index anew for more keys, from the table's key columns (runs jobs).

    The new index is complete before the settings name it, so a failure leaves
    the old one in use. No batch may be appended meanwhile.
    """
    segments = max(-(-expected_keys // (table.buckets * KEYS_PER_SEGMENT)), 1)
    if segments == table.segments:
        return table
    larger = KeyedTable(table.root, table.name, table.keys, table.buckets, segments)
    rows = read_table(spark, table.name, table.root).select(*table.keys).withColumns(_places(larger))
    index_of(larger, rows).repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(larger.index_path)
    return _settle(spark, larger)
