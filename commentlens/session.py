"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the plans rely on. Partition counts are left to AQE: a generous
# initial number is coalesced after each shuffle, and skewed join partitions
# are split.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, app: str = "commentlens") -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A machine-local folder is made up only when the setting is missing *and*
    the session is local, as in tests.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = getattr(context, "_commentlens_scratch", None)
        if named is None:
            named = tempfile.mkdtemp(prefix="commentlens-")
            context._commentlens_scratch = named
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark).rstrip('/')}/commentlens/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, label: str = "stage", codec: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back (runs a job).

    Used between passes of iterative operators and wherever two readers must
    see exactly the same rows. Parquet, so later passes prune columns, and a
    lost executor costs a re-read and not a recomputation. ``codec`` compresses
    large rows of words otherwise than the session does.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    writer = df.write.mode("overwrite")
    (writer.option("compression", codec) if codec else writer).parquet(path)
    return as_stored(spark.read.schema(df.schema).parquet(path))


class Buckets:
    """``df`` stored in buckets by ``keys`` in the shared folder, for the time of a ``with`` block (runs a job).

    Joins and sums on these keys read the buckets where they are, without a
    shuffle, as long as ``spark.sql.shuffle.partitions`` keeps its value. The
    catalog entry goes at the end of the block; the files stay.
    """

    def __init__(self, df: DataFrame, keys: list[str]):
        self.df, self.keys = df, keys
        self.name = f"commentlens_buckets_{uuid.uuid4().hex}"

    def __enter__(self) -> DataFrame:
        spark = self.df.sparkSession
        number = int(spark.conf.get("spark.sql.shuffle.partitions"))
        dealt = self.df.repartition(number, *self.keys)  # one file a bucket
        path = scratch_path(spark, "buckets")
        dealt.write.bucketBy(number, *self.keys).sortBy(*self.keys).format("parquet").option("path", path).saveAsTable(self.name)
        return spark.table(self.name)

    def __exit__(self, *error) -> None:
        self.df.sparkSession.sql(f"DROP TABLE IF EXISTS {self.name}")


def once(df: DataFrame, label: str = "once", codec: str | None = None) -> DataFrame:
    """A result that several branches of a plan read, computed one time (runs a job).

    Branches prune and filter differently, so Spark can seldom share their
    shuffles by itself, and an expensive part (tokenising, stemming) would run
    in each of them. A frame that is already stored is returned as it is.
    """
    return df if is_stored(df) else cut_lineage(df, label, codec)


def is_stored(df: DataFrame) -> bool:
    return getattr(df, "_commentlens_stored", False)


def as_stored(df: DataFrame) -> DataFrame:
    """Take ``df`` for stored: it makes its rows from stored ones without a shuffle, so reading it again costs less than a copy."""
    df._commentlens_stored = True
    return df


def known_size(df: DataFrame) -> int:
    """Bytes as Spark's statistics have them: those of the files, if ``df`` reads stored rows."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def is_small(df: DataFrame) -> bool:
    """Whether Spark sends these rows to all tasks that join them."""
    return known_size(df) <= df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


PIECE = 8 << 20  # bytes of stored texts whose n-grams a task counts in memory


def spread(df: DataFrame, piece: int | None = None) -> DataFrame:
    """Give a small input one partition per core before CPU-heavy column work.

    Files of a single row group, compressed or multi-line files cannot be split,
    so one task would do all the work. An input that already has more splits
    than cores is left as it is, so large data is not shuffled for this.

    With ``piece`` an input of any size is dealt in pieces of about so many
    bytes: the n-grams of a usual split of 128 MB are more distinct keys than a
    task's memory holds, so counting them would spill and fall back to sorting.
    """
    pieces = df.sparkSession.sparkContext.defaultParallelism
    if piece:
        pieces = max(pieces, -(-known_size(df) // piece))
    return df.repartition(pieces) if df.rdd.getNumPartitions() <= pieces else df
