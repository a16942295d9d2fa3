"""How filters of a corpus interact: what each removes in every order, from one streamed pass.

All files of the documents are read as micro-batches (``availableNow``). A
document's failures are a mask of one bit a filter. All but one bit follow from
its text alone. The last one, being a copy of a document with a smaller id,
depends on documents that may come in later batches: so a keyed state of texts keeps
the smallest id of each so far, with what was counted for it. Every copy is counted as
failing, the holder of the smallest id as passing; when a smaller id arrives,
the earlier holder's count is taken back and entered anew as a copy's. Each batch
adds its changes, as sums by part and mask, to a table of counters, under
the batch's number, so a repeated batch replaces its own. A restarted query
goes on from its checkpoint in the shared folder.

Copies are reduced before they are shuffled to their text's state, to a row a
part and set of labels for every Arrow batch; all orders' figures come from the
counters, whose number follows parts and masks only.
"""

from __future__ import annotations

import json
import math
from collections import Counter
from collections.abc import Iterator
from itertools import combinations, permutations

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from commentlens.llm.shared import SPACE
from commentlens.session import scratch_path

COUNTERS = "part string, mask int, good int, toxic int, n long"
REDUCED = "key string, part string, mask int, good int, toxic int, low long, n_low long, n long, n_null long"
REDUCED_COLUMNS = [column.split()[0] for column in REDUCED.split(", ")]
STATE = "texts string"
# A state holds the texts of one hash bucket, about so many, since a call of Python a text would cost far more than its work.
TEXTS = 200
TEXT_BYTES = 1000  # of a file, taken for one text when buckets are counted
STATE_BYTES = 8 << 30  # input that one state partition serves
# Above so much input the stream's state lives on the executors' disks, with bounded memory.
LARGE = 64 << 30
ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "400",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def audit(
    spark: SparkSession,
    path: str,
    labels: DataFrame,
    conditions: dict[str, Column],
    copies: str = "E",
    doc_id: str = "doc_id",
    text: str = "text",
    part: str = "lang",
    batches: int = 4,
    state_partitions: int | None = None,
) -> DataFrame:
    """A row per part, order of the filters and step, with what the step's filter does there (runs jobs).

    ``conditions`` names each filter by one letter and says when a row of the
    documents in ``path`` *fails* it; ``copies`` names the filter that fails rows
    whose text is that of a smaller id anywhere. ``labels`` has ``doc_id``,
    ``quality`` and ``toxic``; a document is good or toxic if any of its labels
    is 1. Columns: ``part, filter_order, step, kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley``.

    Null texts count as empty ones and null parts as the empty string. A
    condition that is null doesn't fail. Rows that repeat the smallest id all
    pass the copies filter; null ids neither fail it nor make others fail, and
    have no labels. Other columns aren't read. Without rows there are no parts
    and the result is empty. ``batches`` is the number of micro-batches that the
    files are dealt to.
    """
    found = counters(spark, path, labels, conditions, doc_id, text, part, batches, state_partitions)
    return steps(found, [*conditions, copies])


def counters(
    spark: SparkSession,
    path: str,
    labels: DataFrame,
    conditions: dict[str, Column],
    doc_id: str = "doc_id",
    text: str = "text",
    part: str = "lang",
    batches: int = 4,
    state_partitions: int | None = None,
) -> DataFrame:
    """Documents by ``part``, ``mask``, ``good`` and ``toxic``; the mask's highest bit is the copies filter (runs jobs)."""
    still = spark.read.parquet(path)
    files = still.inputFiles()
    # A stream takes folders and patterns, so a path that is a file is given as a pattern that matches it alone.
    alone = len(files) == 1 and files[0].endswith("/" + path.rstrip("/").rpartition("/")[2])
    source = f"{path[:-1]}[{path[-1]}]" if alone else path
    size = int(still._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if state_partitions is None:
        state_partitions = max(2 * spark.sparkContext.defaultParallelism, size // STATE_BYTES)
    buckets = max(size // (TEXTS * TEXT_BYTES), 4 * state_partitions)
    marked, out, checkpoint = (scratch_path(spark, name) for name in ("labels", "counters", "stream"))
    flags(labels).write.parquet(marked)
    spark.createDataFrame([], COUNTERS).write.parquet(f"{out}/batch=-1")  # so that the table exists without rows

    # The stream's settings stay out of the caller's session.
    session = spark.newSession()
    settings = {"spark.sql.shuffle.partitions": str(state_partitions)} | (ON_DISK if size > LARGE else {})
    for name, value in settings.items():
        session.conf.set(name, value)
    rows = session.readStream.schema(still.schema).option("maxFilesPerTrigger", max(-(-len(files) // batches), 1)).parquet(source)
    changes = changed(rows, session.read.parquet(marked), list(conditions.values()), doc_id, text, part, buckets)

    def add(batch: DataFrame, number: int) -> None:
        sums = batch.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n")).where("n != 0")
        sums.coalesce(1).write.mode("overwrite").parquet(f"{out}/batch={number}")  # a few rows a part

    query = changes.writeStream.outputMode("update").foreachBatch(add)
    query.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    stored = spark.read.schema(COUNTERS).parquet(out)
    return stored.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))


def flags(labels: DataFrame) -> DataFrame:
    one = lambda name: F.max((F.col(name) == 1).cast("int"))
    return labels.groupBy("doc_id").agg(
        F.coalesce(one("quality"), F.lit(0)).alias("good"), F.coalesce(one("toxic"), F.lit(0)).alias("toxic")
    )


def changed(
    rows: DataFrame, marked: DataFrame, failing: list[Column], doc_id: str, text: str, part: str, buckets: int
) -> DataFrame:
    """Changes of the counters by the documents of a stream: ``part, mask, good, toxic, n``."""
    mask = sum((F.when(c, 1 << k).otherwise(0) for k, c in enumerate(failing)), F.lit(0))
    key = F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)
    known = rows.select(
        key.alias("key"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        mask.cast("int").alias("mask"),
        F.col(doc_id).cast("long").alias("id"),
        # rows without an id meet no label; their texts spread them
        F.when(F.col(doc_id).isNull(), F.pmod(F.xxhash64(text), F.lit(1 << 20)) + 1).otherwise(0).alias("salt"),
    )
    flagged = marked.select(F.col("doc_id").cast("long").alias("id"), "good", "toxic", F.lit(0).cast("long").alias("salt"))
    labelled = known.join(flagged, ["id", "salt"], "left").select(
        "key", "part", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"), "id"
    )
    copied = 1 << len(failing)

    def update(_: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        # text -> smallest id and its holders [part, mask, good, toxic, rows]
        texts: dict[str, list] = json.loads(state.get[0]) if state.exists else {}
        changes: Counter = Counter()
        for frame in frames:
            columns = [frame[name].tolist() for name in REDUCED_COLUMNS]
            for key, part, mask, good, toxic, first, n_low, n, n_null in zip(*columns):
                changes[part, mask, good, toxic] += n_null
                if not n:
                    continue
                changes[part, mask | copied, good, toxic] += n
                own = texts.get(key)
                if own is None or first < own[0]:
                    # the holders so far turn out to be copies
                    for p, m, g, t, count in own[1] if own else []:
                        changes[p, m, g, t] -= count
                        changes[p, m | copied, g, t] += count
                    own = texts[key] = [first, []]
                if first == own[0]:
                    changes[part, mask | copied, good, toxic] -= n_low
                    changes[part, mask, good, toxic] += n_low
                    own[1].append([part, mask, good, toxic, n_low])
        state.update((json.dumps(texts, separators=(",", ":")),))
        yield pd.DataFrame([(*who, n) for who, n in changes.items() if n], columns=["part", "mask", "good", "toxic", "n"])

    reduced = labelled.mapInArrow(reduce_copies, REDUCED)
    bucket = F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("bucket")
    grouped = reduced.select(bucket, *REDUCED_COLUMNS).groupBy("bucket")
    return grouped.applyInPandasWithState(update, COUNTERS, STATE, "update", "NoTimeout")


def reduce_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A batch's copies of a text as one row a part, mask and labels: the smallest id, how often it comes, and the rows with and without id.

    ``low`` is 0 where no row has an id.
    """
    kinds = [pa.string(), pa.string(), *[pa.int32()] * 3, *[pa.int64()] * 4]
    for batch in batches:
        found: dict[tuple, list[int]] = {}
        *own, ids = (column.to_pylist() for column in batch.columns)
        for who, id_ in zip(zip(*own), ids):
            row = found.setdefault(who, [0, 0, 0, 0])
            if id_ is None:
                row[3] += 1
                continue
            if not row[2] or id_ < row[0]:
                row[:2] = id_, 0
            row[1] += id_ == row[0]
            row[2] += 1
        columns = zip(*((*who, *row) for who, row in found.items())) if found else [[]] * len(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], REDUCED_COLUMNS)


def steps(found: DataFrame, filters: list[str]) -> DataFrame:
    """Every step of every order of the filters, from the counters.

    What a step does depends on its filter and on the set of filters before it,
    not on their order. So figures are summed for each such pair, and then
    looked up by all orders. A document that fails c filters is removed by each
    of them in one of c orders.
    """
    bit = {name: 1 << k for k, name in enumerate(filters)}
    pairs = [
        (bit[name], sum(bit[o] for o in before))
        for name in filters
        for size in range(len(filters))
        for before in combinations([o for o in filters if o != name], size)
    ]
    orders = [
        ("".join(order), k + 1, bit[name], sum(bit[o] for o in order[:k]))
        for order in permutations(filters)
        for k, name in enumerate(order)
    ]
    mask, own, before, n = F.col("mask"), F.col("pair.own"), F.col("pair.before"), F.col("n")
    pair = F.array(*[F.struct(F.lit(a).alias("own"), F.lit(b).alias("before")) for a, b in pairs])
    fails = mask.bitwiseAND(own) != 0
    there = mask.bitwiseAND(before) == 0
    n_orders = math.factorial(len(filters))

    def total(condition: Column, amount: Column = n) -> Column:
        return F.sum(F.when(condition, amount).otherwise(0)).cast("long")

    sums = (
        found.withColumn("pair", F.explode(pair))
        .groupBy("part", own.alias("own"), before.alias("before"))
        .agg(
            total(there & ~fails).alias("kept"),
            total(there & fails).alias("removed"),
            total(~there & fails).alias("redundant"),
            total(mask == own).alias("unique_fails"),
            total(there & fails & (F.col("good") == 1)).alias("good_lost"),
            total(there & fails & (F.col("toxic") == 1)).alias("toxic_lost"),
            total(fails, (n * n_orders / F.bit_count(mask)).cast("long")).alias("shapley"),
        )
    )
    spark = found.sparkSession
    # len(filters)! x len(filters) rows, whatever the corpus
    every = spark.createDataFrame(orders, "filter_order string, step int, own int, before int")
    return sums.join(F.broadcast(every), ["own", "before"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )


def document_rules(text: str = "text") -> dict[str, Column]:
    """Failure of four rules: few words, few distinct words, many capitals, a symbol of ``#$%&*|``."""
    whole = F.coalesce(F.col(text), F.lit(""))
    words = F.regexp_extract_all(whole, F.lit(f"([^{SPACE}]+)"), F.lit(1))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * F.regexp_count(whole, F.lit("[A-Z]")) > 3 * F.length(whole),
        "D": whole.rlike(r"[#$%&*|]"),
    }
