"""Chats for training: logged snapshots of growing conversations collapsed, then rendered.

Every turn's prefix, the turns up to it, has a hash that rolls along the
conversation. A conversation whose whole hash is a prefix of another is a
snapshot; an anti-join leaves the maximal conversations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from commentlens.operators.numbering import number_rows
from commentlens.session import once

STRETCH = 512


def prefixes(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Turns with their place and prefix hash: ``conv_id, conv, turn, role, text, at, h1, h2`` (runs jobs).

    Turns lie in the order of turn, role and text, nulls first; rows that
    repeat all of a turn count once. A prefix hash is the sum of two 64-bit
    hashes of its turns, each with its place: places come from range
    partitions, and sums run within stretches of a conversation and over their
    totals, so a conversation of any length is spread over tasks.
    """
    turns = conversations.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text")
    ).distinct()
    keyed = turns.withColumn("conv", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")))
    placed = once(number_rows(keyed, [F.col("conv"), F.col("turn"), F.col("role"), F.col("text")], "place"), "turns")
    first = placed.groupBy("conv").agg(F.min("place").alias("first"))
    at = placed.join(first, "conv").withColumn("at", F.col("place") - F.col("first") + 1).drop("first", "place")
    own = lambda seed: F.xxhash64(F.lit(seed), "at", "role", "text").cast("decimal(38,0)")
    hashed = once(at.withColumn("h1", own(1)).withColumn("h2", own(2)).withColumn("stretch", F.expr(f"(at - 1) div {STRETCH}")), "hashed")
    within = W.partitionBy("conv", "stretch").orderBy("at").rowsBetween(W.unboundedPreceding, 0)
    totals = hashed.groupBy("conv", "stretch").agg(F.sum("h1").alias("t1"), F.sum("h2").alias("t2"))
    before = W.partitionBy("conv").orderBy("stretch").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        "conv", "stretch", F.coalesce(F.sum("t1").over(before), F.lit(0)).alias("o1"), F.coalesce(F.sum("t2").over(before), F.lit(0)).alias("o2")
    )
    summed = hashed.withColumn("h1", F.sum("h1").over(within)).withColumn("h2", F.sum("h2").over(within)).join(offsets, ["conv", "stretch"])
    return summed.select(
        "conv_id", "conv", "turn", "role", "text", "at",
        (F.col("h1") + F.col("o1")).cast("decimal(38,0)").alias("h1"), (F.col("h2") + F.col("o2")).cast("decimal(38,0)").alias("h2"),
    )


def maximal(prefixed: DataFrame) -> DataFrame:
    """Turns of the conversations that prefix no longer one; of equal ones the first by id stays (runs a job)."""
    lengths = prefixed.groupBy("conv").agg(F.max("at").alias("turns"))
    keys = once(prefixed.select("conv", "at", "h1", "h2").join(lengths, "conv"), "prefixes")
    whole = keys.where(F.col("at") == F.col("turns"))
    # One row for each prefix: its longest conversation, and the first among those that end with it.
    tops = keys.groupBy("at", "h1", "h2").agg(
        F.max("turns").alias("longest"), F.min(F.when(F.col("at") == F.col("turns"), F.col("conv"))).alias("winner")
    )
    snapshots = (
        whole.join(tops, ["at", "h1", "h2"])
        .where((F.col("longest") > F.col("turns")) | (F.col("winner") != F.col("conv")))
        .select("conv")
    )
    return prefixed.join(snapshots, "conv", "left_anti")


def render(turns: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """Rendered conversations: rows ``conv_id, part, n_turns, text``.

    A turn reads ``<|im_start|>role``, its text, ``<|im_end|>``. Every
    ``stretch`` turns make a part, so no conversation becomes one large cell.
    A null role reads ``unknown``, a null text is empty.
    """
    shown = F.concat(
        F.lit("<|im_start|>"), F.coalesce("role", F.lit("unknown")), F.lit("\n"), F.coalesce("text", F.lit("")), F.lit("<|im_end|>\n")
    )
    parts = turns.select("conv", "conv_id", F.expr(f"(at - 1) div {stretch}").alias("part"), "at", shown.alias("shown"))
    grouped = parts.groupBy("conv", "part").agg(
        F.first("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_turns"), F.array_sort(F.collect_list(F.struct("at", "shown"))).alias("shown")
    )
    return grouped.select("conv_id", "part", "n_turns", F.array_join(F.col("shown.shown"), "").alias("text"))


def chats(conversations: DataFrame, **columns: str) -> DataFrame:
    """Maximal conversations, rendered (runs jobs).

    Null conversation ids form one conversation; repeated rows count once; an
    empty table gives no rows.
    """
    return render(maximal(once(prefixes(conversations, **columns), "prefixed")))
