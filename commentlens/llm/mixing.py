"""Mixing sources to target weights by Sainte-Laguë apportionment.

Words are handed out in blocks of equal size. Sources get whole numbers of
blocks by the highest quotients ``target / (2k + 1)``; each source's blocks go
to its shards by the same rule with the shards' sizes as votes; within a shard
a seeded, evenly stepped selection takes that many blocks of the shard's words,
whose documents lie in seeded order.

Everything is a DataFrame expression. Sources are ranked and quotients compared
by range partitioning, so neither many sources nor many shards of one source
meet in one task; a shard is bounded by ``shard_words``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from commentlens.llm.shared import word_count
from commentlens.operators.numbering import number_rows
from commentlens.session import once

CYCLE = (5, 2, 1)
MOST_PASSES = 3
SEED = 42
SHARD_WORDS = 1_000_000
BLOCKS_OF_SMALLEST = 256
LARGEST_BLOCK = 1024


def sizes(documents: DataFrame, seed: int = SEED, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Size in words of every document, and its seeded place ``draw``.

    The place follows the id and the text, so documents that share an id, or
    have none, are dealt to different shards.
    """
    own = F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))
    key = F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":"), own)
    return documents.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        word_count(text).alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), key)).alias("draw"),
    )


def targets(sized: DataFrame, cycle: tuple[int, ...] = CYCLE, most_passes: int = MOST_PASSES) -> DataFrame:
    """Weight and target words of every source: rows ``source, code, source_size, weight, target`` (runs jobs).

    Sources take the weights of ``cycle`` in code-point order, null last, and
    share the sum of all sizes by weight. A target stops at ``most_passes``
    times its source's size; what it leaves goes to the others by weight.
    Each round fixes the sources that are above at the present share per
    weight; the share only grows, so the rounds end when none is added.
    """
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = number_rows(per_source, [F.col("source").asc_nulls_last()], "code")
    turn = (F.col("code") - 1) % len(cycle)
    weights = F.element_at(F.array(*[F.lit(float(w)) for w in cycle]), (turn + 1).cast("int"))
    weighted = once(ranked.withColumn("weight", weights), "sources")
    total, weight = weighted.agg(F.sum("source_size"), F.sum("weight")).first()
    stopped_words, stopped_weight, share = 0, 0.0, 0.0
    while total:
        share = (total - most_passes * stopped_words) / (weight - stopped_weight)
        above = weighted.where(most_passes * F.col("source_size") < share * F.col("weight"))
        words, heavy = above.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0.0))).first()
        if (words, heavy) == (stopped_words, stopped_weight):
            break
        stopped_words, stopped_weight = words, heavy
    full = (most_passes * F.col("source_size")).cast("double")
    return weighted.withColumn("target", F.least(full, share * F.col("weight")))


def apportion(votes: DataFrame, group: str, party: str, vote: str, seats: str) -> DataFrame:
    """Sainte-Laguë seats of every party of every group: adds ``quota`` (runs jobs).

    ``seats`` is the group's number of seats, repeated in its rows; ``group``
    and ``party`` are whole numbers, and ties go to the lower party. With V
    votes and n parties, dividing by ``V / (N - n/2)`` gives at most N seats
    and by ``V / (N + n/2)`` at least N. Only the quotients between the two,
    about 2n of them, are put in order.
    """
    whole = votes.groupBy(group).agg(
        F.sum(vote).alias("_votes"), F.count(F.lit(1)).alias("_parties"), F.max(seats).alias("_seats")
    )
    few, many = F.col("_seats") - F.col("_parties") / 2, F.col("_seats") + F.col("_parties") / 2
    per_vote = lambda n: F.when(F.col("_votes") > 0, F.greatest(n, F.lit(0.0)) / F.col("_votes")).otherwise(0.0)
    least = F.floor(F.col(vote) * per_vote(few) + 0.5 - 1e-9)
    most = F.floor(F.col(vote) * per_vote(many) + 0.5 + 1e-9)
    bounds = once(
        votes.join(whole, group)
        .withColumn("_least", F.when(F.col("_seats") > 0, F.greatest(least, F.lit(0))).otherwise(0))
        .withColumn("_most", F.when(F.col("_seats") > 0, most).otherwise(0)),
        "bounds",
    )
    open_seats = bounds.groupBy(group).agg((F.max("_seats") - F.sum("_least")).alias("_open"))
    quotients = (
        bounds.where(F.col("_most") > F.col("_least"))
        .select(group, party, F.explode(F.sequence("_least", F.col("_most") - 1)).alias("_k"), vote)
        .select(group, party, (F.col(vote) / (2 * F.col("_k") + 1)).alias("_quotient"))
    )
    placed = once(number_rows(quotients, [F.col(group), F.desc("_quotient"), F.col(party)], "_at"), "quotients")
    first = placed.groupBy(group).agg(F.min("_at").alias("_first"))
    won = (
        placed.join(first, group)
        .join(open_seats, group)
        .where(F.col("_at") - F.col("_first") < F.col("_open"))
        .groupBy(group, party)
        .agg(F.count(F.lit(1)).alias("_won"))
    )
    kept = bounds.join(won, [group, party], "left")
    return kept.withColumn("quota", F.col("_least") + F.coalesce("_won", F.lit(0))).select(*votes.columns, "quota")


def block_words(planned: DataFrame) -> int:
    """Words of a block: a 256th of the smallest target above 0, within 1 and 1024 (runs a job)."""
    smallest = planned.where(F.col("target") > 0).agg(F.min("target")).first()[0]
    return int(min(LARGEST_BLOCK, max(1, (smallest or 1) // BLOCKS_OF_SMALLEST)))


def mix(
    documents: DataFrame,
    cycle: tuple[int, ...] = CYCLE,
    most_passes: int = MOST_PASSES,
    seed: int = SEED,
    shard_words: int = SHARD_WORDS,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """Words taken of every document: rows ``doc_id, source, size, source_size, target, taken`` (runs jobs).

    A null text has size 0; a null source is a source of its own, the last.
    A null id is an id like any other. Documents without words take nothing,
    and an empty table gives an empty mix. Repeated rows are documents of
    their own. No document is taken more than ``most_passes`` times.

    A shard of S words with Q words of quota is taken Q div S times as a whole.
    Of the rest, whole blocks are chosen at even steps from a seeded start, so
    the number of chosen blocks before any word has a closed form and no block
    becomes a row; what is less than a block comes from the shard's last,
    incomplete block.
    """
    sized = once(sizes(documents, seed, doc_id, text, source), "sized")
    planned = once(targets(sized, cycle, most_passes), "targets")
    block = block_words(planned)
    total = planned.agg(F.sum("target")).first()[0] or 0.0
    seats = planned.withColumn("_all", F.lit(0).cast("long")).withColumn("_blocks", F.lit(int(total // block)).cast("long"))
    by_source = apportion(seats, "_all", "code", "target", "_blocks").select(
        "source", "code", "source_size", "target", F.col("quota").alias("source_quota")
    )
    by_source = once(by_source.withColumn("shards", F.greatest(F.ceil(F.col("source_size") / shard_words), F.lit(1))), "quotas")
    dealt = sized.join(by_source.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).withColumn(
        "shard", F.expr("conv(substring(draw, 1, 8), 16, 10)").cast("long") % F.col("shards")
    )
    shards = dealt.groupBy("code", "shard").agg(F.sum("size").alias("shard_size"), F.max("source_quota").alias("source_quota"))
    quotas = apportion(shards.where(F.col("shard_size") > 0), "code", "shard", "shard_size", "source_quota").select(
        "code", "shard", "shard_size", "quota"
    )
    line = W.partitionBy("code", "shard").orderBy("draw", "doc_id", "size").rowsBetween(W.unboundedPreceding, 0)
    placed = dealt.where(F.col("size") > 0).join(quotas, ["code", "shard"]).withColumn("stop", F.sum("size").over(line))
    taken = _take(placed, block, most_passes, seed)
    columns = ["doc_id", "source", "size", "source_size", "target", "taken"]
    without = dealt.where(F.col("size") == 0).withColumn("taken", F.lit(0).cast("long"))
    return taken.select(*columns).unionByName(without.select(*columns))


def _take(placed: DataFrame, block: int, most_passes: int, seed: int) -> DataFrame:
    """Words taken of the documents that lie at ``stop - size`` to ``stop`` on their shards' lines: adds ``taken``."""
    b = F.lit(block).cast("long")
    wanted = F.least(F.col("quota") * b, most_passes * F.col("shard_size"))
    step = {
        "passes": "wanted div shard_size",
        "rest": "wanted % shard_size",
        "blocks": f"shard_size div {block}L",
        "tail": f"shard_size % {block}L",
        "odd": f"rest % {block}L",
        # An odd rest that the incomplete block can't cover goes to the nearer of less and more.
        "up": f"odd > tail AND odd - tail >= {block}L - odd",
        "chosen": f"rest div {block}L + IF(up, 1L, 0L)",
        "from_tail": "IF(up, 0L, least(odd, tail))",
        "start": f"CAST(conv(substring(md5(concat('{seed}:', code, ':', shard)), 1, 8), 16, 10) AS BIGINT) % greatest(blocks, 1L)",
    }
    frame = placed.withColumn("wanted", wanted)
    for name, expression in step.items():
        frame = frame.withColumn(f"{name}", F.expr(expression))

    def before(x: F.Column) -> F.Column:
        """Chosen words among the first x of the line."""
        full = F.least(F.floor(x / b), F.col("blocks"))
        count = lambda j: F.floor((j + F.col("start")) * F.col("chosen") / F.greatest("blocks", F.lit(1)))
        inside = F.when(full < F.col("blocks"), (count(full + 1) - count(full)) * (x - full * b)).otherwise(0)
        tail = F.least(F.greatest(x - F.col("blocks") * b, F.lit(0)), F.col("from_tail"))
        return (count(full) - count(F.lit(0))) * b + inside + tail

    words = F.col("passes") * F.col("size") + before(F.col("stop")) - before(F.col("stop") - F.col("size"))
    return frame.withColumn("taken", words.cast("long"))
