"""n-grams that run on from one comment of an author to the next.

Inside a comment n-grams are built in its row. Only its first and last n - 1
tokens are needed for those that cross into a neighbour. These edges are put in
order of author and time by a range partitioning, in which an active author
takes as many partitions as needed, and numbered through. A comment's last
tokens are then sent to the numbers of the next n - 1 comments, where those of
the same author are joined in front of the first tokens. So no author's
comments are gathered anywhere, and whole texts are not moved.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commentlens.functions import text as words
from commentlens.operators.numbering import number_rows
from commentlens.session import PIECE, is_stored, once, spread


def crossing_grams(rows: DataFrame, docs: list[str], tokens: str, order: list[str], n: int, name: str = "term") -> DataFrame:
    """n-grams that hold tokens of more than one comment: rows ``(docs..., name)`` (runs jobs).

    Comments of one ``docs`` key follow each other in ``order``, then in that of
    their tokens. Comments without tokens are passed over; a comment shorter
    than n - 1 tokens lets those before it reach through. Null keys have no
    neighbours.
    """
    if n < 2:
        return rows.select(*docs, F.lit("").alias(name)).limit(0)
    reach = n - 1
    size = F.size(tokens)
    known = rows.where(size > 0)
    for key in docs:
        known = known.where(F.col(key).isNotNull())
    edges = known.select(
        *docs,
        *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
        F.slice(tokens, 1, reach).alias("_head"),
        F.slice(F.col(tokens), F.greatest(size - reach + 1, F.lit(1)), F.lit(reach)).alias("_tail"),
    )
    places = [*docs, *[f"_o{i}" for i in range(len(order))], "_head", "_tail"]
    placed = once(number_rows(edges, places, "_no").select(*docs, "_no", "_head", "_tail"), "edges")
    step = F.explode(F.sequence(F.lit(1), F.lit(reach))).alias("_step")
    sent = placed.select(*docs, step, "_no", "_tail").withColumn("_no", F.col("_no") + F.col("_step"))
    # at most n - 1 short lists meet at a number
    before = sent.groupBy(*docs, "_no").agg(F.array_sort(F.collect_list(F.struct((-F.col("_step")).alias("k"), "_tail"))).alias("_t"))
    joined = placed.select(*docs, "_no", "_head").join(before, [*docs, "_no"])
    carried = F.flatten(F.transform("_t", lambda t: t["_tail"]))
    last = F.slice(carried, F.greatest(F.size(carried) - reach + 1, F.lit(1)), F.lit(reach))
    return joined.select(*docs, F.explode(words.ngrams(F.concat(last, F.col("_head")), n)).alias(name))


def grams_across(rows: DataFrame, docs: list[str], tokens: str, order: list[str], n: int, name: str = "term") -> DataFrame:
    """All n-grams of the comments of each key, read one after the other (runs jobs)."""
    inside = words.one_per_row(spread(rows, PIECE) if is_stored(rows) else rows, words.ngrams(tokens, n), docs, name)
    return inside if n < 2 else inside.unionByName(crossing_grams(rows, docs, tokens, order, n, name))

