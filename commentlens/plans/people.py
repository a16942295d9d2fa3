"""Questions about people: activity ranks, likes, shared threads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commentlens.operators import likes as lk
from commentlens.operators.aggregate import count_by, having
from commentlens.operators.dedupe import first_per_key
from commentlens.operators.joins import null_safe, orphans, with_names
from commentlens.operators.ranking import first_rows, top_n
from commentlens.operators.threads import interactions_with, thread_rows


def top_authors(
    comments: DataFrame, authors: DataFrame, n: int | None = None, min_comments: int = 0, keep_unnamed: bool = False
) -> DataFrame:
    """Most active authors with names; counts are cut before the names are joined."""
    counts = count_by(comments.where(F.col("authorId").isNotNull()), ["authorId"], "total_comments")
    if min_comments:
        counts = having(counts, "total_comments", min_comments)
    if n is not None:
        counts = top_n(counts, "total_comments", n)
    named = with_names(counts, authors, how="left").select("authorId", "displayName", "total_comments")
    if not keep_unnamed:
        named = named.na.drop("any")
    return named.orderBy(F.desc("total_comments"), "authorId")


def like_totals(named: DataFrame, by: str = "author", n: int = 20, by_id: bool = False) -> DataFrame:
    """Most liked authors (``by="author"``) or most active likers (``by="liker"``)."""
    column = f"{by}_id" if by_id else f"{by}_name"
    return lk.like_totals(named, column, n).withColumnRenamed(column, "name")


def likers_of(pairs: DataFrame, authors: DataFrame, author_ids: list, n: int = 20) -> DataFrame:
    """Who likes the given authors most; names are joined before the cut, ties stay."""
    rows = pairs.where(F.col("author_id").isin(author_ids))
    named = with_names(rows, authors, "liker_id").select("displayName", F.col("like_count").alias("likes_count"))
    return top_n(named, "likes_count", n).orderBy(F.desc("likes_count"), "displayName")


def thread_partners(comments: DataFrame, authors: DataFrame, author_id, n: int = 20, distinct: bool = False) -> DataFrame:
    """Who writes most in the threads of one author; cut with ties before the names are joined."""
    ranked = top_n(interactions_with(thread_rows(comments), author_id, distinct), "total_interactions", n)
    named = with_names(ranked, authors).select("displayName", "total_interactions")
    return named.orderBy(F.desc("total_interactions"), "displayName")


def topic_authors(comments: DataFrame, authors: DataFrame) -> DataFrame:
    """Most active authors of one topic file; authors deduped on their id."""
    once = first_per_key(authors.select("id", "displayName"), ["id"], ["displayName"])
    counts = count_by(comments.where(F.col("author_id").isNotNull()), ["author_id"], "n", "collection_id")
    named = counts.join(once.withColumnRenamed("id", "author_id"), "author_id")
    return named.select("author_id", "displayName", "n").orderBy(F.desc("n"), "author_id")


def like_pairs(comments: DataFrame, authors: DataFrame, min_likes: int = 0) -> DataFrame:
    """Liked pairs of the reply-tree generation with both names, by total."""
    liked = lk.likes_per_comment(comments, min_likes)
    counts = lk.pair_counts(lk.likes_from_lists(liked))
    renamed = authors.select(F.col("authorId").alias("author_id"), F.col("authorName").alias("displayName"))
    by_name = lk.pairs_by_name(lk.named_pairs(counts, renamed))
    return by_name.withColumnRenamed("like_count", "total").orderBy(F.desc("total"), "author_name", "liker_name")


def search(comments: DataFrame, pattern: str, column: str = "bodyHtml", regex: bool = True) -> DataFrame:
    """Comments whose text matches; null text is no match."""
    found = F.col(column).rlike(pattern) if regex else F.col(column).contains(pattern)
    return comments.where(null_safe(found))


def untitled(comments: DataFrame, titles: DataFrame) -> DataFrame:
    """Comments whose article has no title."""
    return orphans(comments, titles)


def most_liked_comments(comments: DataFrame, n: int = 20) -> DataFrame:
    return first_rows(lk.likes_per_comment(comments), [F.desc("likes_count"), "comment_id"], n)
