"""Like edges: from lists and list texts to counted (author, liker) pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commentlens.operators.joins import with_both_names
from commentlens.operators.numbering import dense_codes
from commentlens.operators.ranking import first_rows
from commentlens.session import once


def likes_from_text(raw: DataFrame, key: str = "id", liked_by: str = "likedBy", keep_empty: bool = False) -> DataFrame:
    """``['a', 'b']`` as text to rows ``(comment_id, likedBy)``.

    Cuts the outer characters, splits on commas, drops quotes and blanks. An
    empty list gives no row unless ``keep_empty``.
    """
    inner = F.expr(f"substring({liked_by}, 2, length({liked_by}) - 2)")
    items = F.transform(F.split(inner, ","), lambda x: F.translate(x, "' ", ""))
    rows = raw.where(F.col(liked_by).isNotNull()).select(
        F.col(key).cast("long").alias("comment_id"), F.explode(items).alias("likedBy")
    )
    return rows if keep_empty else rows.where(F.col("likedBy") != "")


def likers_with_at(comments: DataFrame, author: str = "author_id", liked_by: str = "liked_by") -> DataFrame:
    """List texts of the first data generation to rows ``(author_id, liker_id)``; only names with ``@``."""
    items = F.split(F.regexp_replace(F.coalesce(F.col(liked_by), F.lit("")), r"[\[\]]", ""), ", ")
    rows = comments.select(F.col(author).alias("author_id"), F.explode(items).alias("liker_id"))
    return rows.where(F.col("liker_id").contains("@"))


def likes_from_lists(comments: DataFrame, author: str = "author_id", liked_by: str = "liked_by") -> DataFrame:
    """Real lists to rows ``(author_id, liker_id)``."""
    rows = comments.select(F.col(author).alias("author_id"), F.explode(liked_by).alias("liker_id"))
    return rows.where(F.col("liker_id").isNotNull())


def edges_of(likes: DataFrame, comments: DataFrame) -> DataFrame:
    """Stored likes to rows ``(author_id, liker_id)`` through the liked comment."""
    written = comments.select(F.col("id").alias("_id"), F.col("authorId").alias("author_id"))
    return likes.join(written, F.col("comment_id") == F.col("_id")).select(
        "author_id", F.col("likedBy").alias("liker_id")
    )


def pair_counts(edges: DataFrame, name: str = "like_count") -> DataFrame:
    """Likes per (author, liker)."""
    return edges.groupBy("author_id", "liker_id").agg(F.count(F.lit(1)).alias(name))


def named_pairs(pairs: DataFrame, authors: DataFrame) -> DataFrame:
    """Pairs with both names, names joined after counting."""
    return with_both_names(pairs, authors).select(
        "author_id", "author_name", "liker_id", "liker_name", "like_count"
    )


def pairs_by_name(named: DataFrame) -> DataFrame:
    """Like totals per pair of display names; people who share a name merge."""
    return named.groupBy("author_name", "liker_name").agg(F.sum("like_count").alias("like_count"))


def like_totals(named: DataFrame, by: str = "author_name", n: int = 20) -> DataFrame:
    """The ``n`` largest like totals by one column, ties broken by the name."""
    totals = named.groupBy(by).agg(F.sum("like_count").alias("like_count"))
    return first_rows(totals, [F.desc("like_count"), F.asc(by)], n)


def likes_per_comment(comments: DataFrame, more_than: int = 0) -> DataFrame:
    """Number of likers of each comment, above a threshold."""
    counted = comments.withColumn("likes_count", F.size(F.coalesce(F.col("liked_by"), F.array().cast("array<string>"))))
    return counted.where(F.col("likes_count") > more_than)


def friends_of(named: DataFrame, likers: list[str], n: int = 20) -> DataFrame:
    """Author names on the ``n`` strongest (liker, author) pairs of the given likers."""
    given = pairs_by_name(named.where(F.col("liker_name").isin(likers)))
    return first_rows(given, [F.desc("like_count"), F.asc("liker_name"), F.asc("author_name")], n)


def kept_likers(grid: DataFrame) -> list[str]:
    """Column names of the like matrix (runs a job).

    Liker names in order, as many as there are author rows. The number of
    author rows is known first, so no more names than that are fetched.
    """
    rows = grid.agg(F.countDistinct("author_name").alias("k")).first()["k"]
    most = int(grid.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    if rows > most:
        raise ValueError(f"{rows} author rows exceed the widest pivot ({most}); use like_matrix_cells or a higher limit")
    names = grid.select("liker_name").distinct().orderBy("liker_name").limit(rows)
    return [r[0] for r in names.collect()]


def like_matrix(pairs: DataFrame, limit: int) -> DataFrame:
    """Author rows, liker columns, only pairs above ``limit`` (runs jobs for the columns)."""
    grid = once(pairs.where(F.col("like_count") > limit), "grid")
    return grid.groupBy("author_name").pivot("liker_name", kept_likers(grid)).agg(F.sum("like_count"))


def like_matrix_cells(pairs: DataFrame, limit: int) -> DataFrame:
    """The same matrix in long form, for any size: cells of the kept liker columns."""
    grid = once(pairs.where(F.col("like_count") > limit), "grid")
    rows = grid.agg(F.countDistinct("author_name").alias("k"))
    kept = dense_codes(grid, "liker_name", "column_no").where(F.col("column_no") <= rows.scalar())
    return grid.join(kept, "liker_name").select("author_name", "liker_name", "column_no", "like_count")
