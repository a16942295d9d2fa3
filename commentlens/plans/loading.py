"""Warehouse loads: shape each table from the raw rows, append what is new."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from commentlens.functions.links import id_between_slash_and_query, id_from_last_segment, short_collection_id
from commentlens.functions.text import strip_tags
from commentlens.operators.dedupe import first_per_key
from commentlens.operators.joins import null_safe, replace_titles
from commentlens.operators.likes import likes_from_text
from commentlens.operators.nested import author_rows, head_comments
from commentlens.schemas import KEYS, TABLES
from commentlens.session import known_size, once
from commentlens.sources.tables import MissingTable, read_table


SMALL = 10 << 20  # bytes of a batch that is sent everywhere


def shape_comments(raw: DataFrame, *carry: str) -> DataFrame:
    """Comment facts: missing parents become -1, rows without an author are dropped.

    A comment without an id gets a negative one from its other columns, so
    different comments stay apart and a repeated load finds them again.
    """

    def number(name: str) -> Column:
        return F.coalesce(F.col(name).cast("long"), F.lit(-1)).alias(name)

    own = own_key("ancestorId", "parentId", "authorId", "createdAt", "ft_id")
    return raw.where(F.col("authorId").isNotNull()).select(
        number("ancestorId"), "authorId", "createdAt", "ft_id", F.coalesce(F.col("id").cast("long"), own).alias("id"), number("parentId"), *carry
    )


def own_key(*columns: str) -> Column:
    """A negative key below -1 made of a row's columns."""
    return -2 - F.pmod(F.xxhash64(*columns), F.lit(1 << 62))


def shape_text(raw: DataFrame, *carry: str) -> DataFrame:
    """Bodies without tags; rows without a body are dropped, those without an id get a key of their body."""
    key = F.coalesce(F.col("id").cast("long"), own_key("bodyHtml")).alias("id")
    return raw.where(F.col("bodyHtml").isNotNull()).select(key, strip_tags("bodyHtml").alias("bodyHtml"), *carry)


def shape_titles(raw: DataFrame, *carry: str) -> DataFrame:
    """Article titles; rows without a title are dropped."""
    return raw.where(F.col("title").isNotNull()).select("ft_id", "title", *carry)


def shape_authors(raw: DataFrame, *carry: str) -> DataFrame:
    return raw.where(F.col("author_id").isNotNull()).select("author_id", "displayName", *carry)


def shape_likes(raw: DataFrame, *carry: str) -> DataFrame:
    """One row per liker of a comment; empty lists give none. Both columns are the key."""
    return likes_from_text(raw)


SHAPES = {
    "comments": shape_comments,
    "text": shape_text,
    "titles": shape_titles,
    "authors": shape_authors,
    "likes": shape_likes,
}


def shaped(raw: DataFrame, kind: str, order: list[str] | None = None, among: DataFrame | None = None) -> DataFrame:
    """Raw rows in the form of one warehouse table, one row per key.

    The first row in ``order`` (raw columns) wins; pass ``["ingest"]`` for rows
    read in landing order. Without an order the smallest row wins. ``among``
    holds keys; rows of other keys are left out before any is moved.
    """
    keys = KEYS[kind]
    rows = SHAPES[kind](raw)
    columns = rows.columns
    rest = [c for c in columns if c not in keys]
    if not rest:
        return (rows if among is None else among.select(*columns)).distinct()
    if order is None:
        return first_per_key(_among(rows, among, keys), keys, rest)
    tagged = _among(SHAPES[kind](raw.withColumn("_order", F.struct(*order)), "_order"), among, keys)
    # rows that come at the same place are told apart by what they hold
    return first_per_key(tagged, keys, ["_order", *rest]).select(columns)


def _among(rows: DataFrame, among: DataFrame | None, keys: list[str]) -> DataFrame:
    return rows if among is None else _matching(rows, among, keys, "left_semi")


def new_rows(batch: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a batch whose key is not stored yet; a missing part of a key equals a missing one.

    When the batch is small the stored keys are first reduced to those it holds,
    by a broadcast semi join, so a large table is scanned for its key columns
    only and never shuffled. A large batch meets the stored keys at once.
    """
    known = stored.select(*keys)
    if known_size(batch) <= SMALL:
        known = _matching(known, batch.select(*keys), keys, "left_semi")
    return _matching(batch, known, keys, "left_anti")


def _matching(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    other = right.select(*[F.col(k).alias(f"_{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return left.join(other, same, how)


def append_new(batch: DataFrame, root: str, kind: str) -> None:
    """Append the rows of a shaped, deduped batch that the table does not hold (runs a job).

    Running it again with the same batch changes nothing, so a replayed batch
    is harmless. The batch is stored once: its keys and its rows are both read,
    and its true size decides whether the key check can broadcast it.
    """
    spark = batch.sparkSession
    columns = stored_columns(spark, kind)
    try:
        stored = read_table(spark, kind, root)
        batch = new_rows(once(batch, "batch"), stored, KEYS[kind])
    except MissingTable:
        pass
    batch.select(*columns).write.mode("append").parquet(f"{root}/{kind}")


def stored_columns(spark: SparkSession, kind: str) -> list[str]:
    return spark.createDataFrame([], TABLES[kind]).columns


def load(raw: DataFrame, root: str, kind: str, order: list[str] | None = None) -> int:
    """Load one warehouse table from raw rows; returns the number of appended rows (runs jobs).

    The keys meet the table first, and only rows of keys that it lacks are put
    in order and written; so rows that come again are never moved.
    """
    spark = raw.sparkSession
    keys = KEYS[kind]

    def size() -> int:
        try:
            return read_table(spark, kind, root).count()
        except MissingTable:
            return 0

    before = size()
    try:
        stored = read_table(spark, kind, root)
        found = SHAPES[kind](raw)
        # keys that are whole rows repeat seldom, and those that are new are made distinct in the end
        found = once(found.select(*keys) if set(found.columns) == set(keys) else found.select(*keys).distinct(), "keys")
        fresh = once(new_rows(found, stored, keys), "fresh")
    except MissingTable:
        fresh = None
    shaped(raw, kind, order, fresh).select(*stored_columns(spark, kind)).write.mode("append").parquet(f"{root}/{kind}")
    return size() - before


def site_links(sites: DataFrame) -> DataFrame:
    """Articles whose site address is known: ``ft_hash, topic, short_id``."""
    known = sites.where(null_safe(F.col("siteId").contains("https")))
    return known.select("ft_hash", "topic", short_collection_id("siteId").alias("short_id"))


def save_topics(docs: DataFrame, links: DataFrame, path: str, doc_id: str = "short_id") -> None:
    """Write the comments and the authors of every topic, a folder each, all topics in two passes (runs jobs).

    ``docs`` are head documents with the short id of their collection; a
    document belongs to each topic that lists its article. Authors come once a
    topic. Earlier output is replaced topic by topic.
    """
    chosen = once(docs.join(links.select("topic", F.col("short_id").alias(doc_id)).distinct(), doc_id), "topics")
    for name, rows in (("comments", head_comments(chosen, "topic")), ("authors", author_rows(chosen, "headDocument.authors", "topic"))):
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("topic").parquet(f"{path}/{name}")


def repair_titles(comments: DataFrame, clean: DataFrame, addressed: DataFrame) -> DataFrame:
    """Replace comment titles by those of two title files.

    ``addressed`` holds ids inside URLs. Ids are extracted, missing ones
    dropped, and one title per id is kept, so comments do not multiply.
    """
    taken = addressed.withColumn("ft_id", id_between_slash_and_query("ft_id"))
    titles = clean.select("ft_id", "title").unionByName(taken.select("ft_id", "title"))
    titles = titles.where(F.col("ft_id").isNotNull()).withColumn("ft_id", id_from_last_segment("ft_id"))
    return replace_titles(comments, first_per_key(titles, ["ft_id"], ["title"]))
