"""The logical inputs as views over the generated test tables.

Each view has a DataFrame form and the same text in SQL for the check. The
views only rename and compute columns; they never leave out rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commentlens.session import PIECE, spread


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def wide_table(spark: SparkSession, folder: str, name: str, piece: int | None = None) -> DataFrame:
    """A table of long texts, spread over the cores when it is small, or in pieces."""
    return spread(table(spark, folder, name), piece)


def seconds(column: str):
    return F.unix_seconds(F.col(column).cast("timestamp"))


def comments(spark: SparkSession, folder: str) -> DataFrame:
    """Comment facts: events by user."""
    return table(spark, folder, "events").select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("authorId"),
        seconds("ts").alias("createdAt"),
        F.col("event_id").alias("ft_id"),
        F.col("event_type").alias("topic"),
    )


COMMENTS = """comments AS (
  SELECT event_id AS id, user_id AS authorId, CAST(floor(epoch(ts)) AS BIGINT) AS createdAt,
         event_id AS ft_id, event_type AS topic, date_trunc('second', ts) AS moment
  FROM events)"""


def authors(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("author_id"), F.col("c_name").alias("displayName")
    )


AUTHORS = "authors AS (SELECT c_custkey AS author_id, c_name AS displayName FROM customer)"


def edges(spark: SparkSession, folder: str) -> DataFrame:
    """Like edges: the supplier of a line is the author, the customer of its order the liker."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_suppkey")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_suppkey").alias("author_id"), F.col("o_custkey").alias("liker_id")
    )


EDGES = """edges AS (
  SELECT l_suppkey AS author_id, o_custkey AS liker_id FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
PAIRS = "pairs AS (SELECT author_id, liker_id, count(*) AS like_count FROM edges GROUP BY 1, 2)"
NAMED = """named AS (
  SELECT p.author_id, a.displayName AS author_name, p.liker_id, l.displayName AS liker_name, p.like_count
  FROM pairs p JOIN authors a ON p.author_id = a.author_id JOIN authors l ON p.liker_id = l.author_id)"""
BY_NAME = """by_name AS (
  SELECT author_name, liker_name, CAST(sum(like_count) AS BIGINT) AS like_count FROM named GROUP BY 1, 2)"""


def threads(spark: SparkSession, folder: str) -> DataFrame:
    """Threads: the first line of an order is the root comment."""
    first = F.col("l_linenumber") == 1
    return table(spark, folder, "lineitem").select(
        F.when(first, F.col("l_orderkey")).otherwise(-F.col("l_orderkey") * 10 - F.col("l_linenumber")).alias("id"),
        F.when(first, F.lit(-1)).otherwise(F.col("l_orderkey")).cast("long").alias("ancestorId"),
        F.col("l_suppkey").alias("authorId"),
    )


THREADS = """threads AS (
  SELECT CASE WHEN l_linenumber = 1 THEN l_orderkey ELSE -l_orderkey * 10 - l_linenumber END AS id,
         CAST(CASE WHEN l_linenumber = 1 THEN -1 ELSE l_orderkey END AS BIGINT) AS ancestorId,
         l_suppkey AS authorId
  FROM lineitem)"""


def texts(spark: SparkSession, folder: str, piece: int | None = PIECE) -> DataFrame:
    """Comment texts: documents by source, spread over five years."""
    return wide_table(spark, folder, "documents", piece).select(
        F.col("doc_id").alias("id"),
        F.col("source").alias("authorId"),
        F.col("text").alias("bodyHtml"),
        (F.lit(1388534400) + F.pmod(F.col("doc_id") * 97, F.lit(1826)) * 86400).alias("createdAt"),
    )


TEXTS = "texts AS (SELECT doc_id AS id, source AS authorId, text AS bodyHtml FROM documents)"


def text_table(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("bodyHtml"))


def titles(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(F.col("doc_id").alias("ft_id"), F.col("lang").alias("title"))


def orders_liked(spark: SparkSession, folder: str) -> DataFrame:
    """Comments with liker lists: up to two likers computed from each order."""
    o = table(spark, folder, "orders")
    price = F.floor("o_totalprice").cast("long")
    likers = F.array(F.pmod(F.col("o_orderkey"), F.lit(89)), F.pmod(price, F.lit(97)))
    none = F.array().cast("array<bigint>")
    return o.select(
        F.col("o_orderkey").alias("comment_id"),
        F.col("o_custkey").alias("author_id"),
        F.when(F.col("o_orderstatus") == "F", none).otherwise(likers).alias("liked_by"),
    )


ORDERS_LIKED = """liked AS (
  SELECT o_orderkey AS comment_id, o_custkey AS author_id,
         CASE WHEN o_orderstatus = 'F' THEN CAST([] AS BIGINT[])
              ELSE [CAST(o_orderkey % 89 AS BIGINT), CAST(floor(o_totalprice) AS BIGINT) % 97] END AS liked_by
  FROM orders)"""


def with_clause(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def day_text(column):
    return F.date_format(column, "yyyy-MM-dd")


def moment_text(column):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def sql_list(words: list[str]) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in dict.fromkeys(words))


# Word patterns in the form of the check engine.
SQL_WORDS = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}_]+(?:[''’.][\p{{L}}\p{{N}}_]+)*')"
SQL_SPLIT = r"list_filter(string_split_regex(lower({0}), '[^\p{{L}}\p{{N}}_]+'), lambda x: x <> '')"
SQL_NORMAL = (
    r"concat(regexp_replace(lower(regexp_replace({0}, '<[^>]*>', '', 'g')), '[^\p{{L}}\p{{N}}_]+', ' ', 'g'), "
    r"replace(array_to_string(regexp_extract_all(regexp_replace({0}, '<[^>]*>', '', 'g'), '[:;=]-?[()DP]'), ' '), '-', ''))"
)
SQL_HANDLES = (
    r"regexp_replace(regexp_replace(trim(regexp_replace({0}, '\s+', ' ', 'g')), '[0-9]', '', 'g'), "
    r"'@[\p{{L}}\p{{N}}_]+ *', '', 'g')"
)
