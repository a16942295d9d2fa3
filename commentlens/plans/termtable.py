"""The stored term table: weights of all authors, read one author at a time.

Rows lie in folders by a hash of the author and in files sorted by author and
falling weight, so a reader of one author opens the files of one folder and, by
their statistics, the row groups of that author. Newer weights of some authors are
appended as a new version; an author's latest version counts. So an update
writes the changed authors only, and a failed one leaves the old weights in place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commentlens.sources.tables import MissingTable, read_table

FOLDER = "author_bucket"
NAME = "tfidf"


def _bucket(author, buckets: int):
    return F.pmod(F.xxhash64(author.cast("string")), F.lit(buckets)).cast("int")


def store_terms(weighted: DataFrame, root: str, buckets: int = 256, author: str = "authorId", weight: str = "tf_idf") -> int:
    """Append the weights of the authors in ``weighted`` as the next version; returns its number (runs jobs).

    The number of folders is fixed by the first call.
    """
    spark = weighted.sparkSession
    try:
        last = read_table(spark, NAME, root).agg(F.max("version").alias("v"), F.max("buckets").alias("b")).first()
        version, buckets = (last["v"] or 0) + 1, last["b"] or buckets
    except MissingTable:
        version = 1
    rows = weighted.withColumns({
        "version": F.lit(version), "buckets": F.lit(buckets), FOLDER: _bucket(F.col(author), buckets)
    })
    placed = rows.repartition(FOLDER, F.col(author)).sortWithinPartitions(FOLDER, author, F.desc(weight))
    placed.write.mode("append").partitionBy(FOLDER).parquet(f"{root}/{NAME}")
    return version


def terms_of(spark: SparkSession, root: str, who, author: str = "authorId") -> DataFrame:
    """Latest weights of one author; the folder and the author are filters of the scan."""
    table = read_table(spark, NAME, root)
    buckets = table.select("buckets").first()["buckets"]
    folder = spark.range(1).select(_bucket(F.lit(who), buckets)).first()[0]
    own = table.where((F.col(FOLDER) == folder) & (F.col(author) == F.lit(who)))
    latest = own.agg(F.max("version").alias("v"))
    return own.where(F.col("version") == latest.scalar()).drop(FOLDER, "version", "buckets")


def all_terms(spark: SparkSession, root: str, author: str = "authorId") -> DataFrame:
    """Latest weights of all authors."""
    table = read_table(spark, NAME, root)
    latest = table.groupBy(author).agg(F.max("version").alias("version"))
    return table.join(latest, [author, "version"]).drop(FOLDER, "version", "buckets")
