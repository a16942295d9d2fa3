"""The corpus pipeline: five stages from raw documents to a mix by source.

Each stage takes ``(spark, docs, sf_dir)`` and returns a frame, which is
written as Parquet and read again as the next one's documents. All but the last
return the columns of the documents, whatever further columns there are and
however they are called. Without documents every stage returns none. Null and
empty texts have no lines, copies or items; they reach the mix
with size 0 unless the toxicity of an empty text is one half or more. Texts of
any length are read whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commentlens.llm import decontam, linedup, mixing, ngramjoin, toxicity
from commentlens.llm.shared import by_value, table
from commentlens.session import cut_lineage

by_value("commentlens.llm.shared")


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half for toxicity. Repeated rows score alike."""
    return toxicity.remove_toxic(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that three or more sources share, but for their first places.

    ``n_chars`` follows the new text. A document of which nothing is left goes;
    one that had no text from the start stays. Rows that repeat an id and text
    keep the same lines.
    """
    cleaned = linedup.remove_spread_lines(docs)
    removed = F.col(cleaned.columns[-1]) > 0
    emptied = removed & (F.trim(F.regexp_replace("text", r"[\x09-\x0D]", " ")) == "")
    n_chars = F.when(removed, F.length("text")).otherwise(F.col("n_chars"))
    kept = cleaned.where(~emptied).withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id; of rows that repeat it, one. Null ids come last."""
    return ngramjoin.first_of_groups(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark items; all of them where the benchmark is empty."""
    return decontam.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document, sources weighing 5, 2, 1 in turn."""
    return mixing.mix(docs)


STAGES = [("toxicity", toxic), ("line dedup", lines), ("n-gram join", near), ("decontamination", clean), ("mixing", mixed)]

# A trained score and components have no SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut_lineage(docs, name.replace(" ", "-"))
    return docs
