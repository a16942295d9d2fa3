"""The operators over the whole test tables: ``ENTRIES`` maps a name to its query and, where SQL can express it, its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commentlens.llm import (
    chat,
    decontam,
    htmltext,
    interaction,
    linedup,
    lmscore,
    mixing,
    ngramjoin,
    packing,
    periodic,
    qualitybayes,
    qualityrules,
    sql,
    toxicity,
)
from commentlens.llm.shared import by_value, table

by_value(__name__)


def op1_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Words that the mix takes of every document, sources weighing 5, 2, 1 in turn."""
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op7_site_spread(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the lines that three or more sources share."""
    cleaned = linedup.remove_spread_lines(table(spark, folder, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_removed", "text")


def op8_suffix_arrays(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document that lie in a window of a benchmark item."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return decontam.judged(decontam.matches(documents, table(spark, folder, "benchmark"), keep_text=False))


def op10_subword_bags(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document; rows of fold 0 of 5 are never learned from."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    found = toxicity.scored(documents, table(spark, folder, "labels"), keep_text=False)
    return found.select(
        "doc_id",
        (toxicity.fold("doc_id") == 0).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
    )


def op9_count_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Shingle set size and component of every document, linked at a Jaccard of 0.75."""
    found = ngramjoin.near_copies(table(spark, folder, "documents"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def op2_page_text(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return htmltext.extract(table(spark, folder, "pages")).select("page_id", "url", "text", "n_chars")


def op3_chat_collapse(spark: SparkSession, folder: str) -> DataFrame:
    """Rendered conversations that prefix no longer one."""
    return chat.chats(table(spark, folder, "conversations"))


def op4_site_posteriors(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document from its own evidence and that of its source and language section."""
    return qualitybayes.posteriors(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op5_divergence_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Quality counts of every document and the verdict of its divergence from its language."""
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang")
    found = qualityrules.judged(documents, keep_text=False)
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return found.select(*columns, "class_distance", "word_distance")


def op6_entropy_difference(spark: SparkSession, folder: str) -> DataFrame:
    """Loss per word of every document under good documents' bigrams less that under all documents'."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return lmscore.scored(documents, table(spark, folder, "labels"), keep_text=False)


def op11_bin_completion(spark: SparkSession, folder: str) -> DataFrame:
    """Places of all pieces of all documents in sequences of 2048 tokens."""
    import public_tokenizers

    found = packing.pieces(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    digests = found.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return packing.pack(digests).select(*columns)


def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    """What five filters remove in every order, for each language."""
    return interaction.audit(
        spark, f"{folder}/documents.parquet", table(spark, folder, "labels"), interaction.document_rules()
    )


def op13_block_convolution(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of every document, with repetitions planted in one of ten, and the text that is left without them."""
    documents = table(spark, folder, "documents").select("doc_id", periodic.planted("doc_id", "text").alias("text"))
    found = periodic.collapse(documents)
    longest = F.reduce(
        "runs",
        F.lit(None).cast("struct<start: long, length: long, period: long>"),
        lambda best, r: F.when(best.isNull() | (r["length"] > best["length"]), r).otherwise(best),
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("longest.start").alias("start"),
        F.col("longest.length").alias("length"),
        F.col("longest.period").alias("period"),
        F.floor(F.col("longest.length") * 1000 / F.col("longest.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


ENTRIES = {
    "op1_source_mix": (op1_source_mix, sql.SOURCE_MIX),
    "op2_page_text": (op2_page_text, None),
    "op3_chat_collapse": (op3_chat_collapse, sql.CHATS),
    "op4_site_posteriors": (op4_site_posteriors, None),
    "op5_divergence_rules": (op5_divergence_rules, None),
    "op6_entropy_difference": (op6_entropy_difference, None),
    "op7_site_spread": (op7_site_spread, sql.SITE_SPREAD),
    "op8_suffix_arrays": (op8_suffix_arrays, sql.BENCHMARK_WINDOWS),
    "op9_count_vectors": (op9_count_vectors, None),
    "op10_subword_bags": (op10_subword_bags, None),
    "op11_bin_completion": (op11_bin_completion, None),
    "op12_filter_audit": (op12_filter_audit, sql.FILTER_AUDIT),
    "op13_block_convolution": (op13_block_convolution, None),
}
