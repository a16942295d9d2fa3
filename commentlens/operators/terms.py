"""Term counts and weights in long form ``(doc, term, n)``.

Tokens are counted per (doc, term) before anything else, so very common words
and very active authors are reduced map-side. Group totals are small
aggregates joined back and not windows, so no author or word is gathered in
one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commentlens.functions import stem as stemming
from commentlens.functions import text as words
from commentlens.operators.ranking import first_rows, top_n_per_group
from commentlens.operators.stitch import grams_across
from commentlens.session import PIECE, as_stored, is_small, is_stored, known_size, once, spread


def one_word_per_row(df: DataFrame, tokens: Column, keep: list[str], name: str = "word") -> DataFrame:
    return words.one_per_row(df, tokens, keep, name)


def word_counts(df: DataFrame, doc: str, tokens: Column, word: str = "word") -> DataFrame:
    """Occurrences of each word per document key."""
    return one_word_per_row(df, tokens, [doc], word).groupBy(doc, word).agg(F.count(F.lit(1)).alias("n"))


def stem_counts(counts: DataFrame, doc: str, rules: str) -> DataFrame:
    """Stem counted words and add up the words that share a stem (stores the counts and the stem dictionary once)."""
    counts = once(counts, "counts")
    stems = once(stemming.dictionary(counts, rules), "stems")
    return counts.join(stems, "word").groupBy(doc, F.col("stem").alias("word")).agg(F.sum("n").alias("n"))


def stem_lists(df: DataFrame, tokens: str, rules: str) -> DataFrame:
    """Stem the elements of a token list, keeping their order (stores the rows once).

    The stored rows are taken in pieces of about ``PIECE`` bytes. Each distinct
    word of a piece is sent once to the stem dictionary, and comes back only if
    its stem is another one; then the rows of a piece meet its stems, and Arrow
    looks their tokens up in one hash table. So the tokens move once, and no
    dictionary is larger than a piece. Other columns pass through Arrow too.
    """
    rows = once(df.withColumn("_row", F.monotonically_increasing_id()), "lists", "zstd")
    size = max(known_size(rows) * 3 // 2, 1)  # of which zstd leaves about two thirds
    each = max(rows.count() * PIECE // size, 1)  # rows of a piece; numbers of rows start anew in each partition
    within = F.col("_row").bitwiseAND((1 << 33) - 1)
    pieces = rows.select((F.col("_row") - F.pmod(within, F.lit(each))).alias("_piece"), *df.columns)
    found = words.one_per_row(pieces, tokens, ["_piece"], "word").mapInArrow(_words_of_pieces(), "_piece LONG, word STRING")
    stems = stemming.dictionary(found.repartition("word"), rules, "word", F.collect_set("_piece").alias("_pieces"))
    changed = words.one_per_row(stems, F.when(F.col("stem") != F.col("word"), F.col("_pieces")), ["word", "stem"], "_piece")

    def looked_up(own: pa.Table, known: pa.Table) -> pa.Table:
        joined, sizes = (own.column(c).combine_chunks() for c in ("_joined", "_sizes"))
        flat = cut_up(joined.drop_null(), sizes.flatten())
        found = known.column("stem").combine_chunks().take(pc.index_in(flat, known.column("word").combine_chunks()))
        counts = pc.fill_null(pc.list_value_length(sizes), 0).to_numpy(zero_copy_only=False)
        offsets = pa.array(np.cumsum([0, *counts]), pa.int32())
        made = pa.ListArray.from_arrays(offsets, pc.coalesce(found, flat), mask=sizes.is_null())
        return pa.table([made if c == tokens else own.column(c) for c in columns], columns)

    def cut_up(joined: pa.Array, sizes: pa.Array) -> pa.Array:
        _, starts, data = joined.buffers()
        first = np.frombuffer(starts, np.int32)[joined.offset] if len(joined) else 0  # of a slice
        ends = first + np.cumsum([0, *pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False)])
        flat = pa.StringArray.from_buffers(len(sizes), pa.py_buffer(ends.astype(np.int32)), data or pa.py_buffer(b""))
        return pc.if_else(sizes.is_valid(), flat, None) if sizes.null_count else flat

    # A list of strings takes twice the bytes of its words one after the other, with their sizes.
    columns, schema = df.columns, rows.drop("_row").schema
    packed = [F.array_join(tokens, "").alias("_joined"), F.transform(tokens, F.octet_length).alias("_sizes")]
    sent = pieces.select("_piece", *[c for c in columns if c != tokens], *packed)
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, 2 * size // PIECE)
    left, right = (side.repartition(tasks, "_piece").groupBy("_piece") for side in (sent, changed))
    return left.cogroup(right).applyInArrow(looked_up, schema)


HELD_ROWS = 1_000_000  # that a task holds before it counts them


def _words_of_pieces():
    """For rows ``_piece, word`` in order of their pieces: each distinct word of a piece, once or a few times."""

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, held = None, []

        def found() -> pa.RecordBatch:
            own = pc.unique(pa.concat_arrays(held))
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(own), piece)), own], ["_piece", "word"])

        for batch in batches:
            at, word = batch.column(0).to_numpy(), batch.column(1)
            cuts = [*np.flatnonzero(np.diff(at, prepend=-1)), len(at)]
            for a, b in zip(cuts, cuts[1:]):
                if held and at[a] != piece:
                    yield found()
                    held = []
                piece = at[a]
                held.append(word.slice(a, b - a))
                if sum(map(len, held[1:])) > HELD_ROWS:  # the first are distinct already
                    held = [pc.unique(pa.concat_arrays(held))]
        if held:
            yield found()

    return distinct


def _grams(rows: DataFrame, docs: list[str], order: list[str], n: int) -> DataFrame:
    if order:
        return grams_across(once(rows, "tokens"), docs, "_tokens", order, n)
    return one_word_per_row(spread(rows, PIECE) if is_stored(rows) else rows, words.ngrams("_tokens", n), docs, "term")


def drop_words(counts: DataFrame, stop: list[str] | DataFrame) -> DataFrame:
    """Drop stopwords: a short list as a filter, a table as an anti join."""
    if isinstance(stop, DataFrame):
        return counts.join(stop.select("word"), "word", "left_anti")
    return counts.where(~F.col("word").isin(stop))


def with_totals(counts: DataFrame, doc: str, name: str = "total") -> DataFrame:
    """Attach each document's word total (stores the counts once)."""
    counts = once(counts, "counts")
    return counts.join(counts.groupBy(doc).agg(F.sum("n").alias(name)), doc)


def document_frequency(counts: DataFrame, word: str = "word", within: list[str] | None = None) -> DataFrame:
    """Number of documents per word; counts hold one row per (doc, word)."""
    return counts.groupBy(*(within or []), word).agg(F.count(F.lit(1)).alias("df"))


def number_of_documents(counts: DataFrame, doc: str) -> DataFrame:
    """One row ``docs``: documents that hold any word."""
    return counts.agg(F.countDistinct(doc).alias("docs"))


def tidy_tfidf(counts: DataFrame, doc: str) -> DataFrame:
    """``tf = n / total``, ``idf = ln(N / df)``, ``tf_idf = tf * idf`` (stores the counts once)."""
    counts = once(counts, "counts")
    docs = number_of_documents(counts, doc)
    weighted = with_totals(counts, doc).join(document_frequency(counts), "word")
    tf = F.col("n") / F.col("total")
    idf = F.log(docs.scalar() / F.col("df"))
    return weighted.withColumn("tf", tf).withColumn("idf", idf).withColumn("tf_idf", F.col("tf") * F.col("idf")).drop("df")


def top_terms_per_author(weighted: DataFrame, doc: str, n: int = 30, digits: int | None = None) -> DataFrame:
    """Terms within the ``n`` highest weights of each author, ties included."""
    rows = weighted.select(doc, "word", "n", "tf_idf")
    if digits is not None:
        rows = rows.withColumn("tf_idf", F.round("tf_idf", digits))
    return top_n_per_group(rows, doc, "tf_idf", n)


def author_words(
    comments: DataFrame, doc: str, body: str, stem_rules: str | None = "english", stop=None, stop_before_stem: bool = False
) -> DataFrame:
    """Cleaned word counts per author as the tidy pipeline builds them."""
    counts = word_counts(comments, doc, words.tidy_words(words.drop_digits_and_handles(body)))
    if stop is not None and (stop_before_stem or not stem_rules):
        counts = drop_words(counts, stop)
    if stem_rules:
        counts = stem_counts(counts, doc, stem_rules)
        if stop is not None and not stop_before_stem:
            counts = drop_words(counts, stop)
    return counts


def relative_frequencies(counts: DataFrame, doc: str) -> DataFrame:
    """Word share of each author: rows ``(doc, word, freq)``."""
    total = with_totals(counts, doc)
    return total.select(doc, "word", (F.col("n") / F.col("total")).alias("freq"))


# --- document-term matrices ----------------------------------------------------


def document_term(df: DataFrame, doc: str, body: str, stop: list[str], shortest: int = 3) -> DataFrame:
    """Counts ``(doc, term, n)`` of cleaned texts, short terms left out."""
    tokens = F.filter(words.corpus_words(body, stop), lambda w: F.length(w) >= shortest)
    return word_counts(df, doc, tokens, "term")


def drop_sparse(matrix: DataFrame, doc: str, docs: DataFrame, sparse: float) -> DataFrame:
    """Keep terms that occur in more than ``docs * (1 - sparse)`` documents.

    ``docs`` is a one-row frame with the number of documents, empty ones included.
    """
    matrix = once(matrix, "matrix")
    df = document_frequency(matrix, "term")
    kept = once(df.where(F.col("df") > docs.scalar() * F.lit(1.0 - sparse)).select("term"), "kept")
    return matrix.join(kept, "term", "left_semi")


def log2_tfidf(matrix: DataFrame, doc: str, docs: DataFrame, sparse: float | None = None) -> DataFrame:
    """``w = n / doc length * log2(N / df)`` on the full matrix (stores the counts and their totals once).

    ``sparse`` leaves out sparse terms as :func:`drop_sparse` does, before any
    row of theirs is weighted; the lengths are those of whole documents. The
    totals are stored, so that their measured size decides whether the matrix
    is shuffled to meet them.
    """
    matrix = once(matrix, "matrix")
    df = matrix.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.count(doc).alias("_known"))
    if sparse is not None:  # rows without a document have no length, so no weight
        df = df.where(F.col("_known") > docs.scalar() * F.lit(1.0 - sparse))
    df = once(df.drop("_known"), "frequencies")
    lengths = once(matrix.groupBy(doc).agg(F.sum("n").alias("_len")), "lengths")
    weight = F.col("n") / F.col("_len") * F.log2(docs.scalar() / F.col("df"))
    return matrix.join(df, "term").join(lengths, doc).select(doc, "term", weight.alias("w"))


def term_totals(matrix: DataFrame, value: str = "n", at_least: float | None = None) -> DataFrame:
    """Column sums of a matrix, largest first, optionally from a minimum on."""
    totals = matrix.groupBy("term").agg(F.sum(value).alias("weight"))
    if at_least is not None:
        totals = totals.where(F.col("weight") >= at_least)
    return totals.orderBy(F.desc("weight"), F.asc("term"))


def top_terms(matrix: DataFrame, value: str = "n", n: int = 50) -> DataFrame:
    totals = matrix.groupBy("term").agg(F.sum(value).alias("weight"))
    return first_rows(totals, [F.desc("weight"), F.asc("term")], n)


# --- vectors -------------------------------------------------------------------


def gram_counts(
    df: DataFrame,
    docs: list[str],
    body: str,
    n: int = 1,
    stop: list[str] | None = None,
    stem_rules: str | None = "porter",
    stop_before_stem: bool = False,
    preprocessed: bool = True,
    across: list[str] | None = None,
    slices: list[str] | None = None,
) -> DataFrame:
    """n-gram counts ``(docs..., term, n)`` of stemmed, stop-filtered texts.

    Stems come from a dictionary of the distinct words (stores the tokens once).
    n-grams are built inside each comment, so no ordering shuffle is needed.
    ``across`` names the columns that put the comments of a document in order;
    then n-grams run on from one comment to the next (stores the tokens once).
    ``slices`` are those of ``docs`` within which document frequencies will be
    asked for: the counts are dealt by them and the term, so the rows of a term
    need no other shuffle to meet.
    """
    text = words.normalise(body) if preprocessed else F.col(body)
    tokens = words.split_blanks(F.lower(text))
    if stop and stop_before_stem:
        tokens = words.without(tokens, stop)
    order = [c for c in across or [] if c not in docs]
    rows = df.select(*docs, *order, tokens.alias("_tokens"))
    after = stop if stop and not stop_before_stem else None
    if stem_rules:
        rows = stem_lists(rows, "_tokens", stem_rules)
    if after:
        rows = rows.withColumn("_tokens", words.without("_tokens", after))
    grams = _grams(rows, docs, order, n)
    if slices is None:
        return grams.groupBy(*docs, "term").agg(F.count(F.lit(1)).alias("n"))
    counted = _counted_in_tasks(grams, [*docs, "term"])
    return counted.repartition(*slices, "term").groupBy(*docs, "term").agg(F.sum("n").alias("n"))


def _counted_in_tasks(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Counts ``n`` of equal rows within each task, as the map side of an aggregate has them, for any later shuffle."""

    def counted(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = pa.Table.from_batches(held).group_by(keys, use_threads=False).aggregate([([], "count_all")])
        yield from found.rename_columns({"count_all": "n"}).select([*keys, "n"]).to_batches()

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= HELD_ROWS:
                yield from counted(held)
                held = []
        if held:
            yield from counted(held)

    kept = rows.select(*keys)
    return kept.mapInArrow(add_up, T.StructType([*kept.schema.fields, T.StructField("n", T.LongType())]))


def cap_terms(counts: DataFrame, most: int) -> DataFrame:
    """Keep the ``most`` terms of highest total count (the feature cap)."""
    counts = once(counts, "counts")
    kept = top_terms(counts, "n", most).select("term")
    return counts.join(kept, "term", "left_semi")


def smoothed_tfidf(
    counts: DataFrame, doc: str, slices: list[str] | None = None, passes: int = 2, alone: str | None = None
) -> DataFrame:
    """``n * (ln((1 + N) / (1 + df)) + 1) ** passes``, then unit length per document.

    Two passes equal the vectoriser followed by a second transformer: the norm
    in between cancels. ``slices`` are columns (such as the year) within which
    the corpus statistics are taken. The rows of a term are brought together
    once, as they may already be (:func:`gram_counts`), and its counts stored with
    its frequency; weights are made from them where they are read. ``alone``
    names a column that tells the terms of one document.
    """
    within = slices or []
    frequency = F.count(F.lit(1)).over(W.partitionBy(*within, "term"))
    counts = once(counts.select(*within, doc, "term", "n", frequency.alias("_df")), "counts", "zstd")
    known = counts.where(F.col("term").isNotNull())
    if within:
        docs = once(counts.groupBy(*within).agg(F.countDistinct(doc).alias("_docs")), "docs")
        known, total = known.join(docs, within), F.col("_docs")
    else:
        docs = once(number_of_documents(counts, doc), "docs")
        total = docs.scalar()
    idf = F.log((total + 1) / (F.col("_df") + 1)) + 1
    weight = (F.col("n") * F.pow(idf, F.lit(float(passes)))).alias("w")
    raw = known.select(*within, doc, "term", weight, (F.col("_df") == 1).alias("_alone"))
    norms = once(raw.groupBy(*within, doc).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("_norm")), "norms")
    marks = [F.col("_alone").alias(alone)] if alone else []
    found = raw.join(norms, [*within, doc]).select(*within, doc, "term", (F.col("w") / F.col("_norm")).alias("w"), *marks)
    return as_stored(found) if is_small(docs) and is_small(norms) else found
