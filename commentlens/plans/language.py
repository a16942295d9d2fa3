"""Questions about language: signature words, frequencies, frequent terms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commentlens.functions import text as words
from commentlens.functions.stopwords import NLTK_ENGLISH, SNOWBALL_ENGLISH
from commentlens.operators import terms
from commentlens.operators.ranking import first_rows


def with_text(comments: DataFrame, text: DataFrame | None, how: str = "inner") -> DataFrame:
    """Author and body of every comment; without a text table the comments carry their body."""
    if text is None:
        return comments.select("authorId", "bodyHtml")
    return comments.select("id", "authorId").join(text.select("id", "bodyHtml"), "id", how)


def signature_terms(
    comments: DataFrame,
    text: DataFrame | None = None,
    n: int = 30,
    stem: bool = True,
    stop=None,
    stop_before_stem: bool = False,
    digits: int | None = None,
) -> DataFrame:
    """The words that set each author apart, by TF-IDF, ties included."""
    counts = terms.author_words(
        with_text(comments, text),
        "authorId",
        "bodyHtml",
        "english" if stem else None,
        SNOWBALL_ENGLISH if stop is None else stop,
        stop_before_stem,
    )
    return terms.top_terms_per_author(terms.tidy_tfidf(counts, "authorId"), "authorId", n, digits)


def word_frequencies(
    comments: DataFrame, text: DataFrame | None = None, author_ids: list | None = None, wide: bool = False, stop: list[str] | None = None
) -> DataFrame:
    """Share of each word in an author's vocabulary; ``wide`` gives one column per listed author."""
    rows = comments if author_ids is None else comments.where(F.col("authorId").isin(author_ids))
    counts = terms.word_counts(with_text(rows, text), "authorId", words.alphabetic_words("bodyHtml"))
    kept = terms.drop_words(counts, NLTK_ENGLISH if stop is None else stop)
    freq = terms.relative_frequencies(kept, "authorId").withColumnRenamed("authorId", "author")
    if not wide:
        return freq
    if author_ids is None:
        raise ValueError("the wide form needs the list of authors")
    return freq.groupBy("word").pivot("author", author_ids).agg(F.first("freq")).na.fill(0.0)


def frequent_terms(
    text: DataFrame,
    doc: str = "id",
    body: str = "bodyHtml",
    weighting: str = "tf",
    sparse: float | None = None,
    min_total: float | None = None,
    n: int = 50,
    digits: int | None = None,
) -> DataFrame:
    """Most frequent terms of a set of documents, by count or by weight."""
    matrix = terms.document_term(text, doc, body, ["the", "and", *SNOWBALL_ENGLISH])
    docs = text.agg(F.count(F.lit(1)).alias("docs"))
    if weighting == "tfidf":
        kept, value = terms.log2_tfidf(matrix, doc, docs, 0.95 if sparse is None else sparse), "w"
    else:
        kept, value = terms.drop_sparse(matrix, doc, docs, 0.99 if sparse is None else sparse), "n"
    totals = kept.groupBy("term").agg(F.sum(value).alias("weight"))
    if digits is not None:
        totals = totals.withColumn("weight", F.round("weight", digits))
    if min_total is not None:
        totals = totals.where(F.col("weight") >= min_total)
    return first_rows(totals, [F.desc("weight"), "term"], n)
