"""Maps of authors: yearly two-component maps and class separation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commentlens.functions import clock
from commentlens.functions import text as words
from commentlens.functions.stopwords import NLTK_ENGLISH
from commentlens.operators import discriminant as ld
from commentlens.operators import terms
from commentlens.operators.gram import leading_components
from commentlens.operators.joins import with_names
from commentlens.session import cut_lineage, once


def busy_authors(comments: DataFrame, more_than: int, keys: list[str]) -> DataFrame:
    """Keys (author, or author and year) with more than a number of comments."""
    counts = comments.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return counts.where(F.col("_n") > more_than).select(*keys)


def yearly_texts(comments: DataFrame, text: DataFrame | None, years: list[int], min_comments: int = 100) -> DataFrame:
    """Texts of the authors with more than ``min_comments`` comments in a year, all years at once (stores who they are)."""
    kept = ["id", "authorId", "createdAt"] if text is not None else ["id", "authorId", "createdAt", "bodyHtml"]
    rows = comments.where(clock.in_years("createdAt", years)).select(
        *kept, F.year(clock.wall_clock("createdAt")).alias("year")
    )
    busy = once(busy_authors(rows, min_comments, ["authorId", "year"]), "busy")  # its size decides whether texts are moved
    chosen = rows.join(busy, ["authorId", "year"], "left_semi")
    return chosen if text is None else chosen.join(text.select("id", "bodyHtml"), "id", "left")


def author_vectors(
    texts: DataFrame,
    n: int = 2,
    passes: int = 2,
    stem: bool = True,
    stop: list[str] | None = None,
    stop_before_stem: bool = False,
    across: bool = False,
    alone: str | None = None,
) -> DataFrame:
    """TF-IDF weights ``(year, authorId, term, w)`` of yearly author texts.

    ``alone`` names a column that tells the terms of one author of a year.

    With ``across`` an author's comments of a year are one text in order of
    time and id, so n-grams run on from one to the next.
    """
    counts = terms.gram_counts(
        texts,
        ["year", "authorId"],
        "bodyHtml",
        n,
        NLTK_ENGLISH if stop is None else stop,
        "porter" if stem else None,
        stop_before_stem,
        across=["createdAt", "id"] if across else None,
        slices=["year"],
    )
    return terms.smoothed_tfidf(counts, "authorId", ["year"], passes, alone)


def author_map(
    comments: DataFrame, text: DataFrame | None, years: list[int], min_comments: int = 100, k: int = 2, n: int = 2, **options
) -> tuple[DataFrame, DataFrame]:
    """Yearly maps ``(author_id, PCA_1.., year)`` and their explained ratios (runs jobs)."""
    texts = yearly_texts(comments, text, years, min_comments)
    return map_of_vectors(author_vectors(texts, n, alone="alone", **options), texts, k, "alone")


def map_of_vectors(vectors: DataFrame, texts: DataFrame, k: int = 2, alone: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The maps of :func:`author_map` from the vectors of yearly texts (runs jobs)."""
    listed = once(texts.select("year", "authorId").distinct(), "authors")
    scores, ratios = leading_components(vectors, "authorId", "term", "w", k, alone=alone, slice_by="year", rows=listed)
    columns = [f"PCA_{i + 1}" for i in range(k)]
    return scores.select(F.col("authorId").alias("author_id"), *columns, "year"), ratios


def map_of_year(pca: DataFrame, authors: DataFrame, year: int) -> DataFrame:
    """Stored scores of one year with names."""
    return with_names(pca.where(F.col("year") == year), authors, "author_id")


def word_space(frequencies: DataFrame, k: int = 15) -> tuple[DataFrame, DataFrame]:
    """Truncated, uncentred components of relative word frequencies: ``(name, pc1..)`` (runs jobs)."""
    scores, ratios = leading_components(frequencies, "author", "word", "freq", k, center=False, names="pc")
    return scores.withColumnRenamed("author", "name"), ratios


def labelled_vectors(
    df: DataFrame, body: str, n: int = 2, max_features: int = 2000, stem: bool = True, stop: list[str] | None = None
) -> DataFrame:
    """Sparse vectors of labelled texts (runs jobs).

    Token lists and vectors are each written once, since every later pass
    (term statistics, class means, Gram matrices, folds) reads them again;
    n-grams are made from the tokens where they are read.
    """
    tokens = words.split_blanks(F.lower(words.normalise(body)))
    rows = df.withColumn("_tokens", tokens).drop(body)
    if stem:
        rows = terms.stem_lists(rows, "_tokens", "porter")
    kept = words.without("_tokens", NLTK_ENGLISH if stop is None else stop)
    listed = cut_lineage(rows.withColumn("_tokens", kept), "tokens", "zstd").withColumn("_grams", words.ngrams("_tokens", n))
    return cut_lineage(ld.vectorise(listed, "_grams", max_features).drop("_tokens", "_grams"), "vectors")


def author_separation(
    vectors: DataFrame, key: str, label: str, features: str = "features", k: int = 2, train_percent: int = 20, folds: int = 5
) -> tuple[DataFrame, DataFrame]:
    """Discriminant coordinates of all rows, and the accuracies (runs jobs).

    The coordinates are fitted on all rows. The accuracy frame has one row per
    measure: each validation fold of the training part, and the test part. One
    pass over the vectors gives the statistics of all folds and of the test
    part, from which every model is solved; one more gives all accuracies.
    """
    split = ld.hash_split(vectors, key, train_percent, folds)
    group = F.when(F.col("part") == "train", F.col("fold")).otherwise(folds)  # the test part is the last group
    found = ld.moments_by(split, features, label, group, list(range(folds + 1)))
    of_folds = [found.get(f) for f in range(folds)]
    models = ld.fold_models(of_folds)
    if any(p is not None for p in of_folds):
        models[folds] = ld.solve(ld.added(of_folds))
    accuracies = ld.held_out_accuracies(split, features, label, models, group)
    rows = [("test" if g == folds else f"fold {g}", float(a)) for g, a in sorted(accuracies.items())]
    measures = vectors.sparkSession.createDataFrame(rows, "measure STRING, accuracy DOUBLE")
    placed = ld.project(vectors, features, ld.solve(ld.added(list(found.values()))), k)
    return placed.select(key, label, *[f"LD_{i + 1}" for i in range(k)]), measures
