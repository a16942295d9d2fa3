"""Removal of lines that many sites share.

Each line's sites are sketched with HyperLogLog, and the sketches of a line
merge in one aggregation with map-side combine. Lines whose estimate is within a
factor of two of the threshold get the exact number of distinct sites. A line
over the threshold stays at its first place in the corpus only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commentlens.llm.shared import SPACE, free
from commentlens.session import once

LEAST_SITES = 3
LEAST_WORDS = 3
SKETCH_BITS = 12
DOUBT = 2.0
_LAST = 2**63 - 1


def lines(documents: DataFrame, doc_id: str, text: str, site: str) -> DataFrame:
    """Every line of every document: ``doc, body, site, at, line``.

    ``body`` is a hash of the text; it tells rows with one id apart. A null id
    counts as the last of all ids, a null site as a site of its own.
    """
    body = F.xxhash64(F.col(text))
    return documents.where(F.col(text).isNotNull()).select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(_LAST)).alias("doc"),
        body.alias("body"),
        F.coalesce(F.concat(F.lit("="), F.col(site).cast("string")), F.lit("")).alias("site"),
        F.posexplode(F.split(F.col(text), "\n")).alias("at", "line"),
    )


def spread_lines(found: DataFrame, least_sites: int = LEAST_SITES) -> DataFrame:
    """Lines on at least ``least_sites`` distinct sites, with their first place (runs a job).

    ``found`` has ``doc, at, site, mark``. Estimates of at least ``DOUBT`` times
    the threshold are taken as they are, lower ones down to the threshold
    divided by ``DOUBT`` are counted exactly, and the rest are dropped. With
    sketches of 2**12 buckets the standard error is below 2 %, far within that
    factor.
    """
    sketched = once(
        found.groupBy("mark")
        .agg(
            F.hll_sketch_estimate(F.hll_sketch_agg("site", SKETCH_BITS)).alias("estimate"),
            F.min(F.struct("doc", "at")).alias("first"),
        )
        .where(F.col("estimate") >= least_sites / DOUBT),
        "spread",
    )
    sure = sketched.where(F.col("estimate") >= least_sites * DOUBT)
    doubtful = sketched.where(F.col("estimate") < least_sites * DOUBT)
    exact = (
        found.select("mark", "site")
        .join(doubtful.select("mark"), "mark", "left_semi")
        .distinct()
        .groupBy("mark")
        .agg(F.count(F.lit(1)).alias("sites"))
        .where(F.col("sites") >= least_sites)
    )
    return sure.select("mark", "first").unionByName(doubtful.join(exact, "mark", "left_semi").select("mark", "first"))


def remove_spread_lines(
    documents: DataFrame,
    least_sites: int = LEAST_SITES,
    least_words: int = LEAST_WORDS,
    doc_id: str = "doc_id",
    text: str = "text",
    site: str = "source",
) -> DataFrame:
    """The documents with ``text`` cleaned, and ``n_lines`` and ``n_removed`` added (runs jobs).

    Lines of fewer than ``least_words`` words are never judged. A line found on
    ``least_sites`` sites or more stays only where the smallest document id has
    it first. All other columns pass through, whatever they are called; if one
    has the name of a count, the count is called ``n_lines_2`` or ``n_removed_2``.

    Null texts stay null with 0 lines; an empty text is one empty line. Rows
    that repeat an id and text keep the same lines. Ids are whole numbers.
    A text may be of any length: a line's verdict is read by its place.
    """
    wordy = F.regexp_count("line", F.lit(f"[^{SPACE}]+")) >= least_words
    found = once(
        lines(documents, doc_id, text, site).where(wordy).select("doc", "body", "at", "site", F.xxhash64("line").alias("mark")),
        "lines",
    )
    spread = once(spread_lines(found, least_sites), "spread")
    here = (F.col("doc") == F.col("first.doc")) & (F.col("at") == F.col("first.at"))
    gone = (
        found.join(spread, "mark")
        .where(~here)
        .groupBy("doc", "body")
        .agg(F.array_sort(F.collect_set("at")).alias("_gone"))
        .withColumnsRenamed({"doc": "_doc", "body": "_body"})
    )
    own = F.coalesce(F.col(doc_id).cast("long"), F.lit(_LAST)).alias("_own")
    # rows travel whole beside what is read of them, so none of their columns meets one of these
    packed = documents.select(F.struct("*").alias("_row"), own, F.col(text).alias("_text"), F.xxhash64(F.col(text)).alias("_hash"))
    joined = packed.join(gone, (F.col("_own") == F.col("_doc")) & (F.col("_hash") == F.col("_body")), "left")
    parts = F.split("_text", "\n")
    n_lines = F.coalesce(F.when(F.col("_text").isNotNull(), F.size(parts)), F.lit(0))
    named = [free(name, documents.columns) for name in ("n_lines", "n_removed")]
    return joined.select(
        *[(_without(parts, "_text").alias(text) if c == text else F.col("_row")[c].alias(c)) for c in documents.columns],
        n_lines.cast("long").alias(named[0]),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias(named[1]),
    )


def _without(parts: F.Column, text: str) -> F.Column:
    """The text without the lines whose places ``_gone`` lists in order.

    Between two places lies a slice of kept lines, so the work is one pass over
    the lines however many are removed. The outer array binds the split text,
    which is then made once.
    """
    starts = F.concat(F.array(F.lit(0)), F.transform("_gone", lambda x: x + 1))

    def kept(lines: F.Column) -> F.Column:
        stops = F.concat(F.col("_gone"), F.array(F.size(lines)))
        spans = F.arrays_zip(starts.alias("a"), stops.alias("b"))
        return F.array_join(F.flatten(F.transform(spans, lambda z: F.slice(lines, z["a"] + 1, z["b"] - z["a"]))), "\n")

    return F.when(F.col("_gone").isNull(), F.col(text)).otherwise(F.element_at(F.transform(F.array(parts), kept), 1))
