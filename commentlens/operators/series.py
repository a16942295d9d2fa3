"""Calendar spines and gap-free series."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from commentlens.operators.dedupe import first_per_key
from commentlens.session import once


def days(spark: SparkSession, start: date, end: date, name: str = "date") -> DataFrame:
    """Every date from start to end, both included."""
    span = (end - start).days + 1
    return spark.range(span).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias(name))


def steps(start: datetime, hours: int, step_seconds: int) -> Column:
    """Array of times from ``start`` over ``hours`` hours, both ends included."""
    stop = F.lit(start).cast("timestamp_ntz") + F.make_dt_interval(hours=F.lit(hours))
    step = F.make_dt_interval(secs=F.lit(step_seconds))
    return F.sequence(F.lit(start).cast("timestamp_ntz"), stop, step)


def densify(counts: DataFrame, group: str, slot: str, value: str, slots: Column, inside: Column) -> DataFrame:
    """Give every group a row for every element of ``slots``; gaps become zero.

    ``inside`` is the range of the slots as a plain predicate. Each group row is
    expanded in place, then zero rows and counts are summed together: one
    shuffle, no join of groups with the calendar. The counts are stored once,
    since both parts read them.
    """
    counts = once(counts, "counts")
    groups = counts.select(group).distinct()
    zero = groups.select(group, F.explode(slots).alias(slot), F.lit(0).cast("long").alias(value))
    kept = counts.where(inside).select(group, slot, F.col(value).cast("long"))
    return zero.unionByName(kept).groupBy(group, slot).agg(F.sum(value).alias(value))


def month_starts(start: Column, end: Column) -> Column:
    """Array of month starts whose month ends within [start, end]."""
    first = F.when(F.trunc(start, "MM") == start, start).otherwise(F.trunc(start, "MM")).cast("date")
    last = F.add_months(F.trunc(F.date_add(end, 1), "MM"), -1)
    months = F.sequence(first, last, F.expr("INTERVAL 1 MONTH"))
    return F.when(last >= first, months).otherwise(F.array().cast("array<date>"))


def windows_of(moment: Column, overlap: bool = False) -> Column:
    """Month starts of the search windows that contain a moment.

    Half-open months by default. With ``overlap`` a window is open at both ends
    and runs one day longer than its month, so a moment on the first day of a
    month also belongs to the month before.
    """
    own = F.trunc(moment, "MM")
    if not overlap:
        return F.array(own)
    previous = F.add_months(own, -1)
    candidates = F.array(own, previous)
    at = moment.cast("timestamp_ntz")
    return F.filter(
        candidates,
        lambda m: (at > m.cast("timestamp_ntz")) & (at < F.date_add(F.add_months(m, 1), 1).cast("timestamp_ntz")),
    )


# --- search windows ---------------------------------------------------------------------

# The words of the search syntax.
SEARCH_OR, SEARCH_AFTER, SEARCH_BEFORE = " OR ", " AND lastPublishDateTime:>", " AND lastPublishDateTime:<"


def search_windows(topics: DataFrame, start: date, end: date) -> DataFrame:
    """The searches that gather a topic's articles month by month.

    ``topics`` has ``topic``, its place ``topic_no`` and its ``terms``. A row per
    topic and month from ``start`` to ``end``: ``topic, topic_no, terms, month,
    opens, closes, search_query``. A window is open at both ends and reaches one day
    into the next month, so neighbours overlap; its query joins the terms by ``OR`` and
    names both bounds.
    """
    months = topics.withColumn("month", F.explode(month_starts(F.lit(start), F.lit(end))))
    opens, closes = F.col("month").cast("timestamp_ntz"), F.date_add(F.add_months("month", 1), 1).cast("timestamp_ntz")
    day = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    query = F.concat(F.array_join("terms", SEARCH_OR), F.lit(SEARCH_AFTER), day(opens), F.lit(SEARCH_BEFORE), day(closes))
    columns = ["topic", "topic_no", "terms", "month"]
    return months.select(*columns, opens.alias("opens"), closes.alias("closes"), query.alias("search_query"))


def found_by(articles: DataFrame, windows: DataFrame, moment: str = "moment", tokens: str = "tokens") -> DataFrame:
    """What the searches find: a row per window and article that holds one of its terms.

    A range join without an inequality join: an article's own month and both
    neighbours are equality keys, and the exact bounds are tested on the few
    windows that meet it. Terms meet tokens by equality too, so only articles
    with a term are joined to windows. ``articles`` has the key ``ft_id``, the
    ``moment`` and the distinct or repeated ``tokens``.
    """
    term = F.explode("terms").alias("_term")
    wanted = windows.select("topic", term).distinct()
    held = articles.select("ft_id", F.col(moment).cast("timestamp_ntz").alias("_at"), F.explode(F.array_distinct(tokens)).alias("_term"))
    about = held.join(wanted, "_term").select("ft_id", "_at", "topic").distinct()
    own = F.trunc(F.col("_at").cast("date"), "MM")
    near = F.explode(F.array(F.add_months(own, -1), own, F.add_months(own, 1))).alias("month")
    met = about.select("ft_id", "_at", "topic", near).join(windows.drop("terms"), ["topic", "month"])
    inside = (F.col("_at") > F.col("opens")) & (F.col("_at") < F.col("closes"))
    return met.where(inside).select("search_query", "topic", "topic_no", "month", "ft_id")


def first_search(found: DataFrame) -> DataFrame:
    """One row per article: that of its last topic, and there of the first month, as the results are stacked."""
    order = [-F.col("topic_no"), F.col("month"), F.col("search_query")]
    return first_per_key(found, ["ft_id"], order)
