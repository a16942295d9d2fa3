"""Questions about time: weeks, days, five-minute steps, profiles, month views."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commentlens.functions import clock
from commentlens.operators.aggregate import activity_profile, count_by
from commentlens.operators.joins import with_names
from commentlens.operators.likes import friends_of
from commentlens.operators.numbering import with_dense_code
from commentlens.operators.series import densify, steps


def timeline(
    comments: DataFrame, authors: DataFrame, names: list[str] | None = None, topic: str | None = None, zone: str = "UTC"
) -> DataFrame:
    """Comments with author name, five-minute slot and date."""
    rows = comments if topic is None else comments.where(F.col("topic") == topic)
    known = authors if names is None else authors.where(F.col("displayName").isin(names))
    named = with_names(rows, known, name="author_name")
    at = clock.wall_clock("createdAt", zone)
    return named.select(
        "author_name",
        at.alias("created_at"),
        clock.wall_clock(clock.floor_seconds("createdAt", 300), zone).alias("date_time"),
        at.cast("date").alias("date"),
    )


def _between(start: date, end: date, zone: str) -> Column:
    """Range of whole days as a plain filter on the stored number."""
    first = clock.epoch_of(datetime.combine(start, datetime.min.time()), zone)
    last = clock.epoch_of(datetime.combine(end + timedelta(days=1), datetime.min.time()), zone)
    return clock.in_range("createdAt", first, last)


def weekly_series(comments: DataFrame, authors: DataFrame, names: list[str], start: date, end: date, zone: str = "UTC") -> DataFrame:
    """Rows ``(author_name, week, n)`` for every week of the range.

    Days without comments count as zero; authors without any comment are absent,
    which the whole history decides, so the range applies after the daily counts.
    """
    known = authors.where(F.col("displayName").isin(names))
    chosen = with_names(comments, known, name="author_name")
    day = clock.wall_clock("createdAt", zone).cast("date").alias("date")
    daily = chosen.groupBy("author_name", day).agg(F.count(F.lit(1)).alias("n"))
    slots = F.sequence(F.lit(start), F.lit(end), F.expr("INTERVAL 1 DAY"))
    dense = densify(daily, "author_name", "date", "n", slots, F.col("date").between(start, end))
    return dense.groupBy("author_name", clock.week_start("date").alias("week")).agg(F.sum("n").alias("n"))


def weekly_activity(comments: DataFrame, authors: DataFrame, names: list[str], start: date, end: date, zone: str = "UTC") -> DataFrame:
    """Weekly comment counts, one column per listed author."""
    series = weekly_series(comments, authors, names, start, end, zone)
    return series.groupBy("week").pivot("author_name", sorted(set(names))).agg(F.sum("n")).orderBy("week")


def intraday_series(
    comments: DataFrame,
    authors: DataFrame,
    names: list[str],
    start: datetime,
    hours: int = 24,
    step_seconds: int = 300,
    offset_hours: int = 3,
) -> DataFrame:
    """Rows ``(author_name, slot, n)`` for every step of the range, both ends included.

    Times are floored first and moved afterwards. Only authors with at least
    one comment in the range appear, so the counts themselves say who is there.
    """
    base = clock.epoch_of(start) - 3600 * offset_hours
    if base % step_seconds:
        raise ValueError(f"start must lie on a step of {step_seconds} seconds, as times are floored to such steps")
    inside = clock.in_range("createdAt", base, base + 3600 * hours + step_seconds)
    known = authors.where(F.col("displayName").isin(names))
    slot = clock.wall_clock(clock.floor_seconds("createdAt", step_seconds), offset_hours=offset_hours)
    counted = (
        with_names(comments.where(inside), known, name="author_name")
        .groupBy("author_name", slot.alias("slot"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return densify(counted, "author_name", "slot", "n", steps(start, hours, step_seconds), F.lit(True))


def intraday_activity(comments: DataFrame, authors: DataFrame, names: list[str], start: datetime, **options) -> DataFrame:
    """Counts per step, one column per active author (runs a job to find the active ones among ``names``)."""
    series = intraday_series(comments, authors, names, start, **options)
    active = [r[0] for r in series.select("author_name").distinct().orderBy("author_name").collect()]
    return series.groupBy("slot").pivot("author_name", active).agg(F.sum("n")).orderBy("slot")


def cohort_vs_rest(
    comments: DataFrame,
    authors: DataFrame,
    named_pairs: DataFrame,
    likers: list[str],
    start: date,
    end: date,
    n_friends: int = 20,
    zone: str = "UTC",
) -> DataFrame:
    """Weekly comments of the likers' friends against everyone else.

    Comments are counted per author and day before any join; the friend list
    has at most ``n_friends`` rows, so it is safe to broadcast.
    """
    friends = friends_of(named_pairs, likers, n_friends).select(F.col("author_name").alias("_friend")).distinct()
    day = clock.wall_clock("createdAt", zone).cast("date")
    daily = comments.where(_between(start, end, zone)).groupBy("authorId", day.alias("date")).agg(F.count(F.lit(1)).alias("n"))
    named = with_names(daily, authors, name="author_name")
    flagged = named.join(F.broadcast(friends), F.col("author_name") == F.col("_friend"), "left")
    is_friend = F.col("_friend").isNotNull()
    counted = flagged.groupBy(clock.week_start("date").alias("week")).agg(
        F.sum(F.when(is_friend, F.col("n")).otherwise(0)).alias("cohort"),
        F.sum(F.when(is_friend, 0).otherwise(F.col("n"))).alias("others"),
    )
    first = start - timedelta(days=start.weekday())
    weeks = (end - first).days // 7 + 1
    spine = comments.sparkSession.range(weeks).select(
        F.date_add(F.lit(first), (F.col("id") * 7).cast("int")).alias("week"),
        F.lit(0).cast("long").alias("cohort"),
        F.lit(0).cast("long").alias("others"),
    )
    both = spine.unionByName(counted).groupBy("week")
    return both.agg(F.sum("cohort").alias("cohort"), F.sum("others").alias("others")).orderBy("week")


def profile(comments: DataFrame, zone: str = "UTC", offset_hours: int = 3) -> DataFrame:
    """Hour-of-day and weekday profile of every author."""
    return activity_profile(comments, zone, offset_hours)


def daily_activity(comments: DataFrame, authors: DataFrame, author_ids: list | None = None, zone: str = "UTC") -> DataFrame:
    """Comments per author and day, with names; all authors without a list."""
    rows = comments if author_ids is None else comments.where(F.col("authorId").isin(author_ids))
    day = clock.wall_clock("createdAt", zone).cast("date").alias("date")
    counts = rows.groupBy(day, "authorId").agg(F.count(F.lit(1)).alias("comments_count"))
    return with_names(counts, authors).select("date", "authorId", "displayName", "comments_count")


def daily_activity_coded(comments: DataFrame, authors: DataFrame, author_ids: list, zone: str = "UTC") -> DataFrame:
    """Daily activity with an integer code per author, for colours and panels (runs a job)."""
    return with_dense_code(daily_activity(comments, authors, author_ids, zone), "authorId", "id_color")


def month_view(
    comments: DataFrame,
    titles: DataFrame,
    authors: DataFrame,
    text: DataFrame,
    author_ids: list | None,
    year: int,
    month: int,
    zone: str = "CET",
) -> DataFrame:
    """Comments of one month with title, name, text, and the clock time on one reference day.

    The month is a range on the stored number, so files outside it are skipped.
    """
    rows = comments.where(clock.in_month("createdAt", year, month, zone))
    if author_ids is not None:
        rows = rows.where(F.col("authorId").isin(author_ids))
    at = clock.wall_clock("createdAt", zone)
    timed = rows.withColumn("monthday", F.dayofmonth(at)).withColumn("clock_ts", clock.on_reference_day(at))
    named = with_names(timed, authors)
    titled = named.join(titles.select("ft_id", "title"), "ft_id", "left")
    return titled.join(text.select("id", "bodyHtml"), "id", "left").select(
        "id", "authorId", "displayName", "title", "bodyHtml", "monthday", "clock_ts"
    )


def month_point(view: DataFrame, monthday: int, clock_ts: datetime) -> DataFrame:
    """Texts behind one point of the month view."""
    at = F.col("clock_ts") == F.lit(clock_ts).cast("timestamp_ntz")
    return view.where((F.col("monthday") == monthday) & at).select("id", "bodyHtml")


def author_days(comments: DataFrame, author_id, zone: str = "UTC") -> DataFrame:
    """Comments of one author per day, busiest first."""
    day = clock.wall_clock("createdAt", zone).cast("date").alias("date")
    rows = comments.where(F.col("authorId") == author_id).select(day)
    return count_by(rows, ["date"]).orderBy(F.desc("n"), "date")
