"""Registered queries on time, with their SQL."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from commentlens.operators import series
from commentlens.operators.likes import friends_of, named_pairs, pair_counts
from commentlens.plans import activity as act
from commentlens.registry import views as v
from commentlens.registry.people import LIKES

ENTRIES: dict = {}


def entry(name: str, sql: str | None = None):
    def add(fn):
        ENTRIES[name] = (fn, sql)
        return fn

    return add


NAMES = ["Customer#000000001", "Customer#000000002", "Customer#000000003"]
NAME_SQL = v.sql_list(NAMES)
FIRST, LAST = date(2024, 1, 1), date(2024, 2, 11)
DAY = datetime(2024, 1, 5)
BASE = v.with_clause(v.COMMENTS, v.AUTHORS)
CHOSEN = f"""chosen AS (SELECT a.displayName AS author_name, c.* FROM comments c JOIN authors a ON c.authorId = a.author_id
  WHERE a.displayName IN ({NAME_SQL}))"""

entry(
    "t01_timeline",
    BASE + """SELECT a.displayName AS author_name, strftime(c.moment, '%Y-%m-%d %H:%M:%S') AS created_at,
      strftime(time_bucket(INTERVAL 5 MINUTE, c.moment), '%Y-%m-%d %H:%M:%S') AS date_time,
      strftime(c.moment, '%Y-%m-%d') AS date
    FROM comments c JOIN authors a ON c.authorId = a.author_id WHERE c.topic = 'click'""",
)(lambda s, d: act.timeline(v.comments(s, d), v.authors(s, d), topic="click").select(
    "author_name", v.moment_text("created_at").alias("created_at"), v.moment_text("date_time").alias("date_time"),
    v.day_text("date").alias("date"),
))

entry(
    "t02_dense_days",
    f"""WITH c AS (SELECT user_id AS authorId, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1, 2),
    s AS (SELECT authorId, CAST(unnest(generate_series(DATE '{FIRST}', DATE '{LAST}', INTERVAL 1 DAY)) AS DATE) AS day
          FROM (SELECT DISTINCT authorId FROM c))
    SELECT s.authorId, strftime(s.day, '%Y-%m-%d') AS date, coalesce(c.n, 0) AS n
    FROM s LEFT JOIN c ON s.authorId = c.authorId AND s.day = c.day""",
)(lambda s, d: _dense_days(s, d))


def _dense_days(s, d):
    day = v.table(s, d, "events").select(F.col("user_id").alias("authorId"), F.col("ts").cast("date").alias("date"))
    counts = day.groupBy("authorId", "date").agg(F.count(F.lit(1)).alias("n"))
    slots = F.sequence(F.lit(FIRST), F.lit(LAST), F.expr("INTERVAL 1 DAY"))
    dense = series.densify(counts, "authorId", "date", "n", slots, F.col("date").between(FIRST, LAST))
    return dense.select("authorId", v.day_text("date").alias("date"), "n")


WEEKS = (
    BASE
    + f""", {CHOSEN},
    d AS (SELECT author_name, CAST(unnest(generate_series(DATE '{FIRST}', DATE '{LAST}', INTERVAL 1 DAY)) AS DATE) AS day, 0 AS n
          FROM (SELECT DISTINCT author_name FROM chosen)
          UNION ALL SELECT author_name, CAST(moment AS DATE), 1 FROM chosen
          WHERE CAST(moment AS DATE) BETWEEN DATE '{FIRST}' AND DATE '{LAST}'),
    w AS (SELECT author_name, strftime(date_trunc('week', day), '%Y-%m-%d') AS week, CAST(sum(n) AS BIGINT) AS n FROM d GROUP BY 1, 2)"""
)
entry("t03_weekly_series", WEEKS + "SELECT author_name, week, n FROM w")(
    lambda s, d: act.weekly_series(v.comments(s, d), v.authors(s, d), NAMES, FIRST, LAST).select(
        "author_name", v.day_text("week").alias("week"), "n"
    )
)
entry(
    "q06_weekly_activity",
    WEEKS
    + "SELECT week, "
    + ", ".join(f"CAST(sum(CASE WHEN author_name = '{n}' THEN n END) AS BIGINT) AS \"{n}\"" for n in NAMES)
    + " FROM w GROUP BY 1",
)(lambda s, d: act.weekly_activity(v.comments(s, d), v.authors(s, d), NAMES, FIRST, LAST).withColumn("week", v.day_text("week")))

SLOTS = (
    BASE
    + f""", {CHOSEN},
    c AS (SELECT author_name, time_bucket(INTERVAL 5 MINUTE, moment) + INTERVAL 3 HOUR AS slot, count(*) AS n FROM chosen GROUP BY 1, 2),
    k AS (SELECT * FROM c WHERE slot BETWEEN TIMESTAMP '{DAY}' AND TIMESTAMP '{DAY}' + INTERVAL 24 HOUR),
    s AS (SELECT author_name, unnest(generate_series(TIMESTAMP '{DAY}', TIMESTAMP '{DAY}' + INTERVAL 24 HOUR, INTERVAL 5 MINUTE)) AS slot
          FROM (SELECT DISTINCT author_name FROM k))
    SELECT s.author_name, strftime(s.slot, '%Y-%m-%d %H:%M:%S') AS slot, coalesce(k.n, 0) AS n
    FROM s LEFT JOIN k ON s.author_name = k.author_name AND s.slot = k.slot"""
)
for name in ("t04_intraday_series", "q07_intraday_activity"):
    entry(name, SLOTS)(lambda s, d: act.intraday_series(v.comments(s, d), v.authors(s, d), NAMES, DAY).select(
        "author_name", v.moment_text("slot").alias("slot"), "n"
    ))

entry("q07_wide_intraday", SLOTS)(lambda s, d: _wide_slots(s, d))


def _wide_slots(s, d):
    """A column per active author, its columns read as rows again for the check."""
    wide = act.intraday_activity(v.comments(s, d), v.authors(s, d), NAMES, DAY)
    long = wide.unpivot(["slot"], [c for c in wide.columns if c != "slot"], "author_name", "n")
    return long.select("author_name", v.moment_text("slot").alias("slot"), "n")


FRIENDS = LIKES + f""", f AS (SELECT author_name, liker_name, like_count FROM by_name WHERE liker_name IN ({NAME_SQL})
    ORDER BY like_count DESC, liker_name, author_name LIMIT 20)"""
entry("t10_friends", FRIENDS + "SELECT author_name, liker_name, like_count FROM f")(
    lambda s, d: friends_of(_named(s, d), NAMES)
)


def _named(s, d):
    return named_pairs(pair_counts(v.edges(s, d)), v.authors(s, d))


COHORT = (
    FRIENDS
    + f""", {v.COMMENTS},
    d AS (SELECT CAST(unnest(generate_series(DATE '{FIRST}', DATE '{LAST}', INTERVAL 1 DAY)) AS DATE) AS day, 0 AS cohort, 0 AS others
      UNION ALL SELECT CAST(c.moment AS DATE), CASE WHEN a.displayName IN (SELECT author_name FROM f) THEN 1 ELSE 0 END,
        CASE WHEN a.displayName IN (SELECT author_name FROM f) THEN 0 ELSE 1 END
      FROM comments c JOIN authors a ON c.authorId = a.author_id WHERE CAST(c.moment AS DATE) BETWEEN DATE '{FIRST}' AND DATE '{LAST}')
    SELECT strftime(date_trunc('week', day), '%Y-%m-%d') AS week, CAST(sum(cohort) AS BIGINT) AS cohort, CAST(sum(others) AS BIGINT) AS others
    FROM d GROUP BY 1"""
)
for name in ("t11_friends_vs_all", "q08_cohort_vs_rest"):
    entry(name, COHORT)(lambda s, d: act.cohort_vs_rest(
        v.comments(s, d), v.authors(s, d), _named(s, d), NAMES, FIRST, LAST
    ).withColumn("week", v.day_text("week")))

PROFILE = """WITH t AS (SELECT user_id AS authorId, ts + INTERVAL 3 HOUR AS local FROM events)
  SELECT authorId, 'hour' AS kind, CAST(hour(local) AS BIGINT) AS bucket, count(*) AS n FROM t GROUP BY ALL
  UNION ALL SELECT authorId, 'dow', CAST(isodow(local) - 1 AS BIGINT), count(*) FROM t GROUP BY ALL"""
for name in ("a15_hour_and_weekday", "q09_activity_profile"):
    entry(name, PROFILE)(lambda s, d: act.profile(v.comments(s, d)).withColumn("bucket", F.col("bucket").cast("long")))

DAILY = BASE + """SELECT strftime(c.moment, '%Y-%m-%d') AS date, c.authorId, a.displayName, count(*) AS comments_count
  FROM comments c JOIN authors a ON c.authorId = a.author_id{0} GROUP BY 1, 2, 3"""
entry("t12_daily_counts", DAILY.format(""))(
    lambda s, d: act.daily_activity(v.comments(s, d), v.authors(s, d)).withColumn("date", v.day_text("date"))
)
entry("q10_daily_activity", DAILY.format(" WHERE c.authorId IN (1, 2, 3)"))(
    lambda s, d: act.daily_activity(v.comments(s, d), v.authors(s, d), [1, 2, 3]).withColumn("date", v.day_text("date"))
)
entry(
    "w03_coded_daily_activity",
    f"SELECT *, CAST(dense_rank() OVER (ORDER BY authorId) AS BIGINT) AS id_color FROM ({DAILY.format(' WHERE c.authorId IN (1, 2, 3)')})",
)(lambda s, d: act.daily_activity_coded(v.comments(s, d), v.authors(s, d), [1, 2, 3]).withColumn("date", v.day_text("date")))

MONTH = (
    BASE
    + """, z AS (SELECT *, moment AT TIME ZONE 'UTC' AT TIME ZONE 'CET' AS wall FROM comments),
    m AS (SELECT z.id, z.authorId, a.displayName, t.lang AS title, d.text AS bodyHtml, day(z.wall) AS monthday,
        '2019-01-01 ' || strftime(z.wall, '%H:%M:%S') AS clock_ts
      FROM z JOIN authors a ON z.authorId = a.author_id LEFT JOIN documents t ON z.ft_id = t.doc_id
        LEFT JOIN documents d ON z.id = d.doc_id
      WHERE year(z.wall) = 2024 AND month(z.wall) = 1{0})"""
)


def _month(s, d, ids):
    return act.month_view(v.comments(s, d), v.titles(s, d), v.authors(s, d), v.text_table(s, d), ids, 2024, 1)


def _flat(view):
    return view.withColumn("clock_ts", v.moment_text("clock_ts")).withColumn("monthday", F.col("monthday").cast("long"))


entry("q11_month_view", MONTH.format(" AND z.authorId IN (1, 2, 3)") + "SELECT * FROM m")(lambda s, d: _flat(_month(s, d, [1, 2, 3])))
entry("t13_month_view_all", MONTH.format("") + "SELECT * FROM m")(lambda s, d: _flat(_month(s, d, None)))
entry("t14_month_point", MONTH.format("") + "SELECT id, bodyHtml FROM m WHERE monthday = 1 AND clock_ts = '2019-01-01 01:00:07'")(
    lambda s, d: act.month_point(_month(s, d, None), 1, datetime(2019, 1, 1, 1, 0, 7))
)
entry(
    "t15_month_starts",
    """WITH b AS (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS z FROM orders GROUP BY 1),
    m AS (SELECT o_custkey, a, z, CAST(unnest(generate_series(date_trunc('month', a), date_trunc('month', z), INTERVAL 1 MONTH)) AS DATE) AS month FROM b)
    SELECT o_custkey, strftime(month, '%Y-%m-%d') AS month FROM m WHERE last_day(month) BETWEEN a AND z""",
)(lambda s, d: _month_starts(s, d))


def _month_starts(s, d):
    day = F.col("o_orderdate").cast("date")
    span = v.table(s, d, "orders").groupBy("o_custkey").agg(F.min(day).alias("a"), F.max(day).alias("z"))
    months = series.month_starts(F.col("a"), F.col("z"))
    return span.select("o_custkey", F.explode(months).alias("month")).withColumn("month", v.day_text("month"))


WINDOWS = """WITH w AS (SELECT CAST(unnest(generate_series(TIMESTAMP '1994-12-01', TIMESTAMP '2001-12-01', INTERVAL 1 MONTH)) AS DATE) AS month)
  SELECT o.o_orderkey, strftime(w.month, '%Y-%m-%d') AS month, 'a OR b' AS terms FROM orders o JOIN w
  ON {0}"""
def _terms():
    return F.array_join(F.array(F.lit("a"), F.lit("b")), " OR ")


def _windows(s, d, overlap):
    months = series.windows_of(F.col("o_orderdate"), overlap)
    rows = v.table(s, d, "orders").select("o_orderkey", F.explode(months).alias("month"), _terms().alias("terms"))
    return rows.withColumn("month", v.day_text("month"))


entry("t16_search_windows", WINDOWS.format("o.o_orderdate >= w.month AND o.o_orderdate < w.month + INTERVAL 1 MONTH"))(
    lambda s, d: _windows(s, d, False)
)
entry("t16_overlapping_windows", WINDOWS.format("o.o_orderdate > w.month AND o.o_orderdate < w.month + INTERVAL 1 MONTH + INTERVAL 1 DAY"))(
    lambda s, d: _windows(s, d, True)
)
entry(
    "t17_year_slices",
    "SELECT year(o_orderdate) AS year, o_custkey, count(*) AS n FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 2000 GROUP BY 1, 2",
)(lambda s, d: _year_slices(s, d))


def _year_slices(s, d):
    from commentlens.functions import clock

    rows = v.table(s, d, "orders").select("o_custkey", v.seconds("o_orderdate").alias("createdAt"))
    kept = rows.where(clock.in_years("createdAt", [1996, 1997, 1998, 1999, 2000]))
    year = F.year(clock.wall_clock("createdAt")).cast("long").alias("year")
    return kept.groupBy(year, "o_custkey").agg(F.count(F.lit(1)).alias("n"))


# Topics with their terms, as a user sets them up; the last topic is searched last and wins.
TOPICS = [("articles", 0, ["the", "der", "la"]), ("links", 1, ["and", "und"]), ("all", 2, ["que", "et", "of", "y"])]
FOUND = (
    "WITH topics(topic, topic_no, terms) AS (VALUES "
    + ", ".join(f"('{t}', {no}, [{v.sql_list(terms)}])" for t, no, terms in TOPICS)
    + f"""),
  months AS (SELECT CAST(unnest(generate_series(DATE '2014-01-01', DATE '2018-12-01', INTERVAL 1 MONTH)) AS DATE) AS month),
  w AS (SELECT topic, topic_no, terms, month, month + INTERVAL 1 MONTH + INTERVAL 1 DAY AS closes FROM topics, months),
  q AS (SELECT *, array_to_string(terms, ' OR ') || ' AND lastPublishDateTime:>' || strftime(month, '%Y-%m-%dT%H:%M:%SZ')
      || ' AND lastPublishDateTime:<' || strftime(closes, '%Y-%m-%dT%H:%M:%SZ') AS search_query FROM w),
  a AS (SELECT doc_id AS ft_id, {v.SQL_SPLIT.format('text')} AS toks,
      TIMESTAMP '2014-01-01' + INTERVAL 1 DAY * ((doc_id * 97) % 1826) + INTERVAL 12 HOUR * (doc_id % 2) AS moment FROM documents),
  f AS (SELECT search_query, topic, topic_no, month, ft_id FROM q JOIN a
    ON moment > month AND moment < closes AND list_has_any(toks, terms))
"""
)


def _found(s, d):
    """Documents as articles; half of them appear at midnight, some on the first of a month."""
    from datetime import date

    from commentlens.functions import text as words

    topics = s.createDataFrame(TOPICS, "topic STRING, topic_no INT, terms ARRAY<STRING>")
    day = F.pmod(F.col("doc_id") * 97, F.lit(1826)).cast("int")
    moment = F.lit(date(2014, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(days=day, hours=(F.col("doc_id") % 2 * 12).cast("int"))
    articles = v.wide_table(s, d, "documents").select(
        F.col("doc_id").alias("ft_id"), moment.alias("moment"), words.split_words("text").alias("tokens")
    )
    return series.found_by(articles, series.search_windows(topics, date(2014, 1, 1), date(2018, 12, 31)))


entry("t16_found_by_searches", FOUND + "SELECT search_query, topic, CAST(month AS VARCHAR) AS month, ft_id FROM f")(
    lambda s, d: _found(s, d).select("search_query", "topic", F.col("month").cast("string").alias("month"), "ft_id")
)
entry(
    "t16_first_search",
    FOUND + "SELECT ft_id, search_query FROM f QUALIFY row_number() OVER (PARTITION BY ft_id ORDER BY topic_no DESC, month) = 1",
)(lambda s, d: series.first_search(_found(s, d)).select("ft_id", "search_query"))
