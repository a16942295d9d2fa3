"""Registered queries on column functions, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from commentlens.functions import clock, links
from commentlens.functions import text as words
from commentlens.functions.stem import dictionary, dictionary_sql
from commentlens.functions.stopwords import NLTK_ENGLISH, SNOWBALL_ENGLISH, stopword_table
from commentlens.operators import joins as jn
from commentlens.operators import terms
from commentlens.operators.threads import root_id
from commentlens.registry import views as v

ENTRIES: dict = {}


def entry(name: str, sql: str | None = None):
    def add(fn):
        ENTRIES[name] = (fn, sql)
        return fn

    return add


def long(c):
    return c.cast("long")


entry("f01_rename_reorder", "SELECT c_name AS displayName, c_custkey AS author_id FROM customer")(
    lambda s, d: v.authors(s, d).select("displayName", "author_id")
)
entry(
    "f02_equality_filter",
    "SELECT event_id AS id FROM events WHERE event_type = 'click' AND user_id = 3",
)(lambda s, d: v.comments(s, d).where((F.col("topic") == "click") & (F.col("authorId") == 3)).select("id"))
entry(
    "f03_membership",
    "SELECT event_id AS id, user_id IN (1, 2, 3) AS chosen FROM events WHERE event_type NOT IN ('error')",
)(lambda s, d: v.comments(s, d).where(~F.col("topic").isin(["error"])).select("id", F.col("authorId").isin([1, 2, 3]).alias("chosen")))
entry(
    "f04_null_filters",
    "SELECT d.doc_id FROM documents d LEFT JOIN labels l USING (doc_id) WHERE l.quality IS NOT NULL AND l.toxic IS NOT NULL",
)(lambda s, d: v.table(s, d, "documents").select("doc_id").join(v.table(s, d, "labels"), "doc_id", "left").na.drop("any").select("doc_id"))
entry(
    "f05_null_replacement",
    """SELECT d.doc_id, CAST(coalesce(l.quality, -1) AS BIGINT) AS quality, coalesce(CAST(l.toxic AS VARCHAR), '') AS toxic
    FROM documents d LEFT JOIN labels l USING (doc_id)""",
)(lambda s, d: v.table(s, d, "documents").select("doc_id").join(v.table(s, d, "labels"), "doc_id", "left").select(
    "doc_id",
    F.coalesce(long(F.col("quality")), F.lit(-1)).alias("quality"),
    F.coalesce(F.col("toxic").cast("string"), F.lit("")).alias("toxic"),
))
entry(
    "f07_root_id",
    v.with_clause(v.THREADS) + "SELECT id, CASE WHEN ancestorId = -1 THEN id ELSE ancestorId END AS root_id FROM threads",
)(lambda s, d: v.threads(s, d).select("id", root_id().alias("root_id")))
ZONES = """SELECT event_id AS id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS utc,
  strftime(ts AT TIME ZONE 'UTC' AT TIME ZONE 'CET', '%Y-%m-%d %H:%M:%S') AS cet FROM events"""
entry("f08_clocks", ZONES)(lambda s, d: v.comments(s, d).select(
    "id",
    v.moment_text(clock.wall_clock("createdAt")).alias("utc"),
    v.moment_text(clock.wall_clock("createdAt", "CET")).alias("cet"),
))
entry(
    "f09_calendar_parts",
    """SELECT event_id AS id, year(ts) AS year, month(ts) AS month, day(ts) AS monthday, hour(ts) AS hour,
      strftime(ts, '%H:%M:%S') AS hms, isodow(ts) - 1 AS monday0, dayofweek(ts) AS sunday0,
      strftime(ts, '%a') AS label, strftime(ts, '%Y-%m-%d') AS date FROM events""",
)(lambda s, d: _parts(s, d))


def _parts(s, d):
    at = clock.wall_clock("createdAt")
    return v.comments(s, d).select(
        "id",
        long(F.year(at)).alias("year"),
        long(F.month(at)).alias("month"),
        long(F.dayofmonth(at)).alias("monthday"),
        long(F.hour(at)).alias("hour"),
        clock.time_of_day(at).alias("hms"),
        long(clock.weekday_monday0(at)).alias("monday0"),
        long(clock.weekday_sunday0(at)).alias("sunday0"),
        clock.weekday_label(at).alias("label"),
        v.day_text(at).alias("date"),
    )


entry(
    "f10_fixed_offsets",
    """SELECT event_id AS id, strftime(ts + INTERVAL 3 HOUR, '%Y-%m-%d %H:%M:%S') AS plus3,
      strftime(ts + INTERVAL 15 HOUR, '%Y-%m-%d %H:%M:%S') AS plus15 FROM events""",
)(lambda s, d: v.comments(s, d).select(
    "id",
    v.moment_text(clock.wall_clock("createdAt", offset_hours=3)).alias("plus3"),
    v.moment_text(clock.wall_clock("createdAt", offset_hours=15)).alias("plus15"),
))
entry(
    "f11_five_minute_floor",
    "SELECT event_id AS id, strftime(time_bucket(INTERVAL 5 MINUTE, ts), '%Y-%m-%d %H:%M:%S') AS slot FROM events",
)(lambda s, d: v.comments(s, d).select("id", v.moment_text(clock.wall_clock(clock.floor_seconds("createdAt"))).alias("slot")))
entry(
    "f12_week_start",
    "SELECT o_orderkey, strftime(date_trunc('week', o_orderdate), '%Y-%m-%d') AS week FROM orders",
)(lambda s, d: v.table(s, d, "orders").select("o_orderkey", v.day_text(clock.week_start("o_orderdate")).alias("week")))
entry(
    "f13_reference_day",
    "SELECT event_id AS id, '2019-01-01 ' || strftime(ts, '%H:%M:%S') AS clock_ts FROM events",
)(lambda s, d: v.comments(s, d).select("id", v.moment_text(clock.on_reference_day(clock.wall_clock("createdAt"))).alias("clock_ts")))
entry(
    "f14_strip_tags",
    r"""SELECT page_id, md5(regexp_replace(html, '<[^\n]*?>', '', 'g')) AS cleaned,
      md5(regexp_replace(html, '<[^>]*>', '', 'g')) AS stripped FROM pages""",
)(lambda s, d: v.wide_table(s, d, "pages").select(
    "page_id", F.md5(words.strip_tags("html")).alias("cleaned"), F.md5(words.strip_markup("html")).alias("stripped")
))
entry("f15_normalise", f"SELECT page_id, {v.SQL_NORMAL.format('html')} AS text FROM pages")(
    lambda s, d: v.wide_table(s, d, "pages").select("page_id", words.normalise("html").alias("text"))
)
entry(
    "f16_blank_tokens",
    r"""SELECT doc_id, array_to_string(list_filter(string_split_regex(text, '[ \t\n\f\r\v]+'), lambda x: x <> ''), '|') AS tokens
    FROM documents""",
)(lambda s, d: v.wide_table(s, d, "documents").select("doc_id", F.array_join(words.split_blanks("text"), "|").alias("tokens")))
entry(
    "f17_alphabetic_words",
    f"""SELECT doc_id, array_to_string(list_filter({v.SQL_SPLIT.format('text')},
      lambda x: regexp_full_match(x, '\\p{{L}}+') AND length(x) > 3), '|') AS words FROM documents""",
)(lambda s, d: v.wide_table(s, d, "documents").select("doc_id", F.array_join(words.alphabetic_words("text"), "|").alias("words")))
entry("f18_digits_and_handles", f"SELECT doc_id, {v.SQL_HANDLES.format('text')} AS text FROM documents")(
    lambda s, d: v.wide_table(s, d, "documents").select("doc_id", words.drop_digits_and_handles("text").alias("text"))
)
TM_STOP = ["the", "and", *SNOWBALL_ENGLISH]
SQL_CORPUS = (
    r"list_filter(string_split_regex(regexp_replace(regexp_replace(lower({0}), '[0-9]+', '', 'g'), "
    r"'[!-/:-@\[-`{{-~]+', '', 'g'), '\s+'), lambda x: x <> '' AND x NOT IN ({1}))"
)
entry(
    "f19_corpus_clean",
    f"SELECT doc_id, array_to_string({SQL_CORPUS.format('text', v.sql_list(TM_STOP))}, ' ') AS text FROM documents",
)(lambda s, d: v.wide_table(s, d, "documents").select("doc_id", words.corpus_clean("text", TM_STOP).alias("text")))
entry("f20_length", "SELECT doc_id, CAST(length(text) AS BIGINT) AS chars FROM documents")(
    lambda s, d: v.table(s, d, "documents").select("doc_id", long(F.length("text")).alias("chars"))
)
entry(
    "f21_article_id_rules",
    r"""SELECT page_id, nullif(regexp_extract(url, '/([^\n]*?)[?#]', 1), '') AS rule_a,
      string_split(string_split(url, '/')[-1], '.')[1] AS rule_b FROM pages""",
)(lambda s, d: v.table(s, d, "pages").select(
    "page_id", links.id_between_slash_and_query("url").alias("rule_a"), links.id_from_last_segment("url").alias("rule_b")
))
entry(
    "f22_short_collection_id",
    """SELECT page_id, array_to_string(list_slice(string_split(url || '/a/b/c/d', '/'), 6, 7), '/') AS short_id FROM pages""",
)(lambda s, d: v.table(s, d, "pages").select(
    "page_id", links.short_collection_id(F.concat("url", F.lit("/a/b/c/d"))).alias("short_id")
))
entry(
    "f23_id_from_href",
    r"""WITH h AS (SELECT page_id, '/content/' || md5(url) || CASE WHEN page_id % 2 = 0 THEN '/' ELSE '' END AS href FROM pages)
    SELECT page_id, regexp_replace(href, '^/content/|/$', '', 'g') AS id, trim(href, '/conte') AS trimmed FROM h""",
)(lambda s, d: v.table(s, d, "pages").select(
    "page_id",
    F.concat(F.lit("/content/"), F.md5("url"), F.when(F.col("page_id") % 2 == 0, "/").otherwise("")).alias("href"),
).select("page_id", links.id_from_href("href").alias("id"), links.id_from_href("href", True).alias("trimmed")))
entry(
    "f24_rewrite_url",
    "SELECT page_id, replace(replace(url, 'https', 'http'), 'example', 'data.example') AS source_url FROM pages",
)(lambda s, d: v.table(s, d, "pages").select(
    "page_id", links.rewrite("url", [("https", "http"), ("example", "data.example")]).alias("source_url")
))
entry(
    "f25_collection_id",
    "SELECT page_id, translate(base64(encode(url)), '+/=', '-_.') AS collection_id FROM pages",
)(lambda s, d: v.table(s, d, "pages").select("page_id", links.collection_id("url").alias("collection_id")))
entry("f26_constant_columns", "SELECT doc_id, 'all' AS topic, CAST(2018 AS BIGINT) AS year FROM documents")(
    lambda s, d: v.table(s, d, "documents").select("doc_id", F.lit("all").alias("topic"), F.lit(2018).cast("long").alias("year"))
)
entry(
    "f27_casts",
    "SELECT CAST(o_orderkey AS VARCHAR) AS key, CAST(floor(o_totalprice) AS BIGINT) AS price, TRY_CAST(o_orderpriority AS BIGINT) AS level FROM orders",
)(lambda s, d: v.table(s, d, "orders").select(
    F.col("o_orderkey").cast("string").alias("key"),
    F.floor("o_totalprice").cast("long").alias("price"),
    F.col("o_orderpriority").try_cast("long").alias("level"),
))
entry("f28_text_stays_utf8", "SELECT doc_id, md5(text) AS digest, octet_length(encode(text)) AS bytes FROM documents")(
    lambda s, d: v.table(s, d, "documents").select("doc_id", F.md5("text").alias("digest"), long(F.octet_length("text")).alias("bytes"))
)
entry(
    "f29_composite_key",
    """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2""",
)(lambda s, d: v.table(s, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n")))

# --- stems and stop lists ------------------------------------------------------------

TOKENS_SQL = f"src AS (SELECT doc_id, unnest({v.SQL_SPLIT.format('text')}) AS w, generate_subscripts({v.SQL_SPLIT.format('text')}, 1) AS i FROM documents)"


def _stems_sql(rules):
    return f"WITH {TOKENS_SQL},\n{dictionary_sql('src', rules)}\n"


for rules in ("porter", "english"):
    entry(f"x01_{rules}_stems", _stems_sql(rules) + "SELECT w AS word, stem FROM dict")(
        lambda s, d, rules=rules: dictionary(
            terms.one_word_per_row(v.texts(s, d), words.split_words("bodyHtml"), []), rules
        )
    )
entry(
    "x01_stem_in_place",
    _stems_sql("porter") + """SELECT d.doc_id, coalesce(stems, '') AS stems FROM documents d
    LEFT JOIN (SELECT doc_id, string_agg(stem, ' ' ORDER BY i) AS stems FROM src JOIN dict USING (w) GROUP BY 1) x USING (doc_id)""",
)(lambda s, d: terms.stem_lists(
    v.wide_table(s, d, "documents").select("doc_id", words.split_words("text").alias("stems")), "stems", "porter"
).select("doc_id", F.array_join("stems", " ").alias("stems")))

NLTK_SQL = v.sql_list(NLTK_ENGLISH)
entry(
    "x02_stopword_share",
    f"""SELECT doc_id, CAST(len(list_filter({v.SQL_SPLIT.format('text')}, lambda x: x IN ({NLTK_SQL}))) AS BIGINT) AS stop_tokens
    FROM documents""",
)(lambda s, d: v.wide_table(s, d, "documents").select(
    "doc_id", long(F.size(F.filter(words.split_words("text"), lambda w: w.isin(NLTK_ENGLISH)))).alias("stop_tokens")
))
entry(
    "x02_stoplist_anti_join",
    f"""SELECT source AS authorId, word, count(*) AS n
    FROM (SELECT source, unnest({v.SQL_SPLIT.format('text')}) AS word FROM documents)
    WHERE word NOT IN ({NLTK_SQL}) GROUP BY 1, 2""",
)(lambda s, d: terms.drop_words(
    terms.word_counts(v.texts(s, d), "authorId", words.split_words("bodyHtml")),
    stopword_table(s).where(F.col("list") == "nltk"),
).select("authorId", "word", "n"))
entry(
    "f06_regex_filter",
    r"SELECT page_id FROM pages WHERE regexp_matches(url, '[?#]')",
)(lambda s, d: v.table(s, d, "pages").where(jn.null_safe(F.col("url").rlike("[?#]"))).select("page_id"))
