"""Registered queries on people, likes and threads, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from commentlens.operators import aggregate as ag
from commentlens.operators import joins as jn
from commentlens.operators import likes as lk
from commentlens.operators import numbering as nb
from commentlens.operators import ranking as rk
from commentlens.operators import reshape as rs
from commentlens.operators import threads as th
from commentlens.operators.dedupe import first_per_key
from commentlens.plans import people
from commentlens.registry import views as v

ENTRIES: dict = {}


def entry(name: str, sql: str | None = None):
    def add(fn):
        ENTRIES[name] = (fn, sql)
        return fn

    return add


def _pairs(s, d):
    return lk.pair_counts(v.edges(s, d))


def _named(s, d):
    return lk.named_pairs(_pairs(s, d), v.authors(s, d))


LIKES = v.with_clause(v.EDGES, v.PAIRS, v.AUTHORS, v.NAMED, v.BY_NAME)
MATRIX_LIMIT = 2

entry(
    "q01_top_authors",
    v.with_clause(v.COMMENTS, v.AUTHORS)
    + """, c AS (SELECT authorId, count(*) AS n FROM comments WHERE authorId IS NOT NULL GROUP BY 1),
    r AS (SELECT *, rank() OVER (ORDER BY n DESC) AS k FROM c)
    SELECT r.authorId, a.displayName, r.n AS total_comments
    FROM r JOIN authors a ON r.authorId = a.author_id WHERE k <= 20 AND a.displayName IS NOT NULL""",
)(lambda s, d: people.top_authors(v.comments(s, d), v.authors(s, d), 20))

entry(
    "q01_all_authors",
    v.with_clause(v.COMMENTS, v.AUTHORS)
    + """SELECT c.authorId, a.displayName, count(*) AS total_comments
    FROM comments c LEFT JOIN authors a ON c.authorId = a.author_id WHERE c.authorId IS NOT NULL GROUP BY 1, 2""",
)(lambda s, d: people.top_authors(v.comments(s, d), v.authors(s, d), keep_unnamed=True))

for side in ("author", "liker"):
    entry(
        f"q02_top_{side}s_by_likes",
        LIKES
        + f"""SELECT {side}_name AS name, CAST(sum(like_count) AS BIGINT) AS like_count FROM named
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""",
    )(lambda s, d, side=side: people.like_totals(_named(s, d), side, 20))

entry(
    "q03_likers_of_author",
    v.with_clause(v.EDGES, v.PAIRS, v.AUTHORS)
    + """, n AS (SELECT a.displayName, p.like_count AS likes_count
      FROM pairs p JOIN authors a ON p.liker_id = a.author_id WHERE p.author_id IN (1, 2)),
    r AS (SELECT *, rank() OVER (ORDER BY likes_count DESC) AS k FROM n)
    SELECT displayName, likes_count FROM r WHERE k <= 20""",
)(lambda s, d: people.likers_of(_pairs(s, d), v.authors(s, d), [1, 2], 20))

MATRIX = (
    LIKES
    + f""", grid AS (SELECT * FROM by_name WHERE like_count > {MATRIX_LIMIT}),
    c AS (SELECT DISTINCT liker_name, dense_rank() OVER (ORDER BY liker_name) AS column_no FROM grid)
    SELECT g.author_name, g.liker_name, CAST(c.column_no AS BIGINT) AS column_no, g.like_count
    FROM grid g JOIN c ON g.liker_name = c.liker_name
    WHERE c.column_no <= (SELECT count(DISTINCT author_name) FROM grid)"""
)
# The wide matrix, its columns read as rows again for the check.
entry("q04_wide_matrix", f"SELECT author_name, liker_name, like_count FROM ({MATRIX})")(lambda s, d: _wide_matrix(s, d))


def _wide_matrix(s, d):
    wide = lk.like_matrix(lk.pairs_by_name(_named(s, d)), MATRIX_LIMIT)
    return rs.unpivot(wide, ["author_name"], [c for c in wide.columns if c != "author_name"], "liker_name", "like_count")


entry("q04_like_matrix", MATRIX)(
    lambda s, d: lk.like_matrix_cells(lk.pairs_by_name(_named(s, d)), MATRIX_LIMIT)
)

PARTNERS = (
    v.with_clause(v.THREADS, v.AUTHORS)
    + """, t AS (SELECT CASE WHEN ancestorId = -1 THEN id ELSE ancestorId END AS root_id, authorId FROM threads),
    j AS (SELECT o.authorId, o.root_id FROM t o JOIN t m ON o.root_id = m.root_id
          WHERE m.authorId = 1 AND o.authorId <> 1),
    g AS (SELECT authorId, count(*) AS total_interactions FROM j GROUP BY 1)"""
)
entry(
    "q05_thread_partners",
    PARTNERS
    + """, r AS (SELECT *, rank() OVER (ORDER BY total_interactions DESC) AS k FROM g)
    SELECT a.displayName, r.total_interactions FROM r JOIN authors a ON r.authorId = a.author_id WHERE k <= 20""",
)(lambda s, d: people.thread_partners(v.threads(s, d), v.authors(s, d), 1, 20))

entry("j08_thread_interactions", PARTNERS + "SELECT authorId, total_interactions FROM g")(
    lambda s, d: th.interactions_with(th.thread_rows(v.threads(s, d)), 1)
)

entry(
    "q18_author_days",
    v.with_clause(v.COMMENTS)
    + "SELECT CAST(CAST(moment AS DATE) AS VARCHAR) AS date, count(*) AS n FROM comments WHERE authorId = 1 GROUP BY 1",
)(lambda s, d: _days(s, d))


def _days(s, d):
    from commentlens.plans.activity import author_days

    return author_days(v.comments(s, d), 1).select(v.day_text("date").alias("date"), "n")


ORPHANS = """SELECT d.doc_id AS ft_id, d.source AS authorId FROM documents d
  WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality IS NOT NULL)"""


def _documents_as_comments(s, d):
    return v.table(s, d, "documents").select(F.col("doc_id").alias("ft_id"), F.col("source").alias("authorId"))


def _labels_as_titles(s, d):
    return v.table(s, d, "labels").select(F.col("doc_id").alias("ft_id"), F.col("quality").cast("string").alias("title"))


entry("q19_untitled_comments", ORPHANS)(lambda s, d: people.untitled(_documents_as_comments(s, d), _labels_as_titles(s, d)))
entry(
    "j09_left_join_null_title",
    """SELECT d.doc_id AS ft_id, d.source AS authorId, CAST(l.quality AS VARCHAR) AS title
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NULL""",
)(lambda s, d: _documents_as_comments(s, d).join(_labels_as_titles(s, d), "ft_id", "left").where(F.col("title").isNull()))

entry(
    "q20_like_pairs_from_lists",
    v.with_clause(v.ORDERS_LIKED, v.AUTHORS)
    + """, e AS (SELECT author_id, unnest(liked_by) AS liker_id FROM liked)
    SELECT a.displayName AS author_name, l.displayName AS liker_name, count(*) AS total
    FROM e JOIN authors a ON e.author_id = a.author_id JOIN authors l ON e.liker_id = l.author_id GROUP BY 1, 2""",
)(
    lambda s, d: people.like_pairs(
        v.orders_liked(s, d),
        v.authors(s, d).select(F.col("author_id").alias("authorId"), F.col("displayName").alias("authorName")),
    )
)

entry(
    "q21_topic_authors",
    """WITH a AS (SELECT id, min(displayName) AS displayName FROM (
        SELECT c_custkey AS id, c_name AS displayName FROM customer
        UNION ALL SELECT s_suppkey, s_name FROM supplier) GROUP BY 1)
    SELECT o.o_custkey AS author_id, a.displayName, count(*) AS n FROM orders o JOIN a ON o.o_custkey = a.id GROUP BY 1, 2""",
)(
    lambda s, d: people.topic_authors(
        v.table(s, d, "orders").select(F.col("o_custkey").alias("author_id"), F.col("o_orderkey").alias("collection_id")),
        _both_name_tables(s, d),
    )
)


def _both_name_tables(s, d):
    c = v.table(s, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("displayName"))
    return c.unionByName(
        v.table(s, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("displayName"))
    )


entry(
    "q22_text_search",
    r"SELECT doc_id AS id, source AS authorId FROM documents WHERE regexp_matches(text, 'tion\b')",
)(lambda s, d: people.search(v.texts(s, d), r"tion\b").select("id", "authorId"))
entry(
    "f06_literal_filter",
    "SELECT page_id FROM pages WHERE coalesce(NOT contains(url, 'https'), false)",
)(lambda s, d: v.table(s, d, "pages").where(jn.null_safe(~F.col("url").contains("https"))).select("page_id"))

# --- joins -------------------------------------------------------------------

entry(
    "j01_inner_names",
    v.with_clause(v.COMMENTS, v.AUTHORS)
    + "SELECT c.id, c.authorId, a.displayName FROM comments c JOIN authors a ON c.authorId = a.author_id",
)(lambda s, d: jn.with_names(v.comments(s, d).select("id", "authorId"), v.authors(s, d)))

entry(
    "j02_left_titles",
    "SELECT e.event_id AS id, d.lang AS title FROM events e LEFT JOIN documents d ON e.event_id = d.doc_id",
)(lambda s, d: v.comments(s, d).select("id", "ft_id").join(v.titles(s, d), "ft_id", "left").select("id", "title"))

RIGHT = """WITH c AS (SELECT user_id AS authorId, count(*) AS n FROM events GROUP BY 1),
  top AS (SELECT authorId, n FROM c WHERE n > (SELECT avg(n) FROM c))"""
entry(
    "j03_right_top_authors",
    RIGHT + "SELECT e.event_id AS id, t.authorId, t.n FROM events e RIGHT JOIN top t ON e.user_id = t.authorId",
)(lambda s, d: _right(s, d))


def _busy(s, d):
    counts = ag.count_by(v.comments(s, d), ["authorId"])
    return ag.having(counts, "n", counts.agg(F.avg("n").alias("m")).scalar())


def _right(s, d):
    return v.comments(s, d).select("id", "authorId").join(_busy(s, d), "authorId", "right").select("id", "authorId", "n")


entry("j04_semi_busy_authors", RIGHT + "SELECT event_id AS id, user_id AS authorId FROM events WHERE user_id IN (SELECT authorId FROM top)")(
    lambda s, d: jn.members(v.comments(s, d).select("id", "authorId"), "authorId", _busy(s, d))
)
entry("j05_anti_known_keys", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")(
    lambda s, d: jn.non_members(v.table(s, d, "documents").select("doc_id"), ["doc_id"], v.table(s, d, "labels"))
)
entry("j07_both_names", LIKES + "SELECT author_id, author_name, liker_id, liker_name, like_count FROM named")(_named)
# Customers from the richest down beside suppliers by name; the shorter table ends in nulls.
entry(
    "j10_columns_side_by_side",
    """WITH c AS (SELECT c_custkey AS key, c_acctbal, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) - 1 AS place FROM customer),
    s AS (SELECT s_suppkey AS key, s_name, row_number() OVER (ORDER BY s_name) - 1 AS place FROM supplier)
    SELECT place, c.key, c_acctbal, s.key AS key_2, s_name FROM c FULL JOIN s USING (place)""",
)(lambda s, d: rs.side_by_side(
    v.table(s, d, "customer").select(F.col("c_custkey").alias("key"), "c_acctbal"),
    v.table(s, d, "supplier").select(F.col("s_suppkey").alias("key"), "s_name"),
    [F.desc("c_acctbal"), F.asc("key")],
    ["s_name"],
    position="place",
))
entry(
    "j01_hot_key_join",
    "SELECT o.o_orderkey, o.o_orderpriority, c.c_name FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey",
)(lambda s, d: jn.split_hot_join(
    v.table(s, d, "orders").select("o_orderkey", "o_orderpriority", F.col("o_custkey").alias("k")),
    v.table(s, d, "customer").select(F.col("c_custkey").alias("k"), "c_name"),
    "k",
).drop("k"))

# --- aggregates ----------------------------------------------------------------

entry("a01_comments_per_author", "SELECT user_id AS authorId, count(*) AS n FROM events GROUP BY 1")(
    lambda s, d: ag.count_by(v.comments(s, d), ["authorId"])
)
entry("a01_count_non_null", "SELECT lang, count(text) AS n FROM documents GROUP BY 1")(
    lambda s, d: ag.count_by(v.table(s, d, "documents"), ["lang"], of="text")
)
entry("a02_value_counts", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")(
    lambda s, d: rk.frequency_table(v.table(s, d, "orders"), "o_orderpriority")
)
entry("a03_like_pairs", v.with_clause(v.EDGES, v.PAIRS) + "SELECT author_id, liker_id, like_count FROM pairs")(_pairs)
for side in ("author", "liker"):
    entry(
        f"a04_likes_per_{side}",
        v.with_clause(v.EDGES) + f"SELECT {side}_id, count(*) AS like_count FROM edges GROUP BY 1",
    )(lambda s, d, side=side: ag.total_by(_pairs(s, d), [f"{side}_id"], "like_count", "like_count"))
entry(
    "a05_sum_per_group",
    "SELECT source, CAST(sum(n_chars) AS BIGINT) AS total_length FROM documents GROUP BY 1",
)(lambda s, d: ag.total_by(v.table(s, d, "documents"), ["source"], "n_chars", "total_length"))
entry(
    "a06_concat_in_order",
    """WITH p AS (SELECT source, doc_id, text, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k
      FROM documents WHERE text IS NOT NULL)
    SELECT source, CAST((k - 1) // 20 AS BIGINT) AS part, md5(string_agg(text, '' ORDER BY doc_id)) AS text_md5,
      CAST(sum(length(text)) AS BIGINT) AS chars FROM p GROUP BY 1, 2""",
)(lambda s, d: ag.concat_parts(v.table(s, d, "documents"), "source", "text", ["doc_id"], 20).select(
    "source", "part", F.md5("text").alias("text_md5"), F.length("text").cast("long").alias("chars")
))
entry("a07_having", "SELECT user_id AS authorId, count(*) AS n FROM events GROUP BY 1 HAVING count(*) > 60")(
    lambda s, d: ag.having(ag.count_by(v.comments(s, d), ["authorId"]), "n", 60)
)
entry(
    "a08_min_max",
    "SELECT min(o_totalprice) AS lowest, max(o_totalprice) AS highest FROM orders",
)(lambda s, d: v.table(s, d, "orders").agg(F.min("o_totalprice").alias("lowest"), F.max("o_totalprice").alias("highest")))
entry(
    "a10_row_totals_without_zero_columns",
    """SELECT o_custkey, CAST(count(*) FILTER (o_orderstatus = 'F') AS BIGINT) AS f,
      CAST(count(*) FILTER (o_orderstatus = 'O') AS BIGINT) AS o, CAST(count(*) FILTER (o_orderstatus IN ('F', 'O')) AS BIGINT) AS total
    FROM orders GROUP BY 1""",
)(lambda s, d: _row_totals(s, d))


def _row_totals(s, d):
    status = v.table(s, d, "orders").select("o_custkey", F.lower("o_orderstatus").alias("st"), F.lit(1).alias("one"))
    wide = rs.pivot_sum(status, "o_custkey", "st", ["f", "o", "absent"], "one", 0)
    kept = ag.drop_zero_columns(wide, ["f", "o", "absent"])
    return ag.with_row_total(kept, [c for c in ("f", "o") if c in kept.columns])


entry("a11_distinct_years", "SELECT DISTINCT year(o_orderdate) AS year FROM orders")(
    lambda s, d: v.table(s, d, "orders").select(F.year("o_orderdate").cast("long").alias("year")).distinct().orderBy("year")
)
entry(
    "a14_likes_per_comment",
    v.with_clause(v.ORDERS_LIKED) + "SELECT comment_id, CAST(len(liked_by) AS BIGINT) AS likes_count FROM liked WHERE len(liked_by) > 0",
)(lambda s, d: lk.likes_per_comment(
    v.orders_liked(s, d).withColumn("liked_by", F.col("liked_by").cast("array<string>"))
).select("comment_id", F.col("likes_count").cast("long").alias("likes_count")))

# --- ranking, dedupe -------------------------------------------------------------

entry(
    "w01_top_n_ties",
    """WITH c AS (SELECT user_id AS authorId, count(*) AS n FROM events GROUP BY 1),
    r AS (SELECT *, rank() OVER (ORDER BY n DESC) AS k FROM c) SELECT authorId, n FROM r WHERE k <= 20""",
)(lambda s, d: rk.top_n(ag.count_by(v.comments(s, d), ["authorId"]), "n", 20))
entry(
    "w02_top_n_per_group",
    v.with_clause(v.EDGES, v.PAIRS)
    + """, r AS (SELECT *, rank() OVER (PARTITION BY author_id ORDER BY like_count DESC) AS k FROM pairs)
    SELECT author_id, liker_id, like_count FROM r WHERE k <= 5""",
)(lambda s, d: rk.top_n_per_group(_pairs(s, d), "author_id", "like_count", 5))
entry(
    "w03_dense_author_code",
    """SELECT o_orderkey, o_custkey, CAST(dense_rank() OVER (ORDER BY o_custkey) AS BIGINT) AS code FROM orders""",
)(lambda s, d: nb.with_dense_code(v.table(s, d, "orders").select("o_orderkey", "o_custkey"), "o_custkey").select(
    "o_orderkey", "o_custkey", "code"
))
entry(
    "w04_sorted_counts",
    "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, o_custkey",
)(lambda s, d: ag.count_by(v.table(s, d, "orders"), ["o_custkey"]).orderBy(F.desc("n"), "o_custkey"))
entry(
    "w05_first_rows",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20",
)(lambda s, d: rk.first_rows(v.table(s, d, "orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), "o_orderkey"], 20))
entry(
    "w06_share_of_group",
    v.with_clause(v.EDGES, v.PAIRS)
    + """SELECT author_id, liker_id, round(CAST(like_count AS DOUBLE) / sum(like_count) OVER (PARTITION BY author_id), 9) AS share
    FROM pairs""",
)(lambda s, d: ag.share_of_group(_pairs(s, d), "author_id", "like_count").select(
    "author_id", "liker_id", F.round("share", 9).alias("share")
))
LINE = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"
entry(
    "r09_first_row",
    f"""SELECT {LINE} FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity,
      l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) = 1""",
)(lambda s, d: first_per_key(
    v.table(s, d, "lineitem"),
    ["l_orderkey", "l_linenumber"],
    ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"],
).select(*LINE.split(", ")))

# --- sets and shapes ---------------------------------------------------------------

entry(
    "u01_union_missing_columns",
    """SELECT c_custkey AS id, c_name AS displayName, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier""",
)(lambda s, d: rs.union_all([
    v.table(s, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("displayName"), F.col("c_mktsegment").alias("segment")),
    v.table(s, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("displayName")),
]))
entry("u02_name_difference", "SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'")(
    lambda s, d: jn.name_difference(
        v.table(s, d, "customer").select(F.col("c_custkey").alias("k")),
        v.table(s, d, "orders").where(F.col("o_orderstatus") == "F").select(F.col("o_custkey").alias("k")),
    )
)
entry(
    "u03_pivot",
    """SELECT user_id AS authorId, count(*) FILTER (event_type = 'click') AS click, count(*) FILTER (event_type = 'error') AS error,
      count(*) FILTER (event_type = 'purchase') AS purchase, count(*) FILTER (event_type = 'signup') AS signup,
      count(*) FILTER (event_type = 'view') AS view FROM events GROUP BY 1""",
)(lambda s, d: rs.pivot_sum(
    v.comments(s, d).select("authorId", "topic", F.lit(1).cast("long").alias("one")),
    "authorId", "topic", ["click", "error", "purchase", "signup", "view"], "one", 0,
))
entry("u04_like_matrix_cells", MATRIX)(lambda s, d: lk.like_matrix_cells(lk.pairs_by_name(_named(s, d)), MATRIX_LIMIT))
entry(
    "u05_transpose",
    v.with_clause(v.EDGES, v.PAIRS) + "SELECT liker_id AS author_id, author_id AS liker_id, like_count FROM pairs",
)(lambda s, d: rs.transpose_long(_pairs(s, d), "author_id", "liker_id", "like_count"))
entry(
    "u06_repeat_by_length",
    v.with_clause(v.ORDERS_LIKED) + "SELECT comment_id FROM (SELECT comment_id, unnest(liked_by) FROM liked)",
)(lambda s, d: rs.repeat_by_length(v.orders_liked(s, d), "comment_id", "liked_by"))
entry(
    "u07_stack_lists",
    v.with_clause(v.ORDERS_LIKED) + "SELECT comment_id, unnest(liked_by) AS liker FROM liked",
)(lambda s, d: rs.stack_list(v.orders_liked(s, d), ["comment_id"], "liked_by", "liker"))
entry(
    "u07_unpivot",
    """SELECT c_custkey, 'c_acctbal' AS measure, c_acctbal AS value FROM customer WHERE c_acctbal IS NOT NULL
    UNION ALL SELECT c_custkey, 'c_nationkey', CAST(c_nationkey AS DOUBLE) FROM customer WHERE c_nationkey IS NOT NULL""",
)(lambda s, d: rs.unpivot(
    v.table(s, d, "customer").withColumn("c_nationkey", F.col("c_nationkey").cast("double")),
    ["c_custkey"], ["c_acctbal", "c_nationkey"], "measure", "value",
))
