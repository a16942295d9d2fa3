"""Registered queries on nested documents, with their SQL.

Each document row of the test tables becomes one JSON document in Spark: its
lines are the comments or the replies. The SQL computes the expected rows from
the lines directly.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from commentlens.operators import nested as ns
from commentlens.operators.likes import likes_from_lists, likers_with_at, likes_from_text
from commentlens.registry import views as v
from commentlens.schemas import ARCHIVE_META, ARCHIVE_PAGE, HEAD_DOCUMENT
from commentlens.sources.documents import parse_trees

ENTRIES: dict = {}


def entry(name: str, sql: str | None = None):
    def add(fn):
        ENTRIES[name] = (fn, sql)
        return fn

    return add


LINES = "string_split(text, chr(10))"
ROWS = f"""WITH l AS (SELECT doc_id, source, lang, unnest({LINES}) AS line, generate_subscripts({LINES}, 1) - 1 AS i FROM documents)
"""
STRIP = r"regexp_replace(line, '<[^\n]*?>', '', 'g')"


def _lines():
    return F.split("text", "\n")


def _head_documents(s, d):
    """First-generation documents: a comment per line, liked by the source on every line."""
    comment = lambda line, i: F.struct(
        F.col("doc_id").alias("collectionId"),
        F.struct(
            F.concat_ws("-", F.col("doc_id"), i).alias("id"),
            F.col("source").alias("authorId"),
            F.lit("0").alias("parentId"),
            line.alias("bodyHtml"),
            (F.lit(1400000000) + i).cast("long").alias("createdAt"),
            F.struct(F.array(F.col("lang"), F.col("source")).alias("likedBy")).alias("annotations"),
        ).alias("content"),
    )
    names = F.create_map(F.col("source"), F.struct(F.col("source").alias("id"), F.upper("source").alias("displayName")))
    head = F.struct(
        F.transform(_lines(), comment).alias("content"),
        names.alias("authors"),
        F.struct(F.when(F.col("lang") != "en", F.col("lang")).alias("title")).alias("collectionSettings"),
    )
    rows = v.wide_table(s, d, "documents").select("doc_id", F.to_json(F.struct(head.alias("headDocument"))).alias("j"))
    return rows.select("doc_id", F.from_json("j", HEAD_DOCUMENT).alias("x")).select("doc_id", "x.*")


entry(
    "p01_head_document_comments",
    ROWS + f"""SELECT doc_id AS collection_id, source AS author_id, CAST(1400000000 + i AS BIGINT) AS created_at,
      CAST('0' AS VARCHAR) AS parent_id, {STRIP} AS content, lang || ',' || source AS liked_by FROM l""",
)(lambda s, d: ns.head_comments(_head_documents(s, d)).withColumn("liked_by", F.array_join("liked_by", ",")))
entry("p05_author_map_rows", "SELECT DISTINCT source AS author_id, upper(source) AS displayName FROM documents")(
    lambda s, d: ns.author_rows(_head_documents(s, d), "headDocument.authors")
)
entry("p07_titles_with_fallback", "SELECT doc_id, CASE WHEN lang <> 'en' THEN lang ELSE '' END AS title FROM documents")(
    lambda s, d: ns.titles_of(_head_documents(s, d), "doc_id")
)


def _archive_pages(s, d):
    """Archive pages with every comment twice, so the dedupe has work."""
    comment = lambda line, i: F.struct(
        F.struct(
            F.concat_ws("-", F.col("doc_id"), i).alias("id"),
            F.col("source").alias("authorId"),
            F.lit("-1").alias("parentId"),
            F.lit("-1").alias("ancestorId"),
            line.alias("bodyHtml"),
            (F.lit(1400000000) + i).cast("long").alias("createdAt"),
            F.struct(F.array(F.col("lang")).alias("likedBy")).alias("annotations"),
        ).alias("content")
    )
    body = F.transform(_lines(), comment)
    names = F.create_map(F.col("source"), F.struct(F.upper("source").alias("displayName")))
    rows = v.wide_table(s, d, "documents").select(
        F.to_json(F.struct(F.concat(body, body).alias("content"), names.alias("authors"))).alias("j")
    )
    return rows.select(F.from_json("j", ARCHIVE_PAGE).alias("x")).select("x.*")


entry(
    "p06_archive_page_comments",
    ROWS + """SELECT doc_id || '-' || i AS id, source AS authorId, CAST('-1' AS VARCHAR) AS parentId, md5(line) AS body,
      CAST(1400000000 + i AS BIGINT) AS createdAt, lang AS likedBy FROM l""",
)(lambda s, d: ns.page_comments(_archive_pages(s, d)).select(
    "id", "authorId", "parentId", F.md5("bodyHtml").alias("body"), "createdAt", F.array_join("likedBy", ",").alias("likedBy")
))
entry("p05_page_author_rows", "SELECT DISTINCT source AS author_id, upper(source) AS displayName FROM documents")(
    lambda s, d: ns.author_rows(_archive_pages(s, d))
)


def _metadata(s, d):
    count = F.pmod(F.col("page_id"), F.lit(4)).cast("int")
    numbers = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    pages = F.map_from_entries(
        F.transform(numbers, lambda i: F.struct(i.cast("string"), F.struct(F.concat_ws("/", F.col("url"), i).alias("url"))))
    )
    settings = F.struct(
        F.col("url"), F.col("url").alias("title"), F.struct(count.alias("nPages"), pages.alias("pageInfo")).alias("archiveInfo")
    )
    rows = v.table(s, d, "pages").select("page_id", F.to_json(F.struct(settings.alias("collectionSettings"))).alias("j"))
    return rows.select("page_id", F.from_json("j", ARCHIVE_META).alias("x")).select("page_id", "x.*")


entry(
    "p07_metadata",
    "SELECT page_id, url AS ft_id, url AS title, 'c' || page_id AS collection_key, CAST(page_id % 4 AS INT) AS n_pages FROM pages",
)(lambda s, d: ns.collection_meta(
    _metadata(s, d).withColumn("address", F.concat(F.lit("https://h/bs3/c"), "page_id", F.lit("/init"))), "address", "page_id"
))


EXPECTED = """WITH e AS (SELECT page_id, CAST(unnest(range(0, page_id % 4)) AS BIGINT) AS page, url FROM pages)
  SELECT page_id, page, url || '/' || page AS url FROM e"""
entry("p12_expected_pages", EXPECTED)(
    lambda s, d: ns.expected_pages(_metadata(s, d), ["page_id"]).withColumn("page", F.col("page").cast("long"))
)
entry("p12_missing_pages", EXPECTED + " WHERE page > 0")(lambda s, d: _missing(s, d))


def _missing(s, d):
    expected = ns.expected_pages(_metadata(s, d), ["page_id"])
    landed = v.table(s, d, "pages").select(F.concat("url", F.lit("/0")).alias("url"))
    return ns.missing_pages(expected, landed).withColumn("page", F.col("page").cast("long"))


# --- reply trees -----------------------------------------------------------------------


def _trees(s, d):
    """Reply trees: document -> lines -> sentences, each line liked by its language and source."""
    like = lambda who: F.struct(
        F.lit(1).alias("type"), F.struct(who.alias("authorId"), F.lit(None).cast("string").alias("id"),
        F.lit(None).cast("string").alias("parentId"), F.lit(None).cast("string").alias("bodyHtml")).alias("content"),
    )
    leaf = lambda author, key, parent, body: F.struct(
        F.lit(0).alias("type"), F.struct(author.alias("authorId"), key.alias("id"), parent.alias("parentId"), body.alias("bodyHtml")).alias("content")
    )
    doc = F.concat(F.lit("d"), F.col("doc_id"))

    def line_node(line, i):
        key = F.concat_ws("-", doc, i)
        replies = F.transform(F.split(line, r"\. "), lambda t, j: leaf(F.col("lang"), F.concat_ws("-", key, j), key, t))
        node = leaf(F.col("source"), key, doc, line)
        return F.struct(node["type"], node["content"], F.concat(F.array(like(F.col("lang")), like(F.col("source"))), replies).alias("childContent"))

    root = F.struct(
        F.lit(0).alias("type"),
        F.struct(F.col("source").alias("authorId"), doc.alias("id"), F.lit("").alias("parentId"), F.col("lang").alias("bodyHtml"),
                 F.lit(1400000000).alias("createdAt")).alias("content"),
        F.transform(_lines(), line_node).alias("childContent"),
    )
    names = F.create_map(F.col("source"), F.struct(F.upper("source").alias("displayName")))
    body = F.struct(F.array(root).alias("content"), names.alias("authors"))
    rows = v.wide_table(s, d, "documents").select(
        F.col("doc_id").cast("string").alias("ft_id"), F.col("lang").alias("title"), F.to_json(body).alias("j")
    )
    return parse_trees(rows, "j")


TREE = (
    ROWS
    + r""", s AS (SELECT doc_id, lang, i, unnest(string_split(line, '. ')) AS part, generate_subscripts(string_split(line, '. '), 1) - 1 AS j FROM l),
  n AS (SELECT doc_id, 'd' || doc_id AS comment_id, '' AS parent_id, source AS author_id, lang AS body, 0 AS depth, '' AS liked_by,
      CAST(1400000000 AS BIGINT) AS created_at FROM documents
    UNION ALL SELECT doc_id, 'd' || doc_id || '-' || i, 'd' || doc_id, source, line, 1, lang || ',' || source, NULL FROM l
    UNION ALL SELECT doc_id, 'd' || doc_id || '-' || i || '-' || j, 'd' || doc_id || '-' || i, lang, part, 2, '', NULL FROM s)
"""
)
TREE_ROWS = TREE + r"""SELECT CAST(doc_id AS VARCHAR) AS ft_id, comment_id, parent_id, author_id, md5(regexp_replace(body, '<[^\n]*?>', '', 'g')) AS body,
  CAST(depth AS BIGINT) AS depth, liked_by, created_at FROM n"""


def _flat(s, d):
    return ns.flatten_tree(_trees(s, d)).select(
        "ft_id", "comment_id", "parent_id", "author_id", F.md5("comment").alias("body"),
        F.col("depth").cast("long").alias("depth"), F.array_join("liked_by", ",").alias("liked_by"), "created_at",
    )


for name in ("p02_flatten_tree", "q17_flatten_tree"):
    entry(name, TREE_ROWS)(_flat)
CHAIN = 40


def _chains(s, d):
    """Reply trees as deep as 40 levels: each line answers the one before; every other line has no tag, every third no id."""

    text = F.transform(
        _lines(),
        lambda line, i: F.struct(
            i.alias("i"),
            F.to_json(F.struct(
                F.when(i % 3 != 2, F.concat_ws("-", F.col("doc_id"), i)).alias("id"),
                F.col("source").alias("authorId"),
                line.alias("bodyHtml"),
                F.when(i % 2 == 0, F.struct(F.col("lang").alias("messagetag"))).alias("annotations"),
                F.when(i % 5 == 0, (F.lit(1400000000) + i).cast("long")).alias("updatedAt"),
            )).alias("content"),
        ),
    )
    # from the last line up: a node is closed around what answers it; every fortieth line starts a tree
    closed = F.aggregate(
        F.reverse(text),
        F.struct(F.lit("").alias("below"), F.lit("").alias("done")),
        lambda acc, n: F.struct(
            F.when(n["i"] % CHAIN == 0, F.lit("")).otherwise(_wrapped(n["content"], acc["below"])).alias("below"),
            F.when(
                n["i"] % CHAIN == 0,
                F.concat(_wrapped(n["content"], acc["below"]), F.when(acc["done"] != "", F.lit(",")).otherwise(""), acc["done"]),
            ).otherwise(acc["done"]).alias("done"),
        ),
    )
    rows = v.wide_table(s, d, "documents").select(
        F.col("doc_id").cast("string").alias("ft_id"),
        F.col("lang").alias("title"),
        F.concat(F.lit('{"content":['), closed["done"], F.lit("]}")).alias("j"),
    )
    return parse_trees(rows, "j")


def _wrapped(content, below):
    return F.concat(F.lit('{"type":0,"content":'), content, F.lit(',"childContent":['), below, F.lit("]}"))


entry(
    "p02_deep_tree",
    ROWS + f"""SELECT CAST(doc_id AS VARCHAR) AS ft_id, CASE WHEN i % 3 <> 2 THEN doc_id || '-' || i ELSE '' END AS comment_id,
      CAST(i % {CHAIN} AS BIGINT) AS depth, md5({STRIP}) AS body FROM l""",
)(lambda s, d: ns.flatten_tree(_chains(s, d)).select(
    "ft_id", "comment_id", F.col("depth").cast("long").alias("depth"), F.md5("comment").alias("body")
))
entry(
    "p03_absent_fields_empty",
    ROWS + """SELECT CASE WHEN i % 3 <> 2 THEN doc_id || '-' || i ELSE '' END AS comment_id, '' AS ancestor_id, '' AS parent_id,
      CASE WHEN i % 2 = 0 THEN lang ELSE '' END AS messagetag, CAST(NULL AS BIGINT) AS created_at,
      CASE WHEN i % 5 = 0 THEN CAST(1400000000 + i AS BIGINT) END AS updated_at FROM l""",
)(lambda s, d: ns.flatten_tree(_chains(s, d)).select(
    "comment_id", "ancestor_id", "parent_id", "messagetag", "created_at", "updated_at"
))
entry(
    "p04_likers_of_node",
    ROWS + "SELECT 'd' || doc_id || '-' || i AS comment_id, unnest([lang, source]) AS liker FROM l",
)(lambda s, d: ns.flatten_tree(_trees(s, d)).select("comment_id", F.explode("liked_by").alias("liker")))
entry("p05_tree_authors", "SELECT DISTINCT source AS authorId, upper(source) AS authorName FROM documents")(
    lambda s, d: ns.tree_authors(_trees(s, d))
)

# --- liker lists -------------------------------------------------------------------------


def _list_text(s, d, quote="'"):
    items = F.transform(F.col("liked_by"), lambda x: F.concat(F.lit(quote), x.cast("string"), F.lit("@h"), F.lit(quote)))
    return v.orders_liked(s, d).withColumn("liked_by", F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]")))


UNNESTED = v.with_clause(v.ORDERS_LIKED) + ", e AS (SELECT comment_id, author_id, unnest(liked_by) AS liker FROM liked)\n"
entry("p09_likers_from_text", UNNESTED + "SELECT comment_id, liker || '@h' AS likedBy FROM e")(
    lambda s, d: likes_from_text(_list_text(s, d), "comment_id", "liked_by")
)
entry(
    "p09_likers_keep_empty",
    UNNESTED + "SELECT comment_id, liker || '@h' AS likedBy FROM e UNION ALL SELECT comment_id, '' FROM liked WHERE len(liked_by) = 0",
)(lambda s, d: likes_from_text(_list_text(s, d), "comment_id", "liked_by", keep_empty=True))
entry("p10_likers_from_lists", UNNESTED + "SELECT author_id, liker AS liker_id FROM e")(
    lambda s, d: likes_from_lists(v.orders_liked(s, d))
)
entry("p11_likers_with_at", UNNESTED + "SELECT author_id, liker || '@h' AS liker_id FROM e")(
    lambda s, d: likers_with_at(_list_text(s, d, ""))
)
