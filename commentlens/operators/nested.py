"""Nested documents to rows: comment lists, reply trees, author maps, page lists.

All of it is in-row work (explode and higher-order functions) in the scan
stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commentlens.functions.links import path_segment_from_end
from commentlens.functions.text import strip_tags
from commentlens.operators.dedupe import first_per_key
from commentlens.session import cut_lineage

# --- documents with a fixed schema -----------------------------------------------


def head_comments(docs: DataFrame, *keys: str) -> DataFrame:
    """Comment rows of first-generation documents, with columns ``keys`` of theirs; a missing head gives no rows."""
    rows = docs.select(*keys, F.explode("headDocument.content").alias("c"))
    body = "c.content"
    return rows.select(
        *keys,
        F.col("c.collectionId").alias("collection_id"),
        F.col(f"{body}.authorId").alias("author_id"),
        F.col(f"{body}.createdAt").alias("created_at"),
        F.col(f"{body}.parentId").alias("parent_id"),
        strip_tags(F.col(f"{body}.bodyHtml")).alias("content"),
        F.col(f"{body}.annotations.likedBy").alias("liked_by"),
    )


def author_rows(docs: DataFrame, authors: str = "authors", *keys: str) -> DataFrame:
    """One row per author of all documents' author maps (within ``keys``); one name per id."""
    rows = docs.select(*keys, F.explode(authors).alias("author_id", "v")).select(
        *keys, "author_id", F.col("v.displayName").alias("displayName")
    )
    return first_per_key(rows, [*keys, "author_id"], ["displayName"])


def page_comments(pages: DataFrame) -> DataFrame:
    """Comments of archive pages with their annotations as columns, one row per id."""
    rows = pages.select(F.explode("content").alias("c")).select("c.content.*")
    flat = rows.select(*[c for c in rows.columns if c != "annotations"], "annotations.*")
    others = [c for c in flat.columns if c not in ("id", "createdAt")]
    return first_per_key(flat, ["id"], ["createdAt", *others])


def titles_of(docs: DataFrame, doc_id: str, settings: str = "headDocument.collectionSettings") -> DataFrame:
    """Title per document, empty when missing."""
    return docs.select(doc_id, F.coalesce(F.col(f"{settings}.title"), F.lit("")).alias("title"))


def collection_meta(meta: DataFrame, address: str, *keys: str) -> DataFrame:
    """What a collection's metadata says of its article: ``ft_id, title, collection_key, n_pages``.

    The collection's own id is the last but one part of the metadata's address.
    """
    settings = F.col("collectionSettings")
    return meta.select(
        *keys,
        settings["url"].alias("ft_id"),
        settings["title"].alias("title"),
        path_segment_from_end(address, 2).alias("collection_key"),
        settings["archiveInfo"]["nPages"].alias("n_pages"),
    )


def expected_pages(meta: DataFrame, keys: list[str]) -> DataFrame:
    """One row per announced archive page with its address."""
    info = F.col("collectionSettings.archiveInfo")
    numbers = F.when(info["nPages"] > 0, F.sequence(F.lit(0), info["nPages"] - 1)).otherwise(F.array().cast("array<int>"))
    paged = meta.withColumn("_info", info["pageInfo"]).select(*keys, "_info", F.explode(numbers).alias("page"))
    url = F.try_element_at(F.col("_info"), F.col("page").cast("string"))["url"]
    return paged.select(*keys, "page", url.alias("url"))


def missing_pages(expected: DataFrame, landed: DataFrame) -> DataFrame:
    """Announced pages that have not landed."""
    return expected.join(landed.select("url"), "url", "left_anti").select(expected.columns)


# --- reply trees -------------------------------------------------------------------

# Levels unfolded per pass. Deeper trees cost one more pass over their nodes
# below that level.
STRIDE = 12

# The fields of a node's content that are read, all in one cast.
_CONTENT = (
    "struct<id: string, ancestorId: string, parentId: string, authorId: string, annotations: struct<messagetag: string>, "
    "bodyHtml: string, createdAt: bigint, updatedAt: bigint>"
)


def _children(node: Column, kind: int) -> Column:
    found = F.try_variant_get(node, "$.childContent", "array<variant>")
    return F.filter(F.coalesce(found, F.array().cast("array<variant>")), lambda c: _kind(c) == kind)


def _kind(node: Column) -> Column:
    return F.coalesce(F.try_variant_get(node, "$.type", "int"), F.lit(-1))


def likers_of_node(node: Column) -> Column:
    """Authors of a node's direct like children."""
    return F.transform(_children(node, 1), lambda c: F.try_variant_get(c, "$.content.authorId", "string"))


def _read(level: Column, depth: int, last: bool) -> Column:
    """Depth, content and likers of a level's nodes; of the last unfolded level the nodes themselves, to go on from."""
    none = F.lit(None)

    def read(node: Column) -> Column:
        content = none.cast(_CONTENT) if last else F.try_variant_get(node, "$.content", _CONTENT)
        likers = none.cast("array<string>") if last else likers_of_node(node)
        pending = node if last else none.cast("variant")
        return F.struct(F.lit(depth).alias("depth"), content.alias("c"), likers.alias("liked_by"), pending.alias("pending"))

    return F.transform(level, read)


def _node_fields() -> list[Column]:
    """The comment fields of a read node; absent text fields are empty."""
    text = {
        "comment_id": "id", "ancestor_id": "ancestorId", "parent_id": "parentId", "author_id": "authorId",
        "messagetag": "annotations.messagetag", "comment": "bodyHtml",
    }
    found = {name: F.coalesce(F.col(f"_n.c.{path}"), F.lit("")) for name, path in text.items()}
    found["comment"] = strip_tags(found["comment"])
    return [
        *[column.alias(name) for name, column in found.items()],
        F.col("_n.c.createdAt").alias("created_at"),
        F.col("_n.c.updatedAt").alias("updated_at"),
        F.col("_n.liked_by").alias("liked_by"),
    ]


def tree_rows(docs: DataFrame, keys: list[str], top: Column, max_depth: int = 100) -> DataFrame:
    """Comment fields of every reply node: rows ``(keys..., depth, fields...)`` (runs a job).

    Levels are unfolded one from another inside the document row, several per
    pass. Nodes are read where they are found, so what is exploded and stored
    is their fields and never what hangs below them; only the nodes of a pass's
    last level are kept whole, for the next pass. No level beyond
    ``max_depth + 1`` is unfolded: a node there fails the run, and no tree is
    shortened.
    """
    empty = F.array().cast("array<variant>")
    frontier = docs.select(*keys, F.coalesce(top, empty).alias("_level0"))
    found = None
    depth = 0
    while True:
        levels = min(STRIDE, max_depth + 1 - depth)
        wide = frontier
        for k in range(1, levels + 1):
            below = F.flatten(F.transform(F.col(f"_level{k - 1}"), lambda n: _children(n, 0)))
            wide = wide.withColumn(f"_level{k}", below)
        read = [_read(F.col(f"_level{k}"), depth + k, k == levels) for k in range(levels + 1)]
        nodes = wide.select(*keys, F.explode(F.concat(*read)).alias("_n"))
        pending = F.col("_n.pending").alias("_pending")
        stored = cut_lineage(nodes.select(*keys, "_n.depth", *_node_fields(), pending), "replies")
        depth += levels
        rows = stored.where(F.col("depth") < depth).drop("_pending")
        found = rows if found is None else found.unionByName(rows)
        deeper = stored.where(F.col("depth") == depth)
        if deeper.isEmpty():
            return found
        if depth > max_depth:
            raise ValueError(f"a reply tree is deeper than max_depth={max_depth}")
        frontier = deeper.select(*keys, F.array("_pending").alias("_level0"))


def flatten_tree(docs: DataFrame, max_depth: int = 100) -> DataFrame:
    """Comment rows of reply trees (runs a job).

    ``docs`` has ``ft_id``, ``title`` and the variant ``comments``. Top-level
    nodes are kept whatever their type; below, replies (type 0) are followed
    and likes (type 1) become ``liked_by``.
    """
    top = F.try_variant_get("comments", "$.content", "array<variant>")
    rows = tree_rows(docs, ["ft_id", "title"], top, max_depth)
    return rows.select("ft_id", "title", *[c for c in rows.columns if c not in ("ft_id", "title", "depth")], "depth")


def tree_authors(docs: DataFrame) -> DataFrame:
    """Author rows of the author maps beside the trees."""
    names = docs.select(F.try_variant_get("comments", "$.authors", "map<string,struct<displayName:string>>").alias("a"))
    rows = names.select(F.explode("a").alias("authorId", "v")).select("authorId", F.col("v.displayName").alias("authorName"))
    return first_per_key(rows, ["authorId"], ["authorName"])
