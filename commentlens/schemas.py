"""Fixed schemas of the logical tables and of the raw JSON documents."""

from __future__ import annotations

# Column names are stored-format values: files and tables written earlier carry
# them, so they are kept as they are.
TABLES = {
    "article_links": "ft_hash STRING, topic STRING, collection_id STRING",
    "article_sites": "ft_hash STRING, topic STRING, siteId STRING",
    "ft_ids": "topic STRING, ft_id STRING",
    "comments_v1": "collection_id LONG, author_id STRING, created_at LONG, parent_id LONG, content STRING, liked_by STRING",
    "authors_v1": "id STRING, displayName STRING",
    "comments_v2": (
        "ft_id STRING, title STRING, comment_id STRING, ancestor_id STRING, parent_id STRING, author_id STRING, "
        "messagetag STRING, comment STRING, created_at LONG, updated_at LONG, liked_by ARRAY<STRING>"
    ),
    "authors_v2": "authorId STRING, authorName STRING",
    "raw_comments": (
        "id LONG, ancestorId LONG, parentId LONG, authorId STRING, bodyHtml STRING, createdAt LONG, "
        "ft_id STRING, title STRING, likedBy STRING"
    ),
    "comments": "ancestorId LONG, authorId STRING, createdAt LONG, ft_id STRING, id LONG, parentId LONG",
    "text": "id LONG, bodyHtml STRING",
    "titles": "ft_id STRING, title STRING",
    "authors": "author_id STRING, displayName STRING",
    "likes": "comment_id LONG, likedBy STRING",
    "pca": "author_id STRING, PCA_1 DOUBLE, PCA_2 DOUBLE, year INT",
    "tfidf": "authorId STRING, word STRING, n LONG, tf_idf DOUBLE",
}

# Key columns of the warehouse tables, used by the idempotent loads.
KEYS = {
    "comments": ["id"],
    "text": ["id"],
    "titles": ["ft_id"],
    "authors": ["author_id"],
    "likes": ["comment_id", "likedBy"],
    "comments_v2": ["comment_id"],
    "authors_v2": ["authorId"],
}

_BODY = (
    "STRUCT<id: STRING, authorId: STRING, parentId: STRING, ancestorId: STRING, bodyHtml: STRING, "
    "createdAt: LONG, updatedAt: LONG, annotations: STRUCT<likedBy: ARRAY<STRING>, messagetag: STRING>>"
)

# v1: one document per collection.
HEAD_DOCUMENT = (
    "headDocument STRUCT<"
    f"content: ARRAY<STRUCT<collectionId: LONG, content: {_BODY}>>, "
    "authors: MAP<STRING, STRUCT<id: STRING, displayName: STRING>>, "
    "collectionSettings: STRUCT<title: STRING>>"
)

# v3: one document per archive page.
ARCHIVE_PAGE = f"content ARRAY<STRUCT<content: {_BODY}>>, authors MAP<STRING, STRUCT<displayName: STRING>>"

# v3: one metadata document per article.
ARCHIVE_META = (
    "collectionSettings STRUCT<url: STRING, title: STRING, "
    "archiveInfo: STRUCT<nPages: INT, pageInfo: MAP<STRING, STRUCT<url: STRING>>>>"
)
