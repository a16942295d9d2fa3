"""Column functions on URLs, article ids and collection ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def id_between_slash_and_query(url: Column | str) -> Column:
    """Text after the first ``/`` up to the first ``?`` or ``#``; null without a match."""
    return F.nullif(F.regexp_extract(_col(url), r"/([^\n]*?)[?#]", 1), F.lit(""))


def id_from_last_segment(url: Column | str) -> Column:
    """Last path segment, cut at its first dot."""
    return F.substring_index(F.substring_index(_col(url), "/", -1), ".", 1)


def short_collection_id(url: Column | str) -> Column:
    """Path segments 6 and 7 joined by a slash."""
    return F.array_join(F.slice(F.split(_col(url), "/"), 6, 2), "/")


def id_from_href(href: Column | str, strip_characters: bool = False) -> Column:
    """Article id of a ``/content/<id>`` link.

    ``strip_characters`` reproduces the older behaviour of trimming any of the
    characters of ``/content/`` from both ends, which damages some ids.
    """
    if strip_characters:
        return F.btrim(_col(href), F.lit("/conte"))
    return F.regexp_replace(_col(href), r"^/content/|/$", "")


def rewrite(url: Column | str, replacements: list[tuple[str, str]]) -> Column:
    """Apply literal replacements in order (bootstrap address to data address)."""
    out = _col(url)
    for old, new in replacements:
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def collection_id(article_id: Column | str) -> Column:
    """URL-safe base64 of the id, with dots as padding."""
    return F.translate(F.base64(F.encode(_col(article_id), "utf-8")), "+/=\r\n", "-_.")


def path_segment_from_end(url: Column | str, position: int) -> Column:
    """Segment counted from the end of the path (1 = last)."""
    return F.try_element_at(F.split(_col(url), "/"), F.lit(-position))
