"""URL expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1)


def segments(url: Column) -> Column:
    return F.filter(F.split(path(url), "/"), lambda x: x != "")


def slug(url: Column) -> Column:
    """the last path segment, or null."""
    return F.try_element_at(segments(url), F.lit(-1))


def question_id(url: Column, marker: str = "questions") -> Column:
    """The last two segments joined, where the one before them is the marker and there are four at least."""
    s = segments(url)
    return F.when((F.size(s) >= 4) & (F.try_element_at(s, F.lit(-3)) == marker), F.concat_ws("_", F.try_element_at(s, F.lit(-2)), F.try_element_at(s, F.lit(-1))))


def normalise(url: Column) -> Column:
    """no fragment, no slash after .html, single slashes in the path."""
    bare = F.regexp_replace(url, "#.*$", "")
    root = F.regexp_extract(bare, r"^([A-Za-z][A-Za-z0-9+.-]*://)?", 0)
    rest = F.regexp_replace(F.substr(bare, F.length(root) + 1), r"/{2,}", "/")
    return F.concat(root, F.regexp_replace(rest, r"\.html/+$", ".html"))


def question_path(href: Column, marker: str = "questions") -> Column:
    """the canonical path of a question link, relative or absolute, else null."""
    p = F.regexp_replace(path(href), r"/{2,}", "/")
    p = F.when(p.startswith("/"), p).otherwise(F.concat(F.lit("/"), p))
    p = F.regexp_replace(p, r"/+$", "")
    return F.when(p.rlike(rf"^/(?:[^/]+/)*{marker}/[^/]+/\d+$"), F.concat(p, F.lit("/")))


def last_page(html: Column, key: str = "PAGEN_1") -> Column:
    """The greatest page number linked, 1 without any."""
    return F.coalesce(F.array_max(F.transform(F.regexp_extract_all(html, F.lit(rf"{key}=(\d+)"), F.lit(1)), lambda x: x.cast("int"))), F.lit(1))


def links(html: Column) -> Column:
    """Link targets in first-occurrence order."""
    return F.array_distinct(F.regexp_extract_all(html, F.lit(r"""href=["']([^"'#\s]+)"""), F.lit(1)))
