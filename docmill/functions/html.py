"""Markdown, links, titles and languages of HTML pages, and the URLs of sitemaps."""

from __future__ import annotations

from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from docmill.functions.markdown import markdown
from docmill.functions.text import strip
from docmill.functions.urls import path, resolve
from docmill.session import small_batches

LINK = r"\[.+?\]\((.+?)\)"


def to_markdown(html: Column) -> Column:
    """A page as Markdown, see docmill.functions.markdown; null for a null page."""
    small_batches(SparkSession.active())

    @F.arrow_udf("string")
    def run(pages: pa.Array) -> pa.Array:
        return pa.array([None if x is None else markdown(x) for x in pages.to_pylist()], pa.string())

    return run(html)


def language(html: Column) -> Column:
    """The lower-cased lang of the html tag; empty if there is none."""
    return F.lower(F.regexp_extract(html, r"""(?is)<html\b[^>]*\blang=["']?([^"'\s>]+)""", 1))


def is_english(html: Column) -> Column:
    return (language(html) == "") | language(html).startswith("en")


def title(url: Column, markdown: Column, given: Column | None = None) -> Column:
    """The given title, else the first line that starts with `# `, else the last segment of the path."""
    heading = strip(F.replace(F.regexp_extract(markdown, r"(?m)^(# .*)$", 1), F.lit("# "), F.lit("")))
    last = F.element_at(F.split(F.regexp_replace(path(url), "/+$", ""), "/"), -1)
    first = F.nullif(given, F.lit("")) if given is not None else F.lit(None).cast("string")
    return F.coalesce(first, F.when(markdown.rlike("(?m)^# "), heading), last)


def content(*choices: Column) -> Column:
    """The first choice that is not null or empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in choices])


def links(url: Column, markdown: Column, given: Column | None = None) -> Column:
    """The distinct targets of a page, sorted: the Markdown links, resolved, and those that the crawler gives."""
    found = F.transform(F.regexp_extract_all(markdown, F.lit(LINK), F.lit(1)), lambda x: resolve(url, x))
    return F.array_sort(F.array_distinct(F.concat(found, F.coalesce(given, F.array().cast("array<string>"))) if given is not None else F.array_distinct(found)))


def rendered(title: Column, url: Column, markdown: Column) -> Column:
    """A document as it is saved: title, source and text."""
    return F.concat(F.lit("# "), title, F.lit("\n\n**Source:** "), url, F.lit("\n\n"), markdown)


def _locations(xml: str | None) -> list[str]:
    try:
        root = ElementTree.fromstring(xml or "")
    except ElementTree.ParseError:
        return []
    found = ((e.text or "").strip() for e in root.iter() if isinstance(e.tag, str) and e.tag.rpartition("}")[2] == "loc")
    return list(dict.fromkeys(u for u in found if u))


def sitemap_urls(xml: Column) -> Column:
    """The text of every loc element of any namespace, trimmed, once each; none for text that is not XML."""

    @F.arrow_udf("array<string>")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([_locations(x.as_py()) for x in texts], pa.list_(pa.string()))

    return run(xml)
