"""Links of index pages, from a table of pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.filesets import COMPRESSED_SUFFIXES, has_suffix

# Fixed patterns: what is not markup, an anchor with its href, and the href inside the anchor.
_NOT_MARKUP = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
_ANCHOR = r"(?is)<a\s(?:[^>]*?\s)?href\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>\"']+)"
_HREF = r"(?is)href\s*=\s*[\"']?([^\"']*)[\"']?$"


def page_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row per anchor of every page: the page's other columns plus ``href``."""
    markup = F.regexp_replace(F.col(html), _NOT_MARKUP, "")
    anchors = F.regexp_extract_all(markup, F.lit(_ANCHOR), F.lit(0))
    others = [c for c in pages.columns if c != html]
    exploded = pages.select(*others, F.explode(anchors).alias("_anchor"))
    href = F.replace(F.regexp_extract("_anchor", _HREF, 1), F.lit("&amp;"), F.lit("&"))
    return exploded.select(*others, href.alias("href"))


def file_links(
    pages: DataFrame, base_url: str, year: int, suffixes: tuple[str, ...] = COMPRESSED_SUFFIXES, html: str = "html"
) -> DataFrame:
    """Links to files with the given endings, as absolute ``url`` below ``base_url/year``."""
    links = page_links(pages, html).filter(has_suffix(F.col("href"), suffixes))
    return links.withColumn("url", F.concat(F.lit(f"{base_url}/{year}/"), F.col("href")))
