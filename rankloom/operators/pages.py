"""Fields, links and page views derived from raw web pages and events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.urls import canonical_url, resolve_url
from .joins import lookup_join

# Fixed values.
TITLE_PATTERN = r"(?is)<title[^>]*>(.*?)</title>"
ANCHOR_PATTERN = r'(?is)<a\s(?:[^>]*\s)?href\s*=\s*["\x27]([^"\x27]*)["\x27][^>]*>(.*?)</a>'
SCRIPT_PATTERN = r"(?is)<script[^>]*>.*?</script>"
STYLE_PATTERN = r"(?is)<style[^>]*>.*?</style>"
TAG_PATTERN = r"<[^>]*>"
ENTITY_PATTERN = r"&[#a-zA-Z0-9]+;"
# End of fixed values.


def titles(pages: DataFrame) -> DataFrame:
    """``(doc_id, title)``; the title of a page without one, or with an empty one, is null."""
    return pages.select(
        F.col("page_id").alias("doc_id"),
        F.nullif(F.regexp_extract("html", TITLE_PATTERN, 1), F.lit("")).alias("title"),
    )


def body_text(pages: DataFrame) -> DataFrame:
    """``(doc_id, text)``: the visible text of a page."""
    text = F.col("html")
    for pattern in (SCRIPT_PATTERN, STYLE_PATTERN, TAG_PATTERN, ENTITY_PATTERN):
        text = F.regexp_replace(text, F.lit(pattern), F.lit(" "))
    return pages.select(F.col("page_id").alias("doc_id"), text.alias("text"))


def anchors(pages: DataFrame) -> DataFrame:
    """``(page_id, pos, href, text)``, one row per link in page order; ``href`` may be any attribute."""
    found = F.transform(
        F.regexp_extract_all("html", F.lit(ANCHOR_PATTERN), F.lit(0)),
        lambda link: F.struct(
            F.regexp_extract(link, ANCHOR_PATTERN, 1).alias("href"),
            F.regexp_extract(link, ANCHOR_PATTERN, 2).alias("text"),
        ),
    )
    return pages.select("page_id", F.posexplode(found).alias("pos", "_l")).select(
        "page_id", "pos", F.col("_l.href").alias("href"), F.col("_l.text").alias("text")
    )


def synthetic_target(href: Column | str, n_pages: Column) -> Column:
    """Page a link points to in the test tables, whose links resolve to no page.

    Page ids there are 0 to ``n_pages - 1``; the target is a hash of the link. Real data would
    join the links with the page table on the URL instead, see :func:`resolve_links`.
    """
    return F.pmod(F.conv(F.substring(F.md5(href), 1, 8), 16, 10).cast("bigint"), n_pages)


def synthetic_links(pages: DataFrame) -> DataFrame:
    """``(page_id, pos, target, text)`` by :func:`synthetic_target`."""
    n_pages = pages.agg(F.count("*")).scalar()
    return anchors(pages).select(
        "page_id", "pos", synthetic_target("href", n_pages).alias("target"), "text"
    )


def resolve_links(links: DataFrame, pages: DataFrame) -> DataFrame:
    """``(page_id, pos, target, text)``: links are resolved against the URL of their page and joined with
    the pages by canonical URL. Of pages with the same one the lowest id is the target. Links to unknown
    pages, or to what is no web address, are dropped; on a page without a URL only whole ones count.
    """
    base = pages.select("page_id", F.coalesce("url", F.lit("")).alias("_base"))
    known = pages.select(canonical_url(F.col("url")).alias("_url"), "page_id").filter("_url is not null")
    known = known.groupBy("_url").agg(F.min("page_id").alias("target"))
    based = lookup_join(links, base, ["page_id"], bounded=False, how="inner")
    named = based.withColumn("_url", resolve_url(F.col("_base"), F.col("href"))).filter("_url is not null")
    found = lookup_join(named, known, ["_url"], bounded=False, how="inner")
    return found.select("page_id", "pos", "target", "text")


def anchor_text(links: DataFrame) -> DataFrame:
    """``(doc_id, text)``: link texts belong to the page linked to, one row per link."""
    return links.select(F.col("target").alias("doc_id"), "text")


def link_edges(links: DataFrame) -> DataFrame:
    """Distinct ``(src, dst)`` without self-loops."""
    return (
        links.select(F.col("page_id").alias("src"), F.col("target").alias("dst"))
        .filter(F.col("src") != F.col("dst"))
        .distinct()
    )


def page_views(events: DataFrame, start: str, end: str) -> DataFrame:
    """``(doc_id, views)`` of the months from ``start`` up to, not including, ``end``."""
    return (
        events.filter(
            (F.col("event_type") == "view")
            & (F.col("ts") >= F.lit(start).cast("timestamp"))
            & (F.col("ts") < F.lit(end).cast("timestamp"))
        )
        .groupBy(F.col("user_id").alias("doc_id"))
        .agg(F.count("*").alias("views"))
    )
