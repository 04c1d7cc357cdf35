"""Stored web pages: extraction, links and response filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import markup
from quern.functions.urls import normalize_link, resolve_link, same_hostname
from quern.session import spread

from .filters import html_only


def page_pieces(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Add ``pieces``: the page's texts, titles and links in order.

    Plain pages are cut up by JVM expressions. Only pages whose markup could
    make a difference are given to the library parser; it sees null for the rest.
    """
    cut = spread(pages, url).withColumn("_tokens", markup.page_tokens(F.col(html)))
    marked = cut.withColumn("_plain", markup.is_plain(F.col(html), F.col("_tokens")))
    parsed = marked.withColumn(
        "_parsed", markup.parsed_pieces(F.when(~F.col("_plain"), F.col(html)))
    )
    pieces = F.when(F.col("_plain"), markup.token_pieces(F.col("_tokens"))).otherwise(
        F.col("_parsed")
    )
    return parsed.withColumn("pieces", pieces).drop("_tokens", "_plain", "_parsed")


def page_extract(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Add ``title``, ``text`` and ``links``.

    The text is every non-blank data chunk, trimmed: title, script and style
    content included, comments not.
    """
    pieces = F.col("pieces")
    return (
        page_pieces(pages, url, html)
        .withColumn("title", F.array_join(markup.chunks(pieces, "title"), " "))
        .withColumn("text", F.array_join(markup.chunks(pieces, "title", "text"), " "))
        .withColumn("links", markup.links(pieces))
        .drop("pieces")
    )


def page_extract_css(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Add ``title`` (first title only), ``text`` (text nodes of the body) and ``links``."""
    pieces = F.col("pieces")
    return (
        page_pieces(pages, url, html)
        .withColumn("title", markup.first_title(pieces))
        .withColumn("text", markup.body_text(pieces))
        .withColumn("links", markup.links(pieces))
        .drop("pieces")
    )


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(url, pos, href): one row per link, in page order."""
    return page_extract(pages, url, html).select(
        F.col(url).alias("url"), F.posexplode("links").alias("pos", "href")
    )


def site_links(links: DataFrame, host: Column) -> DataFrame:
    """(url, pos, dst): links of (url, pos, href) that stay on ``host``, resolved."""
    return links.withColumn("dst", normalize_link(F.col("url"), F.col("href"), host)).where(
        F.col("dst").isNotNull()
    )


def hostname_links(links: DataFrame, host: Column) -> DataFrame:
    """As ``site_links``, but by lower-cased host name without port."""
    return links.withColumn("dst", resolve_link(F.col("url"), F.col("href"))).where(
        same_hostname(F.col("dst"), host)
    )


def html_responses(pages: DataFrame, content_type: str = "content_type", html: str = "html") -> DataFrame:
    return pages.where(html_only(F.col(content_type), F.col(html)))
