"""Crawl of a stored site to JSON Lines."""

from __future__ import annotations

from pyspark.sql import DataFrame

from quern.operators.frontier import MAX_PAGES, bounded_crawl, follow_links
from quern.sources.sinks import write_jsonl_counted


def _write(found: DataFrame, target: str) -> int:
    return write_jsonl_counted(found.select("rank", "url", "title", "text"), target, "rank", keep_order=False)


def site_extract(
    pages: DataFrame,
    start_url: str,
    target: str,
    max_pages: int | None = MAX_PAGES,
    rules: DataFrame | None = None,
) -> int:
    """Bounded crawl from ``start_url``; returns the number of pages written."""
    return _write(bounded_crawl(pages, start_url, max_pages, rules), target)


def site_extract_css(
    pages: DataFrame, start_url: str, target: str, rules: DataFrame | None = None
) -> int:
    """Unbounded crawl by host name with body-text extraction."""
    return _write(follow_links(pages, start_url, rules), target)
