"""Link frontier over stored pages: breadth-first discovery within one site."""

from __future__ import annotations

import uuid
from functools import reduce
from itertools import product
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from quern.functions.urls import LINK_SCHEMES, same_hostname, same_netloc
from quern.session import scratch_path, stage

from .numbering import number_rows
from .pages import hostname_links, page_extract, page_extract_css, site_links
from .robots import robots_filter

# Fixed value: default bound on discovered URLs.
MAX_PAGES = 20

_SEEN = "url string, rank long, depth int"


def url_dedup(links: DataFrame, order: list[str], dst: str = "dst") -> DataFrame:
    """(dst, order columns): every URL once, at its first place.

    Combines on the map side, so a URL that every page links to stays cheap.
    """
    first = F.min(F.struct(*order)).alias("_first")
    return links.groupBy(dst).agg(first).select(dst, "_first.*")


def frontier_anti(links: DataFrame, seen: DataFrame, order: list[str]) -> DataFrame:
    """URLs not yet seen, once each, at their first place."""
    return url_dedup(links, order).join(seen.select(F.col("url").alias("dst")), "dst", "left_anti")


def max_pages_cap(fresh: DataFrame, order: list[str], room: int, start: int = 1) -> DataFrame:
    """The first ``room`` URLs in discovery order, with their ``rank``."""
    return number_rows(fresh, order, "rank", start).where(F.col("rank") < start + room)


def discover(
    edges: DataFrame, start_url: str, max_pages: int | None = None, max_depth: int | None = None
) -> DataFrame:
    """(url, rank, depth) of all URLs reached over ``edges`` (url, pos, dst).

    Ranks are the order in which a single queue would find the URLs: by the
    parent's rank, then by link position. ``max_pages`` bounds the number of
    URLs found, including the start. Links are written once, bucketed by their
    page: a level moves its own rows to the buckets and never the links. Levels
    are written to one folder, so the set of seen URLs is always one table and
    a lost executor costs no level.
    """
    spark = edges.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"quern_links_{uuid.uuid4().hex}"
    # Hash partitions are the buckets, so every task writes one file.
    placed = edges.select("url", "pos", "dst").repartition(buckets, "url").write
    placed.option("path", scratch_path(spark, "links")).bucketBy(buckets, "url").saveAsTable(name)
    links = spark.table(name)
    folder = scratch_path(spark, "seen")

    def level_table(depth: int, rows: DataFrame) -> tuple[DataFrame, int]:
        path, seen = f"{folder}/level={depth}", Observation()
        columns = ["url", F.col("rank").cast("long"), F.lit(depth).alias("depth")]
        counted = rows.select(*columns).observe(seen, F.count(F.lit(1)).alias("rows"))
        counted.write.parquet(path)
        return spark.read.schema(_SEEN).parquet(path), seen.get["rows"]

    start = spark.range(1).select(F.lit(start_url).alias("url"), F.lit(1).alias("rank"))
    level, found = level_table(0, start)
    depth = 0
    while (max_pages is None or found < max_pages) and (max_depth is None or depth < max_depth):
        fresh = next_level(level, links, spark.read.schema(_SEEN).parquet(folder))
        ordered = fresh.select(F.col("dst").alias("url"), F.col("rank").alias("parent"), "pos")
        room = max_pages - found if max_pages else None
        if room:
            ranked = max_pages_cap(ordered, ["parent", "pos"], room, found + 1)
        else:
            ranked = number_rows(ordered, ["parent", "pos"], "rank", found + 1)
        depth += 1
        level, added = level_table(depth, ranked)
        found += added
        if not added:
            break
    # Only the name goes; the files stay until the scratch area is dropped.
    spark.sql(f"DROP TABLE {name}")
    return spark.read.schema(_SEEN).parquet(folder).select("url", "rank", "depth")


def next_level(level: DataFrame, links: DataFrame, seen: DataFrame) -> DataFrame:
    """(dst, rank, pos) of the URLs that ``level`` links to and ``seen`` does not hold."""
    found = level.select("url", "rank").join(links, "url")
    return frontier_anti(found, seen, ["rank", "pos"])


def _site(pages: DataFrame, on_site: Column, rules: DataFrame | None, order: tuple[str, ...]) -> DataFrame:
    """(url, html) of the site: of a URL stored more than once, the first page by
    ``order`` that is not empty, equal places by the smallest markup."""
    mine = pages.where(on_site & (F.coalesce("html", F.lit("")) != ""))
    mine = robots_filter(mine, rules) if rules is not None else mine
    # Narrow rows tell which URLs are stored more than once; only the markup of
    # those is grouped, and of it only what stands at the first place.
    place = F.struct(*order) if order else F.lit(0)
    stored = mine.groupBy("url").agg(F.count(F.lit(1)).alias("_rows"), F.min(place).alias("_first"))
    again = stage(stored.where(F.col("_rows") > 1), "stored")
    once = mine.join(again.select("url"), "url", "left_anti").select("url", "html")
    firsts = mine.join(again, "url").where(place.eqNullSafe(F.col("_first")))
    return once.unionByName(firsts.groupBy("url").agg(F.min("html").alias("html")))


def _may_be_on(host: str) -> Column:
    """What a URL of ``host`` starts with, the scheme in any case; a scan can skip row groups by it."""
    schemes = ["".join(c) for s in LINK_SCHEMES for c in product(*[(x, x.upper()) for x in s])]
    starts = [F.startswith("url", F.lit(f"{scheme}://{host}")) for scheme in schemes]
    return reduce(lambda a, b: a | b, starts)


def bounded_crawl(
    pages: DataFrame,
    start_url: str,
    max_pages: int | None = MAX_PAGES,
    rules: DataFrame | None = None,
    max_depth: int | None = None,
    order: tuple[str, ...] = (),
) -> DataFrame:
    """(url, title, text, depth, rank) of the pages reached from ``start_url``.

    ``pages`` (url, html) stands for the web; a URL that it holds more than once
    is taken once, from its first page by the columns ``order``. Pages of other hosts, pages that
    ``rules`` forbid and empty ones are left out before anything is parsed; their
    URLs still count as found. Each page is parsed once.
    """
    if max_pages is not None and max_pages < 1:
        raise ValueError("max_pages must be at least 1")
    netloc = urlparse(start_url).netloc
    host = F.lit(netloc)
    on_site = _may_be_on(netloc) & same_netloc(F.col("url"), host)
    site = stage(
        page_extract(_site(pages, on_site, rules, order)).select(
            "url", "title", "text", "links"
        ),
        "site",
    )
    links = site.select("url", F.posexplode("links").alias("pos", "href"))
    seen = discover(site_links(links, host), start_url, max_pages, max_depth)
    return seen.join(site.drop("links"), "url").select("url", "title", "text", "depth", "rank")


def follow_links(
    pages: DataFrame,
    start_url: str,
    rules: DataFrame | None = None,
    max_depth: int | None = None,
    order: tuple[str, ...] = (),
) -> DataFrame:
    """As ``bounded_crawl``, with the body-text extraction, host names compared
    without port and case, and no bound on the number of pages."""
    name = F.lit(urlparse(start_url).hostname or "")
    site = stage(
        page_extract_css(_site(pages, same_hostname(F.col("url"), name), rules, order)).select(
            "url", "title", "text", "links"
        ),
        "site",
    )
    links = site.select("url", F.posexplode("links").alias("pos", "href"))
    seen = discover(hostname_links(links, name), start_url, None, max_depth)
    return seen.join(site.drop("links"), "url").select("url", "title", "text", "depth", "rank")
