"""What became of every URL of a crawl: one status per URL, counters, and the seed of the next run."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from quern.functions.text import strip_text

from .robots import forbidden_urls

# Fixed value: pages with fewer characters of text are short.
MIN_PAGE_CHARS = 50
# In the order in which the checks apply.
STATUSES = ("forbidden", "missing", "empty", "short", "stored")
# What a next run should try again.
FAILED = ("missing", "empty")


def crawl_outcomes(
    discovered: DataFrame,
    fetched: DataFrame,
    rules: DataFrame | None = None,
    min_chars: int = MIN_PAGE_CHARS,
) -> DataFrame:
    """(url, status, linked, fetches, n_chars, fetched_at): one row per URL that was found or fetched.

    ``discovered`` (url) and ``fetched`` (url, text, fetched_at) may hold a URL many
    times; both fold to one narrow row per URL before they meet in one outer join, so
    no text is moved and a URL that every page links to stays cheap. A URL counts by
    its longest text; ``fetched_at`` is the time of its last fetch. Rows without a URL
    are left out. Forbidden URLs are those that ``rules`` (host, rules) forbid.
    """
    links = discovered.where("url IS NOT NULL").select("url").distinct().withColumn("linked", F.lit(True))
    size = F.length(strip_text(F.coalesce("text", F.lit(""))))
    pages = fetched.where("url IS NOT NULL").select("url", size.alias("n_chars"), "fetched_at")
    pages = pages.groupBy("url").agg(
        F.count(F.lit(1)).alias("fetches"), F.max("n_chars").alias("n_chars"), F.max("fetched_at").alias("fetched_at")
    )
    every = links.join(pages, "url", "full_outer")
    barred = F.lit(False)
    if rules is not None:
        barred = F.coalesce("barred", F.lit(False))
        every = every.join(forbidden_urls(every, rules).withColumn("barred", F.lit(True)), "url", "left")
    status = (
        F.when(barred, "forbidden")
        .when(F.col("fetches").isNull(), "missing")
        .when(F.col("n_chars") == 0, "empty")
        .when(F.col("n_chars") < min_chars, "short")
        .otherwise("stored")
    )
    return every.select(
        "url",
        status.alias("status"),
        F.coalesce("linked", F.lit(False)).alias("linked"),
        F.coalesce("fetches", F.lit(0).cast("long")).alias("fetches"),
        F.col("n_chars").cast("long").alias("n_chars"),
        "fetched_at",
    )


@dataclass
class CrawlLog:
    """A written crawl log: its folder, and the number of URLs by status, counted while writing."""

    path: str
    counts: dict[str, int]


def write_log(outcomes: DataFrame, path: str) -> CrawlLog:
    """Write outcomes partitioned by status, in one pass, with a count of every status."""
    seen = Observation()
    counted = outcomes.observe(seen, *[F.count_if(F.col("status") == s).alias(s) for s in STATUSES])
    counted.write.mode("overwrite").partitionBy("status").parquet(path)
    return CrawlLog(path, {s: seen.get[s] for s in STATUSES})


_LOG = "url string, linked boolean, fetches long, n_chars long, fetched_at timestamp, status string"


def read_log(spark, log: CrawlLog) -> DataFrame:
    return spark.read.schema(_LOG).parquet(log.path)


def next_seed(spark, log: CrawlLog) -> DataFrame:
    """(url) of linked URLs that failed: only their partitions are read."""
    return read_log(spark, log).where(F.col("status").isin(*FAILED) & F.col("linked")).select("url")
