"""Event-time queries over ``events``, and the outcomes of a crawl over ``pages``."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.catalog import query, sql, table
from quern.catalog.pages import _LINKS, _NETLOC, _RESOLVED, _all_links, _pages, _robots
from quern.operators import crawl, pages
from quern.operators.robots import robots_rules, rules_for_agent
from quern.session import scratch_path, stage
from quern.streaming.events import deduplicate_stream, progress_counts, utc_micros

BATCHES = 5
DELAY_MINUTES = 600

# Every event arrives in the batch of its time. One in seven arrives a second time a batch
# later, one in eleven only two batches later; what the watermark has passed by then is late.
_ARRIVALS = f"""timed AS (
      SELECT event_id, ts, epoch_us(ts) AS us, min(epoch_us(ts)) OVER () AS first, max(epoch_us(ts)) OVER () AS last FROM events
      WHERE ts IS NOT NULL AND event_id IS NOT NULL),
    placed AS (
      SELECT event_id, us, least({BATCHES} - 1, (us - first) * {BATCHES} // (last - first + 1)) AS own FROM timed),
    arrivals AS (
      SELECT event_id, us, CASE WHEN event_id % 11 = 0 THEN least(own + 2, {BATCHES} - 1) ELSE own END AS batch FROM placed
      UNION ALL SELECT event_id, us, least(own + 1, {BATCHES} - 1) FROM placed WHERE event_id % 7 = 0),
    marks AS (
      SELECT batch, max(max(us)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest
      FROM arrivals GROUP BY batch),
    judged AS (
      SELECT event_id, batch, us <= coalesce((newest // 1000 - {DELAY_MINUTES} * 60000) * 1000, -1) AS late
      FROM arrivals JOIN marks USING (batch)),
    firsts AS (SELECT event_id, min(batch) AS batch FROM judged WHERE NOT late GROUP BY event_id)"""


def _arrivals(spark, sf):
    """(event_id, ts, batch): the events in the order in which they arrive."""
    events = table(spark, sf, "events").where("ts IS NOT NULL AND event_id IS NOT NULL").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    us = utc_micros("ts")
    first, last = events.agg(F.min(us), F.max(us)).first()
    if first is None:
        first = last = 0
    own = F.least(F.lit(BATCHES - 1), F.expr(f"(unix_micros(ts) - {first}) * {BATCHES} div {last - first + 1}"))
    late = F.when(F.col("event_id") % 11 == 0, F.least(own + 2, F.lit(BATCHES - 1))).otherwise(own)
    again = events.where(F.col("event_id") % 7 == 0).withColumn("batch", F.least(own + 1, F.lit(BATCHES - 1)))
    return events.withColumn("batch", late).unionByName(again)


def _stream_run(spark, sf):
    """(folder of results, counts by batch): the stream is taken up anew for every batch."""
    path = scratch_path(spark, "events")
    arrivals = stage(_arrivals(spark, sf).withColumn("batch", F.col("batch").cast("int")), "arrivals")
    counts = []
    for batch in range(BATCHES):
        part = arrivals.where(F.col("batch") == batch)
        part.write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(arrivals.schema).parquet(f"{path}/in")
        started = deduplicate_stream(
            stream, f"{path}/out", f"{path}/checkpoint", ["event_id"], "ts", f"{DELAY_MINUTES} minutes"
        )
        started.awaitTermination()
        counts.append((batch, *progress_counts(started).values()))
    return f"{path}/out", counts


@query("event_time_dedup", f"WITH {_ARRIVALS} SELECT event_id, batch::INTEGER AS batch FROM firsts")
def event_time_dedup(spark, sf):
    """The first arrival in time of every event."""
    out, _ = _stream_run(spark, sf)
    return spark.read.schema("event_id long, ts timestamp, batch int").parquet(f"{out}/*").select("event_id", "batch")


@query(
    "event_time_counts",
    f"""WITH {_ARRIVALS}, read AS (SELECT batch, count(*) AS read, count(*) FILTER (late) AS late FROM judged GROUP BY batch)
    SELECT r.batch::INTEGER AS batch, read, late, coalesce(kept, 0) AS kept, read - late - coalesce(kept, 0) AS repeated
    FROM read r LEFT JOIN (SELECT batch, count(*) AS kept FROM firsts GROUP BY batch) k USING (batch)""",
)
def event_time_counts(spark, sf):
    """Per batch: arrivals, late ones (as the state operator counts them), kept and repeated ones."""
    out, counts = _stream_run(spark, sf)
    kept = spark.read.schema("event_id long, ts timestamp, batch int").parquet(f"{out}/*").groupBy("batch").agg(F.count(F.lit(1)).alias("kept"))
    seen = spark.createDataFrame(counts, "batch int, read long, late long")
    joined = seen.where("read > 0").join(kept, "batch", "left").withColumn("kept", F.coalesce("kept", F.lit(0).cast("long")))
    return joined.select("batch", "read", "late", "kept", (F.col("read") - F.col("late") - F.col("kept")).alias("repeated"))


AGENT = "QuernBot/1.0 (stored pages)"
# Pages are fetched when the event of their number happened.
_CRAWL = f"""hosts AS (SELECT {_NETLOC} AS host, min(page_id) % 4 AS kind FROM pages GROUP BY 1), {_LINKS},
    found AS (SELECT DISTINCT {_RESOLVED} AS url FROM links),
    fetched AS (
      SELECT url, count(*) AS fetches, max(length({sql.strip(sql.page_text('html'))})) AS n_chars, max(epoch_us(ts)) AS us
      FROM pages LEFT JOIN (SELECT event_id, min(ts) AS ts FROM events GROUP BY event_id) ON event_id = page_id GROUP BY url),
    every AS (
      SELECT coalesce(f.url, p.url) AS url, f.url IS NOT NULL AS linked, coalesce(fetches, 0) AS fetches, n_chars, us
      FROM found f FULL JOIN fetched p ON p.url = f.url),
    paths AS (
      SELECT *, {_NETLOC} AS host, substr(url, length({sql.SITE.format('url')}) + 1) AS path FROM every),
    outcomes AS (
      SELECT url, linked, fetches, n_chars, us, CASE
        WHEN coalesce(CASE kind WHEN 0 THEN starts_with(path, '/en/') WHEN 1 THEN false WHEN 2 THEN true
          ELSE NOT starts_with(path, '/de/') AND (starts_with(path, '/de') OR starts_with(path, '/fr/4')) END, false) THEN 'forbidden'
        WHEN fetches = 0 THEN 'missing' WHEN n_chars = 0 THEN 'empty' WHEN n_chars < 50 THEN 'short' ELSE 'stored' END AS status
      FROM paths LEFT JOIN hosts USING (host))"""


def _crawl_log(spark, sf):
    """The crawl of all pages: links found, pages stored with the time of their fetch."""
    times = table(spark, sf, "events").groupBy(F.col("event_id").alias("page_id")).agg(F.min("ts").cast("timestamp").alias("fetched_at"))
    texts = pages.page_extract(_pages(spark, sf)).select("page_id", "url", "text")
    fetched = texts.join(times, "page_id", "left")
    rules = rules_for_agent(robots_rules(_robots(spark, sf)), AGENT)
    found = _all_links(spark, sf).select(F.col("dst").alias("url"))
    return crawl.write_log(crawl.crawl_outcomes(found, fetched, rules), scratch_path(spark, "crawl"))


@query(
    "crawl_outcomes",
    f"WITH {_CRAWL} SELECT url, status, linked, fetches, n_chars, us AS fetched_us FROM outcomes",
)
def crawl_outcomes(spark, sf):
    """One status for every URL that a page links to or that is stored."""
    log = crawl.read_log(spark, _crawl_log(spark, sf))
    return log.select("url", "status", "linked", "fetches", "n_chars", F.unix_micros("fetched_at").alias("fetched_us"))


@query(
    "crawl_counts",
    f"""WITH {_CRAWL} SELECT s.status, count(o.url) AS urls FROM (VALUES
      ('forbidden'), ('missing'), ('empty'), ('short'), ('stored')) s(status) LEFT JOIN outcomes o USING (status) GROUP BY 1""",
)
def crawl_counts(spark, sf):
    """The counters that were taken while the log was written."""
    return spark.createDataFrame(list(_crawl_log(spark, sf).counts.items()), "status string, urls long")


@query("crawl_next_seed", f"WITH {_CRAWL} SELECT url FROM outcomes WHERE status IN ('missing', 'empty') AND linked")
def crawl_next_seed(spark, sf):
    return crawl.next_seed(spark, _crawl_log(spark, sf))
