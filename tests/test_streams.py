"""Event-time deduplication, indexed state, prefix rules and crawl outcomes."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quern.operators import crawl
from quern.operators.near import near_dup_pairs
from quern.operators.robots import forbidden_urls, robots_filter, rules_for_agent
from quern.streaming import state as state_module
from quern.streaming.events import deduplicate_stream, progress_counts
from quern.streaming.state import FingerprintState

START = datetime(2024, 1, 1)


def events(spark, *rows):
    return spark.createDataFrame([(i, START + timedelta(minutes=m)) for i, m in rows], "id long, ts timestamp")


def run(spark, path, rows):
    events(spark, *rows).coalesce(1).write.mode("append").parquet(f"{path}/in")
    stream = spark.readStream.schema("id long, ts timestamp").parquet(f"{path}/in")
    query = deduplicate_stream(stream, f"{path}/out", f"{path}/checkpoint", ["id"], "ts", "10 minutes")
    query.awaitTermination()
    return progress_counts(query), query


def kept(spark, path):
    return sorted(r.id if r.id is not None else -1 for r in spark.read.schema("id long, ts timestamp").parquet(f"{path}/out/*").collect())


def test_late_and_repeated_events(spark, tmp_path):
    counts, _ = run(spark, tmp_path, [(1, 0), (1, 0), (2, 30), (None, 30)])
    assert counts == {"read": 4, "late": 0}
    # The watermark is at minute 20 now: minute 10 is late, minute 25 is not.
    counts, query = run(spark, tmp_path, [(3, 10), (4, 25), (2, 30), (None, 31)])
    assert counts == {"read": 4, "late": 1}
    # Nothing new: a restart adds nothing.
    stream = spark.readStream.schema("id long, ts timestamp").parquet(f"{tmp_path}/in")
    again = deduplicate_stream(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint", ["id"], "ts", "10 minutes")
    again.awaitTermination()
    assert kept(spark, tmp_path) == [-1, 1, 2, 4]
    # Keys of long ago are forgotten, so the state does not grow with the stream.
    counts, query = run(spark, tmp_path, [(5, 500)])
    run(spark, tmp_path, [(6, 501)])
    assert query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] <= 2
    assert kept(spark, tmp_path) == [-1, 1, 2, 4, 5, 6]


def prints(rng, n):
    base = [rng.getrandbits(64) for _ in range(n)]
    near = [b ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for b in base]
    return [x - (1 << 64) if x >> 63 else x for x in base + near]


def test_state_gives_all_that_can_be_near_and_compacts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(state_module, "COMPACT_AFTER", 2)
    rng = random.Random(4)
    values = prints(rng, 40)
    rng.shuffle(values)
    rows = [(f"k{i}".encode(), i, fp) for i, fp in enumerate(values)]
    table = spark.createDataFrame(rows, "key binary, seq long, fp long")
    held = FingerprintState(spark, f"{tmp_path}/state", bucket_bits=3)
    size = 16
    for batch in range(5):
        held.compact(batch)
        now = table.where(F.col("seq").between(batch * size, batch * size + size - 1))
        given = now.select("seq", "fp")
        known = held.known(given, batch)
        want = near_dup_pairs(given, known=table.where(F.col("seq") < batch * size).select("seq", "fp"))
        got = near_dup_pairs(given, known=known.select("seq", "fp"))
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
        # A batch that runs again sees the same.
        held.commit(now, batch)
        assert sorted(r.seq for r in held.known(given, batch).collect()) == sorted(r.seq for r in known.collect())
        held.commit(now, batch)
    assert held._folders("base") and len(held._live(5)) <= 3
    assert sorted(r.seq for r in held._read(held._live(5)).where("mask = 0").collect()) == list(range(80))
    one = held.known(table.where("seq = 3"), 5)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    scan = held._read(held._live(5))
    assert {r.seq for r in one.collect()} < {r.seq for r in scan.collect()} and 3 in {r.seq for r in one.collect()}


def test_empty_state_and_batch(spark, tmp_path):
    held = FingerprintState(spark, f"{tmp_path}/none")
    table = spark.createDataFrame([(b"k", 1, 5)], "key binary, seq long, fp long")
    assert held.known(table, 0).count() == 0 and not held.compact(0)
    held.commit(table.limit(0), 0)
    held.commit(table, 1)
    assert held.known(table.limit(0), 2).count() == 0 and held.known(table, 2).count() == 1 and held.known(table, 1).count() == 0


def test_a_host_with_very_many_rules(spark):
    rng = random.Random(7)
    paths = [f"/{rng.randrange(10**6)}/{'x' * (i % 20)}" for i in range(100_000)]
    rules = [(p, i % 3 == 0) for i, p in enumerate(paths)] + [("*", True)]
    table = spark.createDataFrame([("big.example", rules)], "host string, rules array<struct<path:string,allow:boolean>>")
    picked = [f"http://big.example{rng.choice(paths)}/tail{i}" for i in range(300)] + ["http://big.example", "http://other.example/x", None]
    want = set()
    for url in picked:
        path = (url or "").removeprefix("http://big.example") or "/"
        first = next((allow for p, allow in rules if p == "*" or path.startswith(p)), True) if url and "big" in url else True
        if not first:
            want.add(url)
    urls = spark.createDataFrame([(u, 1) for u in picked], "url string, host int")
    found = forbidden_urls(urls.select("url"), table)
    assert {r.url for r in found.collect()} == want and want
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()
    allowed = robots_filter(urls, table)
    assert allowed.columns == urls.columns and {r.url for r in allowed.collect()} == {u for u in picked if u and u not in want}
    assert {r.url for r in forbidden_urls(urls.select("url"), table, hot_rows=5).collect()} == want


@pytest.fixture
def outcomes(spark):
    long = "a page with more than fifty characters of text, so it is stored"
    found = [("http://a/1",), ("http://a/1",), ("http://a/2",), ("http://a/3",), ("http://a/no/4",), ("http://a/5",), (None,)]
    pages = [("http://a/1", long, 5), ("http://a/1", "", 9), ("http://a/2", " \n", None), ("http://a/3", "short", 3), ("http://a/6", None, 4), ("http://a/no/7", long, 1), (None, long, 1)]
    fetched = spark.createDataFrame([(u, t, None if m is None else START + timedelta(minutes=m)) for u, t, m in pages], "url string, text string, fetched_at timestamp")
    robots = spark.createDataFrame([("a", 0, True, ["*"], [("/no/", False)])], "host string, entry int, is_default boolean, agents array<string>, rules array<struct<path:string,allow:boolean>>")
    return crawl.crawl_outcomes(spark.createDataFrame(found, "url string"), fetched, rules_for_agent(robots, "Bot"))


def test_every_url_has_one_status(spark, outcomes, tmp_path):
    got = {r.url: (r.status, r.linked, r.fetches, r.fetched_at and (r.fetched_at - START).seconds // 60) for r in outcomes.collect()}
    assert outcomes.count() == len(got) == 7
    assert got == {
        "http://a/1": ("stored", True, 2, 9),
        "http://a/2": ("empty", True, 1, None),
        "http://a/3": ("short", True, 1, 3),
        "http://a/no/4": ("forbidden", True, 0, None),
        "http://a/5": ("missing", True, 0, None),
        "http://a/6": ("empty", False, 1, 4),
        "http://a/no/7": ("forbidden", False, 1, 1),
    }
    log = crawl.write_log(outcomes, f"{tmp_path}/log")
    assert log.counts == {"forbidden": 2, "missing": 1, "empty": 2, "short": 1, "stored": 1}
    seed = crawl.next_seed(spark, log)
    assert sorted(r.url for r in seed.collect()) == ["http://a/2", "http://a/5"]
    assert "PartitionFilters: [" in seed._jdf.queryExecution().executedPlan().toString()


def test_crawl_outcomes_of_nothing(spark, outcomes, tmp_path):
    nothing = spark.createDataFrame([], "url string")
    pages = spark.createDataFrame([], "url string, text string, fetched_at timestamp")
    log = crawl.write_log(crawl.crawl_outcomes(nothing, pages), f"{tmp_path}/log")
    assert set(log.counts.values()) == {0} and crawl.next_seed(spark, log).count() == 0
