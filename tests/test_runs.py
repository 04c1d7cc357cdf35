"""Runs over time and agreement of many annotators against plain Python; nulls, ties, no rows, clashing names."""

import random
import re
from collections import Counter, defaultdict
from datetime import datetime, timedelta
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from quern.operators import agreement, runs
from quern.operators.frontier import next_level

START = datetime(2026, 1, 1)


@pytest.mark.parametrize("span", [60, 86_400, 10**8])
def test_scores_as_of(spark, span):
    rng = random.Random(7)
    # One case holds most rows; times repeat, some are null.
    def case():
        return rng.choice(["hot"] * 5 + ["b", None])

    def time():
        return rng.choice([None] + [START + timedelta(minutes=rng.randint(0, 4000))] * 9)

    scores = [(case(), time(), rng.choice([None, *range(9)]), i) for i in range(300)]
    asked = [(i, case(), time(), "x") for i in range(200)] + [(0, "hot", START, "x")] * 2
    left = spark.createDataFrame(scores, "case string, at timestamp, score int, run int")
    right = spark.createDataFrame(asked, "id int, case string, at timestamp, score string")
    got = runs.scores_as_of(left, right, "case", span=span).collect()

    def valid(c, t):
        held = [(s[1], s[3], s[2]) for s in scores if c and t and s[0] == c and s[1] and s[1] <= t]
        return max(held)[2] if held else None

    assert Counter(map(tuple, got)) == Counter((*a, valid(a[1], a[2])) for a in asked)
    assert {r.valid_score for r in runs.scores_as_of(left.limit(0), right, "case").collect()} == {None}
    assert runs.scores_as_of(left, right.limit(0), "case").count() == 0


def test_append_run_and_changes(spark, tmp_path):
    path = str(tmp_path / "runs")

    def send(run, *rows):
        runs.append_run(spark.createDataFrame(rows, "id string, score double"), path, run)

    send("1", ("a", 0.5), ("b", 0.5), ("c", 0.5), ("d", 0.5), ("n", None))
    send("2", ("a", 9.0))
    for _ in range(2):
        send("2", ("a", 0.4), ("b", 0.6), ("c", 0.5), ("e", 0.1), ("n", 0.2))
    stored = spark.read.schema("id string, score double, run string").parquet(path)
    assert stored.count() == 10
    changes = runs.run_changes(stored, "1", "2", "id")
    assert {r.id: r.status for r in changes.collect()} == {
        "a": "regressed", "b": "improved", "c": "same", "d": "removed", "e": "added", "n": "added",
    }
    plan = runs.run_changes(stored, "1", "2", "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(run") == 2
    assert runs.run_changes(stored, "8", "9", "id").count() == 0


def _alpha(units, gap):
    """Krippendorff's alpha by all pairs of marks."""
    units = [u for u in units if len(u) > 1]
    marks = [m for u in units for m in u]
    observed = sum(sum(gap(a, b) for a, b in permutations(u, 2)) / (len(u) - 1) for u in units) / len(marks)
    expected = sum(gap(a, b) for a, b in permutations(marks, 2)) / (len(marks) * (len(marks) - 1))
    return observed, expected, 1 - observed / expected


def test_alpha_and_coincidences(spark):
    rng = random.Random(9)
    units = [[min(4, rng.randint(0, 2) + i % 3) for _ in range(rng.randint(0, 6))] for i in range(40)]
    units.append([1] * 300)  # a hot item
    rows = [(i, m, 1) for i, u in enumerate(units) for m in u] + [(0, None, 1), (99, None, 1)]
    marks = spark.createDataFrame(rows, "item int, value int, n int")
    gaps = {"nominal": lambda a, b: a != b, "interval": lambda a, b: (a - b) ** 2}
    for metric, gap in gaps.items():
        got = agreement.krippendorff_alpha(marks, "item", "value", metric).first()
        assert [got.observed, got.expected, got.alpha] == pytest.approx(_alpha(units, gap))
        assert got.items == sum(len(u) > 1 for u in units)
    want = defaultdict(float)
    for u in units:
        for a, b in permutations(u, 2):
            want[a, b] += 1 / (len(u) - 1)
    got = {(r.value, r.other): r.weight for r in agreement.coincidences(marks, "item", "value").collect()}
    assert got == pytest.approx(dict(want))


@pytest.mark.parametrize("metric", ["nominal", "interval"])
def test_alpha_of_nothing(spark, metric):
    marks = spark.createDataFrame([(1, 2), (1, 2), (2, 2), (3, None)], "item int, value int")
    agreed = agreement.krippendorff_alpha(marks, "item", "value", metric).first()
    assert (agreed["items"], agreed.marks, agreed.observed, agreed.expected, agreed.alpha) == (1, 2, 0.0, 0.0, None)
    none = agreement.krippendorff_alpha(marks.limit(0), "item", "value", metric).first()
    assert tuple(none) == (0, 0, None, None, None)
    assert agreement.coincidences(marks.limit(0), "item", "value").count() == 0
    with pytest.raises(ValueError):
        agreement.krippendorff_alpha(marks, "item", "value", "ordinal")


def test_bucketed_links_do_not_move(spark, tmp_path):
    links = spark.range(1000).select(
        F.concat(F.lit("u"), F.col("id") % 50).alias("url"), F.lit(0).alias("pos"), F.col("id").cast("string").alias("dst")
    )
    links.write.option("path", str(tmp_path / "links")).bucketBy(8, "url").saveAsTable("test_links")
    level = links.select("url", F.lit(1).alias("rank")).distinct()
    seen = links.select(F.col("dst").alias("url")).limit(10)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = next_level(level, spark.table("test_links"), seen)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert found.count() == 990
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP TABLE test_links")
    # Only the level is dealt by URL; the links are read from their buckets.
    assert "Bucketed: true" in plan and len(re.findall(r"Exchange hashpartitioning\(url#\d+L?, 8\)", plan)) == 1
