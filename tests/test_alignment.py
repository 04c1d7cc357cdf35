"""Ordered alignment, pairwise kappa and merged sketches against plain Python; nulls, ties, no rows."""

import random
from collections import defaultdict
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from quern.operators import agreement, alignment, sketches


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b, 1):
            new.append(row[j - 1] + 1 if x == y else max(row[j], new[j - 1]))
        row = new
    return row[-1]


def test_lcs_length(spark):
    rng = random.Random(3)
    # Lengths on both sides of one and two words of bits.
    sizes = [0, 1, 5, 61, 62, 63, 124, 125, 190]
    rows = [(i, *[[rng.choice("abcd") for _ in range(rng.choice(sizes))] for _ in range(2)]) for i in range(60)]
    rows += [(100, ["a"] * 130, ["a"] * 130), (101, ["a"] * 62, ["b"] * 62)]
    frame = spark.createDataFrame(rows, "id int, a array<string>, b array<string>")
    got = {r.id: r.n for r in frame.select("id", alignment.lcs_length(F.col("a"), F.col("b")).alias("n")).collect()}
    assert got == {i: lcs(a, b) for i, a, b in rows}


def test_rouge_l_and_best_contexts(spark):
    rows = [
        (1, "the cat sat on the mat", "the mat: a cat sat", ["x", "cat sat mat", "a cat sat"], "k"),
        (2, None, "word", None, "k"),
        (3, "", "", [None, ""], "k"),
    ]
    frame = spark.createDataFrame(rows, "id int, wanted string, answer string, contexts array<string>, sentence string")
    got = {r.id: (r.n_common, r.precision, r.recall, r.rouge_l) for r in alignment.rouge_l(frame, "id", "wanted", "answer").collect()}
    assert got[1] == pytest.approx((3, 3 / 5, 3 / 6, 6 / 11))
    assert got[2] == got[3] == (0, 0.0, 0.0, 0.0)
    answers = frame.withColumn("answer", F.when(F.col("id") == 1, "Cat sat! mat ... a cat?").otherwise(F.col("answer")))
    best = alignment.best_contexts(answers, "id", "contexts", "answer").collect()
    assert sorted((r.id, r.sentence, r.n_tokens, r.context, r.n_common) for r in best if r.id == 1) == [
        (1, 0, 2, 1, 2), (1, 1, 1, 1, 1), (1, 2, 2, 2, 2),
    ]
    assert [(r.id, r.context, r.n_common) for r in best if r.id > 1] == [(2, None, 0)]
    assert alignment.best_contexts(answers.limit(0), "id", "contexts", "answer").count() == 0


def test_pair_kappas(spark):
    rng = random.Random(4)
    marks = [(i, w, rng.choice("ab")) for i in range(50) for w in "uvwx" if rng.random() < 0.7]
    marks += [(99, "u", "a"), (99, "z", "a"), (1, None, "a"), (None, "u", "a"), (2, "u", None)]
    frame = spark.createDataFrame(marks, "item int, who string, first string")
    held = defaultdict(dict)
    for i, w, m in marks:
        if None not in (i, w, m):
            held[i][w] = max(m, held[i].get(w, m))
    want = {}
    for a, b in combinations("uvwxz", 2):
        both = [(v[a], v[b]) for v in held.values() if a in v and b in v]
        if both:
            n = len(both)
            same = sum(x == y for x, y in both) / n
            chance = sum(sum(x == v for x, _ in both) * sum(y == v for _, y in both) for v in "ab") / n**2
            want[a, b] = n, same, (same - chance) / (1 - chance) if chance < 1 else None
    got = {(r.first, r.second): (r["items"], r.agreement, r.kappa) for r in agreement.pair_kappas(frame, "item", "who", "first").collect()}
    assert got.keys() == want.keys() and got["u", "z"] == (1, 1.0, None)
    assert all(got[k] == pytest.approx(want[k]) for k in want)
    assert agreement.pair_kappas(frame.limit(0), "item", "who", "first").count() == 0


def test_sketches_merge_and_replace(spark, tmp_path):
    path = str(tmp_path / "sketches")
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise("b").alias("model"),
        F.col("id").cast("double").alias("latency"),
        F.when(F.col("id") % 3 > 0, F.col("id") / 2).alias("cost"),
    )
    for batch, low in (("1", 0), ("2", 15_000), ("2", 15_000)):
        sketches.sketch_batch(rows.where(F.col("id") >= low).where(F.col("id") < low + 15_000), path, batch, ["model"], ["latency", "cost"])
    stored = spark.read.schema("model string, latency binary, cost binary, batch string").parquet(path)
    assert stored.count() == 4
    got = sketches.merged_quantiles(stored, ["model"], ["latency", "cost"], [0.1, 0.5, 0.9]).collect()
    assert {(r.model, r.value_name): r.n for r in got} == {("hot", "latency"): 20_000, ("b", "latency"): 10_000, ("hot", "cost"): 20_000}
    for r in got:
        scale = 15_000 if r.value_name == "cost" else 30_000
        assert abs(r.estimate / scale - r["quantile"]) <= sketches.RANK_ERROR
    assert sketches.merged_quantiles(stored.limit(0), ["model"], ["latency"], [0.5]).count() == 0
