"""Whitening and clustering of vectors against brute force."""

import hashlib
import random

import numpy as np
import pytest

from quern.llm import centroids, whitening
from quern.llm.centroids import cluster
from quern.llm.vectors import scaled
from quern.llm.whitening import whiten

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<double>, label int, x string, id long, n long, cluster int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 7, 9, 3) for i, v in rows], SCHEMA)


def whole(v):
    return [int(np.floor(256 * c)) for c in v]


def brute_whitening(rows, components):
    """Plain covariance and eigenvectors, in longs and long doubles."""
    fit = np.array(sorted({tuple(whole(v)) for _, v in rows}), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    a = (fit * n - sums).astype(np.float64) / n
    values, vectors = np.linalg.eigh(a.T @ a / n)
    order = np.argsort(-values)[:components]
    out = {}
    for i, v in rows:
        off = np.array(whole(v), dtype=object) * n - sums
        white = (off.astype(np.float64) / n) @ vectors[:, order] / np.sqrt(values[order])
        out.setdefault(i, []).append((int((off**2).sum()), white))
    return n, out, values[order] / values.sum()


def check_whitening(spark, rows, found, components=4):
    n, want, explained = brute_whitening(rows, components)
    assert found and all(r.n == n and r.identity_error <= 1e-9 for r in found)
    signs = {}
    for c in range(1, components + 1):
        mine = [r for r in found if r.component == c]
        assert len(mine) == len(rows)
        for r in mine:
            assert r.explained == pytest.approx(explained[c - 1], rel=1e-9)
            deviation, white = next(w for w in want[r.vec_id])
            assert r.deviation == deviation
            if abs(white[c - 1]) > 1e-3:
                signs.setdefault(c, np.sign(white[c - 1] * r.whitened))
            assert r.whitened * signs.get(c, 1) == pytest.approx(white[c - 1], abs=1e-7)


def test_whitening_matches_plain_eigenvectors(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    check_whitening(spark, rows, whiten(vectors).collect())


def test_whitening_counts_equal_vectors_once_and_takes_few_directions(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(60, 3))
    wide = np.hstack([base, base @ rng.normal(size=(3, 3)).round(), np.ones((60, 1))])
    rows = [(i % 50, whole_grid(v)) for i, v in enumerate(wide)]
    rows += [(100 + i, rows[0][1]) for i in range(200)]
    found = whiten(table(spark, rows), count=3).collect()
    n = len({tuple(v) for _, v in rows})
    assert {r.n for r in found} == {n} and len(found) == 3 * len(rows)
    assert max(r.identity_error for r in found) <= 1e-6
    # The fourth to seventh directions hold no more than what rounding to 1/256 leaves.
    everything = whiten(table(spark, rows), count=7).collect()
    assert sum(r.explained for r in everything if r.vec_id == 100 and r.component > 3) < 1e-3


def whole_grid(v):
    return [float(np.floor(256 * c) / 256) for c in v]


def test_rank_deficient_rows_give_only_directions_with_variance(spark):
    rows = [(i, [float(a), 2.0 * a, 3.0, float(b), -float(a)]) for i, (a, b) in enumerate((a, b) for a in range(9) for b in range(7))]
    found = whiten(table(spark, rows)).collect()
    assert {r.component for r in found} == {1, 2}
    check_whitening(spark, rows, found, components=2)


def test_whitening_edge_cases(spark):
    assert whiten(table(spark, [])).count() == 0
    assert whiten(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    rows = [(1, [0.0, 1.0]), (2, [1.0, 0.0]), (2, [1.0, 1.0]), (None, [2.0, 5.0])]
    bad = [(3, None), (4, []), (5, [NAN, 1.0]), (6, [1.0, None]), (7, [INF, 1.0]), (8, [1.0, 2.0, 3.0])]
    found = whiten(table(spark, rows + bad)).collect()
    assert sorted((r.vec_id is None, r.vec_id or 0, r.component) for r in found) == sorted((i is None, i or 0, c) for i, _ in rows for c in (1, 2))
    assert {r.n for r in found} == {4}
    huge = [(i, [1e15 * (i % 3), 1e15 * (i // 3), 1.0]) for i in range(9)]
    found = whiten(table(spark, huge)).collect()
    assert {r.deviation for r in found} == {None, 0} and max(r.identity_error for r in found) < 1e-6


def brute_clusters(rows, k=40, rounds=5):
    x = np.array([whole(v) for _, v in rows], dtype=np.int64)
    hashes = [hashlib.sha256(f"2:{i}".encode()).hexdigest() for i, _ in rows]
    order = sorted(range(len(rows)), key=lambda j: (hashes[j], rows[j][1]))
    c = x[order[:k]]

    def assign():
        d = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
        return d.argmin(axis=1), d

    for _ in range(rounds):
        label, _ = assign()
        c = np.array([x[label == j].sum(axis=0) // (label == j).sum() if (label == j).any() else c[j] for j in range(len(c))])
    label, d = assign()
    distance = d[np.arange(len(x)), label]
    digest = [hashlib.sha256(",".join(map(str, v)).encode()).hexdigest() for v in c.tolist()]
    return sorted((i, int(a), int(s), int(distance[label == a].sum()), int(distance.sum()), digest[a]) for (i, _), a, s in zip(rows, label, distance))


def check_clusters(spark, rows, **options):
    scans = []
    found = cluster(table(spark, rows), scans=scans, **options)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    names = {"k", "rounds"} & set(options)
    assert sorted(tuple(r) for r in found.collect()) == brute_clusters(rows, **{n: options[n] for n in names})
    return scans


def test_clusters_match_plain_rounds_and_rescan_few(spark, monkeypatch):
    monkeypatch.setattr(centroids, "BLOCK", 300)
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    scans = check_clusters(spark, rows)
    assert scans[0] == len(rows)
    rng = np.random.default_rng(1)
    far = [(i, (10 * (np.arange(64) % 8 == i % 8) + 0.05 * rng.normal(size=64)).tolist()) for i in range(1600)]
    scans = check_clusters(spark, far, k=8, rounds=5)
    assert scans[0] == 1600 and scans[-1] < 400


def test_ties_copies_and_empty_clusters(spark, monkeypatch):
    monkeypatch.setattr(centroids, "BLOCK", 16)
    rng = random.Random(3)
    grid = [(i, [float(rng.choice([-1, 0, 1])) for _ in range(4)] + [0.0] * 60) for i in range(200)]
    same = [(200 + i, [0.5] * 64) for i in range(100)]
    check_clusters(spark, grid + same, k=12)
    check_clusters(spark, same, k=5)
    check_clusters(spark, grid[:3])
    check_clusters(spark, [(i, [1e6 * (i % 7), -1e6 * (i % 3)] + [float(i)] * 62) for i in range(60)], k=4)


def test_cluster_edge_cases(spark):
    assert cluster(table(spark, [])).count() == 0
    good = [(1, [1.0] * 64), (1, [1.0] * 64), (2, [0.0] * 64)]
    bad = [(3, None), (4, []), (5, [NAN] * 64), (6, [None] + [1.0] * 63), (7, [INF] * 64), (8, [1.0] * 63)]
    assert sorted(tuple(r) for r in cluster(table(spark, good + bad)).collect()) == brute_clusters(good)
    assert cluster(table(spark, bad)).count() == 0
    odd = cluster(table(spark, [(None, [1.0] * 64), (3, [1e300] * 64), (4, [-1e300] * 64)]), k=2).collect()
    assert len(odd) == 3 and all(r.distance >= 0 for r in odd)


def test_plans_join_states_without_an_exchange(spark, capsys):
    seen = []
    monkey = centroids._joined

    def noted(blocks, state):
        out = monkey(blocks, state)
        seen.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    centroids._joined = noted
    try:
        check_clusters(spark, [(i, [float(i % 9)] * 64) for i in range(300)], k=3)
    finally:
        centroids._joined = monkey
    assert len(seen) == 6 and all("Exchange" not in plan for plan in seen)


def test_scaled_saturates():
    import pyarrow as pa

    got = scaled(pa.array([[0.1, -0.1], [1e300, -1e300]]), 2).tolist()
    assert got == [[25, -26], [2**63 - 1, -(2**63)]]
    assert whitening.solve_right(np.array([[2.0, 8.0]]), np.array([[2.0, 3.0], [0.0, 5.0]])).tolist() == [[1.0, 1.0]]
