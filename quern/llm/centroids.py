"""Exact k-means with heap-ordered bounds.

Components become integers x = floor(256 * c); all decisions are exact on them.

Vectors are packed into blocks of BLOCK rows and written once, bucketed by block. A
round's state is a second table with the same buckets, so joining a block to its state
moves nothing: for every cluster of a block a heap of its vectors, ordered by the gap
between the lower bound on the distance to any other centroid and the distance to the
own one. A gap is stored plus the cluster's accumulated drift at that time. When
centroids move, only the drift of each cluster grows (by its own move and the largest
move of another); no vector's bound is touched. In the next round the vectors whose
stored gap is not above the drift are popped and compared exactly with all centroids;
all others keep their cluster without any distance being computed. Heaps are sorted
arrays, so the popped ones are a prefix. A block's changes of sums and counts go with
its state; adding those up gives the next centroids.

Ties go to the smaller centroid: a vector at equal distance from two has a gap of 0
and is rescanned in every round. Bounds are lowered by a margin far above the rounding
error of square roots.

Only k centroids (k x dimensions integers) and their sums reach the driver.

Defined results: vectors that are null, of another length, or hold null or non-finite
entries take no part; equal ids and vectors are rows of their own; first centroids are
ordered by the hash of their id, then by vector; with fewer than k vectors there are as
many centroids as vectors, with none no rows; a null id hashes as an empty one. A
distance that does not fit a long is given as the largest long.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from decimal import Decimal
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type

from quern.llm.common import Staging
from quern.llm.vectors import planned_bytes, scaled, sound
from quern.session import hadoop_path

K = 40
ROUNDS = 5
DIMENSIONS = 64
SEED = "2:"
BLOCK = 2_048
# Bytes of input to a bucket.
BUCKET_BYTES = 64 << 20
# Taken off a gap, as a share of the distances, against rounding.
MARGIN = 1e-9
_LARGEST = 2**63 - 1

_STATE = (
    "block long, labels binary, keys binary, rows binary, ends array<int>, scanned long, "
    "moved array<struct<cluster:int,count:long,sums:array<decimal(38,0)>>>"
)


def _blocks(batches: Iterator[pa.RecordBatch], dimensions: int) -> Iterator[pa.RecordBatch]:
    """Rows (id, vector) packed into blocks; a block's number holds the task's partition."""
    made = TaskContext.get().partitionId() << 33
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            x = scaled(part.column(1), dimensions)
            kind = next((k for k in (np.int16, np.int32) if np.iinfo(k).min <= x.min() and x.max() <= np.iinfo(k).max), np.int64)
            ids = pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part.column(0))
            yield pa.RecordBatch.from_arrays(
                [pa.array([made]), ids, pa.array([np.dtype(kind).itemsize], pa.int32()), pa.array([x.astype(kind).tobytes()], pa.binary())],
                names=["block", "ids", "width", "points"],
            )
            made += 1


def squared(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to centroids; Python integers where longs do not do."""
    largest = max(int(np.abs(x.astype(np.float64)).max()), int(np.abs(centroids.astype(np.float64)).max()), 1)
    if 4 * x.shape[1] * largest * largest < 2**53:  # every sum below is a whole number that a double holds
        a, c = x.astype(np.float64), centroids.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] - 2 * (a @ c.T) + (c * c).sum(axis=1)).astype(np.int64)
    a, c = x.astype(object), centroids.astype(object)
    return np.array([[sum((p - q) ** 2 for p, q in zip(row, centre)) for centre in c] for row in a], dtype=object)


def nearest_two(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest centroid, ties to the smaller; gap between the second and first distance, less a margin)."""
    found = squared(x, centroids)
    label = found.argmin(axis=1) if found.dtype != object else np.array([min(range(len(r)), key=r.__getitem__) for r in found])
    every = np.arange(len(x))
    first = np.sqrt(found[every, label].astype(np.float64))
    if len(centroids) == 1:
        return label, np.full(len(x), np.inf)
    others = found.copy()
    others[every, label] = others.max() + 1 if others.dtype == object else np.iinfo(np.int64).max
    second = np.sqrt(others.min(axis=1).astype(np.float64))
    return label, second - first - MARGIN * (1 + first + second)


def _assigned(row: dict, centroids: np.ndarray, drift: np.ndarray):
    """(points, labels, labels before, heaps, number rescanned) of one block after popping what expired.

    ``heaps`` is (keys, rows, ends): the vectors by cluster, each cluster's by rising key.
    """
    k, d = centroids.shape
    x = np.frombuffer(row["points"], dtype=f"<i{row['width']}").reshape(-1, d).astype(np.int64)
    if row.get("labels") is None:
        before = np.full(len(x), -1, dtype=np.int32)
        expired = np.arange(len(x))
        kept_keys, kept_rows = [np.zeros(0)] * k, [np.zeros(0, np.int32)] * k
    else:
        before = np.frombuffer(row["labels"], dtype=np.int32)
        keys, rows = np.frombuffer(row["keys"]), np.frombuffer(row["rows"], dtype=np.int32)
        ends = [0, *row["ends"]]
        popped, kept_keys, kept_rows = [], [], []
        for c in range(k):
            own_keys, own_rows = keys[ends[c] : ends[c + 1]], rows[ends[c] : ends[c + 1]]
            cut = int(np.searchsorted(own_keys, drift[c], side="right"))
            popped.append(own_rows[:cut])
            kept_keys.append(own_keys[cut:])
            kept_rows.append(own_rows[cut:])
        expired = np.concatenate(popped).astype(np.int64)
    labels = before.copy()
    if len(expired):
        label, gap = nearest_two(x[expired], centroids)
        labels[expired] = label
        fresh = gap + drift[label]
        for c in np.unique(label):
            own = label == c
            joined = np.concatenate([kept_keys[c], fresh[own]])
            order = np.argsort(joined, kind="stable")
            kept_keys[c] = joined[order]
            kept_rows[c] = np.concatenate([kept_rows[c], expired[own].astype(np.int32)])[order]
    ends = np.cumsum([len(r) for r in kept_rows]).tolist()
    return x, labels, before, (np.concatenate(kept_keys), np.concatenate(kept_rows).astype(np.int32), ends), len(expired)


def _step(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, drift: np.ndarray, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """One round over blocks (and their states): new states. The last block of a task has what changed in sums and counts."""
    k, d = centroids.shape
    counts, sums = [0] * k, [[0] * d for _ in range(k)]
    held = None
    for batch in batches:
        for row in batch.to_pylist():
            if held is not None:
                yield pa.RecordBatch.from_pylist([held], schema)
            x, labels, before, (keys, rows, ends), scanned = _assigned(row, centroids, drift)
            changed = np.flatnonzero(labels != before)
            wide = x if np.abs(x.astype(np.float64)).max() < 2**50 else x.astype(object)
            for c in np.union1d(labels[changed], before[changed]).tolist():
                if c >= 0:
                    came, went = changed[labels[changed] == c], changed[before[changed] == c]
                    counts[c] += len(came) - len(went)
                    sums[c] = [a + int(b) for a, b in zip(sums[c], wide[came].sum(axis=0) - wide[went].sum(axis=0))]
            held = {
                "block": row["block"], "labels": labels.astype(np.int32).tobytes(), "keys": keys.tobytes(), "rows": rows.tobytes(),
                "ends": ends, "scanned": scanned, "moved": [],
            }
    if held is not None:
        held["moved"] = [
            {"cluster": c, "count": counts[c], "sums": [Decimal(s) for s in sums[c]]} for c in range(k) if counts[c] or any(sums[c])
        ]
        yield pa.RecordBatch.from_pylist([held], schema)


def _results(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, drift: np.ndarray, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """The last assignment: (id, cluster, distance) of every vector."""
    for batch in batches:
        for at, row in enumerate(batch.to_pylist()):
            x, labels, *_ = _assigned(row, centroids, drift)
            off = x.astype(object) - centroids[labels].astype(object) if np.abs(x.astype(np.float64)).max() >= 2**25 else x - centroids[labels]
            distance = [min(int(v), _LARGEST) for v in (off * off).sum(axis=1)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["ids"], kind), pa.array(labels.astype(np.int32)), pa.array(distance, pa.int64())], names=["id", "cluster", "distance"]
            )


class _Tables:
    """Bucketed tables of one call, in the shared scratch folder; dropped when done."""

    def __init__(self, staging: Staging, buckets: int):
        self.spark, self.root, self.buckets = staging.spark, staging.root, buckets
        self.names: list[str] = []

    def write(self, df: DataFrame) -> DataFrame:
        name = f"quern_{uuid.uuid4().hex}"
        df.write.format("parquet").bucketBy(self.buckets, "block").option("path", f"{self.root}/{name}").saveAsTable(name)
        self.names.append(name)
        return self.spark.table(name)

    def drop(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            files, target = hadoop_path(self.spark, f"{self.root}/{name}")
            files.delete(target, True)
        self.names = [n for n in self.names if n not in names]


def _moves(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """What each cluster's drift grows by: its own move and the largest move of another."""
    own = np.sqrt(((after.astype(object) - before.astype(object)) ** 2).sum(axis=1).astype(np.float64))
    order = np.sort(own)
    other = np.where(own == order[-1], order[-2] if len(own) > 1 else 0.0, order[-1])
    if len(own) > 1 and (own == order[-1]).sum() > 1:
        other = np.full(len(own), order[-1])
    return (own + other) * (1 + MARGIN)


def cluster(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = K,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    seed: str = SEED,
    scans: list[int] | None = None,
) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) per vector.

    ``scans``, where given, gets the number of vectors rescanned in each round.
    """
    spark = vectors.sparkSession
    staging = Staging(spark, "centroids")
    held = vectors.where(sound(vector_col) & (F.size(vector_col) == dimensions))
    held = held.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    hashed = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    whole = F.transform("vector", lambda c: F.floor(c.cast("double") * 256))
    first = held.select(hashed.alias("h"), "vector").orderBy("h", "vector").limit(k).select(whole.alias("x")).collect()
    # Spark allows 100,000 buckets at most.
    buckets = min(max(spark.sparkContext.defaultParallelism, planned_bytes(vectors) // BUCKET_BYTES), 100_000)
    tables = _Tables(staging, buckets)
    id_type = held.schema["id"].dataType.simpleString()
    blocks = held.mapInArrow(partial(_blocks, dimensions=dimensions), f"block long, ids array<{id_type}>, width int, points binary")
    blocks = tables.write(blocks.repartition(tables.buckets, "block"))
    result = f"id {id_type}, cluster int, distance long"
    if not first:
        return _with_inertia(spark.createDataFrame([], result), id_col, np.zeros((0, dimensions), np.int64))
    centroids = np.array([r.x for r in first], dtype=np.int64)
    k = len(centroids)
    drift, counts = np.zeros(k), [0] * k
    sums = [[0] * dimensions for _ in range(k)]
    empty = spark.createDataFrame([], _STATE)
    state_schema = to_arrow_schema(empty.schema)
    state = None
    for _ in range(rounds):
        joined = _joined(blocks, state).drop("ids")
        before = list(tables.names[1:])
        step = joined.mapInArrow(partial(_step, centroids=centroids, drift=drift, schema=state_schema), _STATE)
        state = tables.write(step)
        tables.drop(before)
        for r in _changes(state).collect():  # one row per centroid
            counts[r.cluster] += r.n
            sums[r.cluster] = [a + int(b) for a, b in zip(sums[r.cluster], r.sums)]
        if scans is not None:
            scans.append(state.agg(F.sum("scanned")).first()[0])
        after = np.array([[s // counts[c] for s in sums[c]] if counts[c] else centroids[c].tolist() for c in range(k)], dtype=np.int64)
        drift = drift + _moves(centroids, after)
        centroids = after
    kind = to_arrow_type(held.schema["id"].dataType)
    last = _joined(blocks, state).mapInArrow(partial(_results, centroids=centroids, drift=drift, kind=kind), result)
    found = staging.write(last)
    tables.drop(list(tables.names))
    return _with_inertia(found, id_col, centroids)


def _changes(state: DataFrame) -> DataFrame:
    """(cluster, n, sums): what all tasks of a round changed."""
    moved = state.where(F.size("moved") > 0).select(F.explode("moved").alias("m")).select("m.*")
    each = moved.select("cluster", "count", F.posexplode("sums").alias("j", "s"))
    added = each.groupBy("cluster", "j").agg(F.sum("count").alias("n"), F.sum("s").alias("s"))
    listed = added.groupBy("cluster").agg(F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("j", "s"))).alias("by"))
    return listed.select("cluster", "n", F.transform("by", lambda e: e["s"]).alias("sums"))


def _joined(blocks: DataFrame, state: DataFrame | None) -> DataFrame:
    """Blocks with their states; both have the same buckets, so nothing is shuffled."""
    if state is None:
        return blocks
    return blocks.join(state.select("block", "labels", "keys", "rows", "ends").hint("shuffle_hash"), "block")


def _with_inertia(found: DataFrame, id_col: str, centroids: np.ndarray) -> DataFrame:
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    sums = {r.cluster: int(r.s) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    rows = [(c, min(s, _LARGEST), min(sum(sums.values()), _LARGEST), digests[c]) for c, s in sums.items()]
    per_cluster = found.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # One row per centroid.
    return found.join(F.broadcast(per_cluster), "cluster").select(
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
