"""Approximate nearest neighbours by multiprobe p-stable hashing.

Vectors are scaled to unit length and projected on Gaussian directions; a table's
bucket is the tuple of the cells of FUNCTIONS projections. A query visits its own
bucket and perturbed ones, in the order of their estimated success: the sum of the
squared distances to the cell borders that a perturbation crosses. The candidates
of all tables are merged, and ranked by the exact cosine of the original vectors.

Index rows and probes meet in groups that hold about GROUP_ROWS index rows; a bucket
of more than SPLIT_ROWS rows is split, and its probes go to every part. Equal
vectors are one class, with its smallest ids (more can't be in a result). A query
that found too few neighbours is compared with all vectors, dealt in the same way.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components take no part, nor do null ids; rows equal in id and vector are one row;
vectors of different length are never compared. Ties go to the smaller id.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.common import Staging

TABLES = 4
FUNCTIONS = 6
WIDTH = 2.5
PROBES = 24
PERTURBED = 4  # most cells that one probe moves in
SEED = 11
GROUP_ROWS = 20_000
SPLIT_ROWS = 8_192


def projections(table: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Directions and shifts of a table's hash functions, for vectors of ``size``."""
    rng = np.random.default_rng([SEED, table, size])
    return rng.normal(size=(size, FUNCTIONS)), rng.uniform(0, WIDTH, FUNCTIONS)


def perturbations() -> tuple[np.ndarray, np.ndarray]:
    """All moves of up to PERTURBED cells: (steps per function, which border each crosses)."""
    steps, borders = [], []
    for count in range(PERTURBED + 1):
        for functions in itertools.combinations(range(FUNCTIONS), count):
            for sides in itertools.product((0, 1), repeat=count):
                step, border = np.zeros(FUNCTIONS, dtype=np.int64), np.zeros(2 * FUNCTIONS)
                for f, side in zip(functions, sides):
                    step[f] = 1 if side else -1
                    border[2 * f + side] = 1
                steps.append(step)
                borders.append(border)
    return np.array(steps), np.array(borders)


def _codes(cells: np.ndarray) -> np.ndarray:
    """One number per tuple of cells."""
    code = np.zeros(cells.shape[:-1], dtype=np.int64)
    for i in range(FUNCTIONS):
        code = code * 1009 + cells[..., i] + 500
    return code


def _vectors(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _by_size(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, vectors) for the vectors of each length."""
    sizes = np.diff(batch.column(1).offsets.to_numpy())
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield rows, _vectors(batch.column(1).take(pa.array(rows)))


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, x in _by_size(batch):
            own = batch.take(pa.array(rows))
            for table in range(TABLES):
                a, b = projections(table, x.shape[1])
                code = _codes(np.floor((_unit(x) @ a + b) / WIDTH).astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), table, dtype=np.int32)), pa.array(code), *own.columns],
                    names=["table", "bucket", "class", "vector"],
                )


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    steps, borders = perturbations()
    for batch in batches:
        for rows, x in _by_size(batch):
            own = batch.take(pa.array(rows))
            for table in range(TABLES):
                a, b = projections(table, x.shape[1])
                place = (_unit(x) @ a + b) / WIDTH
                cell = np.floor(place)
                distance = np.empty((len(x), 2 * FUNCTIONS))
                distance[:, 0::2] = (place - cell) ** 2
                distance[:, 1::2] = (1 - place + cell) ** 2
                order = np.argsort(distance @ borders.T, axis=1, kind="stable")[:, :PROBES]
                codes = _codes(cell.astype(np.int64)[:, None, :] + steps[order])
                who = np.repeat(np.arange(len(x)), order.shape[1])
                probes = own.take(pa.array(who))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(who), table, dtype=np.int32)), pa.array(codes.ravel()), *probes.columns],
                    names=["table", "bucket", "query", "vector"],
                )


def _best(most: int):
    """Rank the index rows of a group for the probes that meet them in their bucket."""

    def run(index: pa.Table, probes: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if index.num_rows and probes.num_rows:
            index, probes = index.combine_chunks(), probes.combine_chunks()
            keys = ["table", "bucket", "part"]
            size_i = np.diff(index["vector"].chunk(0).offsets.to_numpy())
            size_p = np.diff(probes["vector"].chunk(0).offsets.to_numpy())
            for size in np.intersect1d(size_i, size_p):
                rows, asks = np.flatnonzero(size_i == size), np.flatnonzero(size_p == size)
                own_i, own_p = index.take(pa.array(rows)), probes.take(pa.array(asks))
                x = _vectors(own_i["vector"].combine_chunks())
                y = _vectors(own_p["vector"].combine_chunks())
                x_size, y_size = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
                classes, queries = own_i["class"].to_numpy(), own_p["query"].to_numpy()
                places: dict[tuple, list[int]] = {}
                for i, key in enumerate(zip(*(own_i[k].to_pylist() for k in keys))):
                    places.setdefault(key, []).append(i)
                asked: dict[tuple, list[int]] = {}
                for i, key in enumerate(zip(*(own_p[k].to_pylist() for k in keys))):
                    asked.setdefault(key, []).append(i)
                for key, who in asked.items():
                    there = np.array(places.get(key, []), dtype=np.int64)
                    if not len(there):
                        continue
                    there = there[np.argsort(classes[there])]
                    for at in range(0, len(who), 256):
                        part = np.array(who[at : at + 256])
                        score = (y[part] @ x[there].T) / (y_size[part][:, None] * x_size[there])
                        top = np.argsort(-score, axis=1, kind="stable")[:, :most]
                        found.append(
                            (
                                np.repeat(queries[part], top.shape[1]),
                                classes[there][top].ravel(),
                                np.take_along_axis(score, top, axis=1).ravel(),
                            )
                        )
        query, cls, score = (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        # The best of each query in this group; a class may come from several tables.
        order = np.lexsort((cls, -score, query))
        query, cls, score = query[order], cls[order], score[order]
        if len(query):
            fresh = np.concatenate([[True], (query[1:] != query[:-1]) | (cls[1:] != cls[:-1])])
            query, cls, score = query[fresh], cls[fresh], score[fresh]
            first = np.searchsorted(query, query, side="left")
            keep = np.arange(len(query)) - first < most * TABLES
            query, cls, score = query[keep], cls[keep], score[keep]
        return pa.table({"query": query, "class": cls, "score": score})

    return run


def _meet(index: DataFrame, probes: DataFrame, groups: int, most: int) -> DataFrame:
    group = F.pmod(F.xxhash64("table", "bucket", "part"), F.lit(groups)).alias("group")
    kept = ["table", "bucket", "part"]
    left = index.select(group, *kept, "class", "vector").groupBy("group")
    right = probes.select(group, *kept, "query", "vector").groupBy("group")
    return left.cogroup(right).applyInArrow(_best(most), "query long, class long, score double").distinct()


def nearest(vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each row for which ``is_query(id column)`` holds."""
    staging = Staging(vectors.sparkSession, "nearest")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    sound = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & (F.size("vector") > 0) & sound & F.exists("vector", lambda v: v != 0))
    rows = staging.write(rows.withColumn("query", is_query(F.col("id"))).distinct())
    # Classes of equal vectors: their k + 1 smallest ids, and whether one of all is a query.
    place = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    smallest = rows.withColumn("_place", place).where(F.col("_place") <= k + 1)
    classes = smallest.groupBy("vector").agg(F.min("id").alias("class"), F.sort_array(F.collect_list("id")).alias("ids"))
    asked = rows.groupBy("vector").agg(F.max("query").alias("asked"))
    classes = staging.write(classes.join(asked, "vector"))
    n = classes.count()
    index = staging.write(classes.select("class", "vector").mapInArrow(_index, f"table int, bucket long, {_typed(classes)}"))
    probes = classes.where("asked").select("class", "vector").mapInArrow(
        _probe, f"table int, bucket long, {_typed(classes).replace('class', 'query', 1)}"
    )
    crowded = index.groupBy("table", "bucket").agg(F.ceil(F.count(F.lit(1)) / SPLIT_ROWS).cast("int").alias("parts")).where("parts > 1")
    parts = F.coalesce("parts", F.lit(1))
    split = index.join(crowded, ["table", "bucket"], "left").withColumn("part", F.pmod(F.xxhash64("class"), parts.cast("long")).cast("int"))
    spread = probes.join(crowded, ["table", "bucket"], "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
    groups = max(1, math.ceil(n * TABLES / GROUP_ROWS))
    found = staging.write(_meet(split, spread, groups, k + 1))
    # Queries with too few neighbours against everything.
    asking = rows.where("query").select(F.col("id").alias("query_id"), "vector")
    asking = staging.write(asking.join(classes.select("vector", "class", "ids"), "vector").select("query_id", "class"))
    total = rows.count()
    ids = classes.select("class", "ids")
    pairs = found.join(ids, "class").select("query", F.size("ids").alias("n")).groupBy("query").agg(F.sum("n").alias("n"))
    few = classes.where("asked").join(pairs, F.col("class") == F.col("query"), "left")
    few = few.where(F.coalesce("n", F.lit(0)) <= F.lit(min(k, total - 1))).select(F.col("class").alias("query"), "vector")
    few = staging.write(few)
    if not few.isEmpty():
        blocks = max(1, math.ceil(n / GROUP_ROWS))
        spot = F.pmod(F.xxhash64("class"), F.lit(blocks)).cast("int").alias("part")
        every = classes.select(F.lit(-1).alias("table"), F.lit(0).cast("long").alias("bucket"), spot, "class", "vector")
        asks = few.select(
            F.lit(-1).alias("table"), F.lit(0).cast("long").alias("bucket"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("part"), "query", "vector"
        )
        found = found.unionByName(_meet(every, asks, blocks, k + 1)).distinct()
    best = Window.partitionBy("query").orderBy(F.desc("score"), "class")
    scores = found.groupBy("query", "class").agg(F.max("score").alias("score"))
    scores = scores.withColumn("_place", F.row_number().over(best)).where(F.col("_place") <= k + 1)
    members = scores.join(ids, "class").select("query", "score", F.explode("ids").alias("vec_id"))
    matches = asking.withColumnRenamed("class", "query").join(members, "query").where("query_id != vec_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = matches.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _typed(classes: DataFrame) -> str:
    return f"class long, vector {classes.schema['vector'].dataType.simpleString()}"
