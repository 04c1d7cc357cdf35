"""Vector columns inside Python tasks, and distributed sums of small matrices."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def sound(vector: str) -> Column:
    """Neither null nor holding a null or non-finite component."""
    infinite = F.lit(float("inf"))
    finite = F.forall(vector, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < infinite))
    return F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False))


def matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    """The vectors of a list column without nulls, one per row."""
    flat = column.flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(len(column), dimensions)


def scaled(column: pa.Array, dimensions: int) -> np.ndarray:
    """floor(256 * c) of every component as a long; beyond its range the nearest long."""
    values = np.floor(matrix(column, dimensions).astype(np.float64) * 256)
    return np.where(
        np.abs(values) < 2.0**63, values, 0
    ).astype(np.int64) + np.where(values >= 2.0**63, np.int64(2**63 - 1), 0) + np.where(values <= -(2.0**63), np.int64(-(2**63)), 0)


def summed(rows: DataFrame, of_batch: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """The sum of ``of_batch`` over all batches: a matrix whose size is that of one batch's.

    Every task adds up its batches; about the square root of the number of tasks add up
    the tasks' sums, and the driver adds up theirs.
    """

    def encode(total: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        if total is not None:
            total = np.ascontiguousarray(np.atleast_2d(total), dtype=np.float64)
            yield pa.RecordBatch.from_arrays([pa.array([total.shape[1]], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["width", "sums"])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                own = of_batch(batch)
                total = own if total is None else total + own
        yield from encode(total)

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for width, sums in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = np.frombuffer(sums).reshape(-1, width)
                total = own if total is None else total + own
        yield from encode(total)

    kind = "width int, sums binary"
    groups = math.ceil(math.sqrt(max(rows.sparkSession.sparkContext.defaultParallelism, _splits(rows))))
    found = rows.mapInArrow(partial, kind).repartition(groups).mapInArrow(combine, kind).collect()
    if not found:
        return np.zeros((0, 0))
    return sum(np.frombuffer(r.sums).reshape(-1, r.width) for r in found)


def _splits(rows: DataFrame) -> int:
    """Tasks that a scan of ``rows`` takes."""
    return planned_bytes(rows) // (128 << 20)


def planned_bytes(rows: DataFrame) -> int:
    """The planner's estimate of a table's size; 0 where it knows none."""
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 1 << 60 else 0
