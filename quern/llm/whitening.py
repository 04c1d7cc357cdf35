"""Embedding whitening by shifted CholeskyQR.

Components become x = floor(256 * c). The fit list is every distinct x vector once.
Its centred rows A are orthogonalised by distributed Gram passes: a pass takes every
row through the triangular solves found so far (Q = A R1^-1 R2^-1 ...), sums Q'Q over
all tasks, and the driver factors that d x d matrix into the next R. The first pass
shifts the diagonal, so that the factor exists however ill-conditioned the rows are;
later passes shift only where the plain factor does not exist, and the passes end when
Q'Q is the identity. The R factors are composed, and the singular vectors of the
product are the components: e = s^2 / n are the eigenvalues of the covariance.

Nothing but d x d sums reaches the driver. The fit list is written once; a pass reads it.

Defined results: vectors that are null, empty or hold null or non-finite entries are
dropped, and so are those whose length is not the commonest one (ties: the longer);
rows with equal ids or vectors each give their rows; components with no variance (a
singular value below RANK of the largest) are left out, so a table with one distinct
vector gives no rows. ``deviation`` is null where the exact value does not fit a long.
A component's sign is such that its largest entry by size is positive.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import Staging
from quern.llm.vectors import matrix, sound, summed

COMPONENTS = 4
# Gram passes at most; three do for full rank, rank-deficient rows shrink their null directions in the rest.
MAX_PASSES = 6
# Q'Q is the identity when no entry is further off than this.
ORTHOGONAL = 1e-13
RANK = 1e-10
_LARGEST = 2**63 - 1


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S / n with the whole part of S / n taken off in integers."""
    whole = np.array([s // n for s in sums], dtype=np.int64)
    rest = np.array([(s % n) / n for s in sums])
    return (x - whole).astype(np.float64) - rest


def solve_right(rows: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Q with Q R = rows, for upper triangular R, column by column."""
    out = np.empty_like(rows)
    for j in range(upper.shape[0]):
        out[:, j] = (rows[:, j] - out[:, :j] @ upper[:j, j]) / upper[j, j]
    return out


def factor(gram: np.ndarray, shifted: bool) -> np.ndarray:
    """Upper triangular R with R'R = gram, or gram plus a multiple of the identity."""
    d = len(gram)
    shift = 11 * d * (d + 1) * np.finfo(float).eps * np.trace(gram) if shifted else 0.0
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(d)).T
        except np.linalg.LinAlgError:
            shift = max(100 * shift, 11 * d * (d + 1) * np.finfo(float).eps * np.trace(gram), np.finfo(float).tiny)


def components(fit: DataFrame, n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(directions as columns, eigenvalues), by falling eigenvalue, of the covariance of ``fit`` (x)."""
    d = len(sums)
    factors: list[np.ndarray] = []
    whole = np.eye(d)

    def gram_of(batch: pa.RecordBatch) -> np.ndarray:
        rows = centred(matrix(batch.column(0), d), n, sums)
        for upper in factors:
            rows = solve_right(rows, upper)
        return rows.T @ rows

    for step in range(MAX_PASSES):
        gram = summed(fit, gram_of)
        if not np.trace(gram):
            return np.zeros((d, 0)), np.zeros(0)
        if step and np.abs(gram - np.eye(d)).max() <= ORTHOGONAL:
            break
        upper = factor((gram + gram.T) / 2, shifted=step == 0)
        factors.append(upper)
        whole = upper @ whole
    _, singular, directions = np.linalg.svd(whole)
    held = singular > RANK * singular[0]
    directions = directions[held].T
    largest = directions[np.abs(directions).argmax(axis=0), np.arange(directions.shape[1])]
    return directions * np.sign(largest), singular[held] ** 2 / n


def whole_sums(fit: DataFrame, d: int) -> list[int]:
    """Exact sums of the ``d`` dimensions: the low and the high 32 bits are summed apart."""

    def halves(batch: pa.RecordBatch) -> np.ndarray:
        x = matrix(batch.column(0), d)
        return np.vstack([(x & 0xFFFFFFFF).sum(axis=0), (x >> 32).sum(axis=0)])

    def split(batch: pa.RecordBatch) -> np.ndarray:
        # Four parts of at most 2**21 times the rows of a batch: whole numbers in a double up to 2**32 rows of a group.
        low, high = halves(batch)
        return np.vstack([low & 0x1FFFFF, low >> 21, high & 0x1FFFFF, high >> 21])

    low, carry, high, top = (part.tolist() for part in summed(fit, split))
    return [int(a) + (int(b) << 21) + (int(c) << 32) + (int(e) << 53) for a, b, c, e in zip(low, carry, high, top)]


def deviations(x: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Exact sums of (n x - S)^2; null where that is no long."""
    bound = max([int(np.abs(x.astype(np.float64)).max()) + 1, 1]) * n + max(map(abs, sums)) if x.size else 0
    if x.shape[1] * bound * bound <= _LARGEST:
        off = x * n - np.array(sums, dtype=np.int64)
        return pa.array((off * off).sum(axis=1))
    exact = ((x.astype(object) * n - np.array(sums, dtype=object)) ** 2).sum(axis=1)
    return pa.array([int(v) if v <= _LARGEST else None for v in exact], pa.int64())


def whiten(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", count: int = COMPONENTS
) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) per vector and component up to ``count``."""
    staging = Staging(vectors.sparkSession, "whitening")
    rows = vectors.where(sound(vector_col) & (F.size(vector_col) > 0)).select(
        F.col(id_col).alias("id"), F.transform(vector_col, lambda c: F.floor(c.cast("double") * 256) + F.lit(0).cast("long")).alias("x")
    )
    fit = staging.write(rows.select("x").distinct())
    length = fit.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    schema = f"id {rows.schema['id'].dataType.simpleString()}, deviation long, whitened array<double>"
    if length is None:
        n, sums, d = 0, [], 0
        directions, values = np.zeros((0, 0)), np.zeros(0)
    else:
        d = length.d
        fit = fit.where(F.size("x") == d)
        n = length.n
        sums = whole_sums(fit, d)
        directions, values = components(fit, n, sums)
    explained = values / values.sum() if len(values) else values
    directions, values = directions[:, :count], values[:count]
    to_white = directions / np.sqrt(values)

    def moments(batch: pa.RecordBatch) -> np.ndarray:
        white = centred(matrix(batch.column(0), d), n, sums) @ to_white
        return np.vstack([white.sum(axis=0), white.T @ white])

    error = 0.0
    if len(values):
        total = summed(fit, moments) / n
        covariance = total[1:] - np.outer(total[0], total[0])
        error = float(np.abs(covariance - np.eye(len(values))).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1), d)
            white = centred(x, n, sums) @ to_white
            offsets = np.arange(0, white.size + 1, len(values), dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), deviations(x, n, sums), pa.ListArray.from_arrays(pa.array(offsets), pa.array(white.ravel()))],
                names=["id", "deviation", "whitened"],
            )

    projected = rows.where(F.size("x") == d).mapInArrow(project, schema) if len(values) else vectors.sparkSession.createDataFrame([], schema)
    shares = F.array(*[F.lit(float(e)) for e in explained[:count]]).cast("array<double>")
    out = projected.select("id", "deviation", F.posexplode("whitened").alias("_at", "whitened"))
    return out.select(
        F.col("id").alias(id_col),
        (F.col("_at") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("_at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
