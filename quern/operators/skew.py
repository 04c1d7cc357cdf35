"""Join of many rows to one row per key, safe when few keys hold most rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# At most this many key rows are broadcast unless the caller allows fewer.
MAX_BROADCAST_KEYS = 20_000
# Keys with fewer rows than this are left to the ordinary shuffle join.
HOT_ROWS = 200_000
# Key rows whose size is told are broadcast up to this many bytes.
MAX_BROADCAST_BYTES = 64 << 20


def join_groups(
    rows: DataFrame,
    groups: DataFrame,
    key: str | list[str],
    size: str,
    hot_rows: int = HOT_ROWS,
    max_keys: int = MAX_BROADCAST_KEYS,
    weight: Column | None = None,
) -> DataFrame:
    """Inner-join ``rows`` to ``groups`` (one row per ``key``, one column or several; ``size`` = its row count).

    Keys with ``hot_rows`` rows or more are broadcast, so their rows never meet
    in one task. The threshold rises with the data so that no more than
    ``max_keys`` keys can reach it. All other keys are shuffled. Where there are
    no more keys than that in all, all are broadcast.

    ``weight`` is the size in bytes of a key's row where that is not small. Rows
    of more than MAX_BROADCAST_BYTES in all are then never broadcast: hot keys are
    salted, with at most ``max_keys`` of them.
    """
    weight = F.lit(0) if weight is None else weight
    n_keys, total, largest, weighs = groups.agg(
        F.count(F.lit(1)), F.sum(size), F.max(size), F.sum(weight)
    ).first()
    limit = max(hot_rows, math.ceil((total or 0) / max_keys))
    if (weighs or 0) > MAX_BROADCAST_BYTES:
        return _salted(rows, groups, key, size, limit)
    if n_keys <= max_keys:
        return rows.join(F.broadcast(groups), key)
    if (largest or 0) < limit:
        return rows.join(groups, key)
    hot = groups.where(F.col(size) >= limit)
    spread = rows.join(F.broadcast(hot), key)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(
        groups.where(F.col(size) < limit), key
    )
    return spread.unionByName(rest)


def _salted(rows: DataFrame, groups: DataFrame, key: str | list[str], size: str, limit: int) -> DataFrame:
    """The same join with only keys broadcast. A hot key's rows are dealt by a hash of the whole row."""
    keys = [key] if isinstance(key, str) else key
    shares = F.ceil(F.col(size) / limit).cast("int")
    hot = groups.where(shares > 1).select(*keys, shares.alias("_shares"))
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]), F.coalesce("_shares", F.lit(1)))
    placed = rows.join(F.broadcast(hot), key, "left").withColumn("_salt", salt).drop("_shares")
    every = F.sequence(F.lit(0).cast("long"), F.greatest(shares, F.lit(1)).cast("long") - 1)
    return placed.join(groups.withColumn("_salt", F.explode(every)), [*keys, "_salt"]).drop("_salt")
