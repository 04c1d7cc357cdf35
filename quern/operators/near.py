"""Near duplicates: fingerprints within a Hamming distance, first one kept."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.hashing import hamming
from quern.session import scratch_path, stage, stage_counted

MAX_DISTANCE = 3
# Buckets above this many fingerprints are split further where that pays.
BUCKET_ROWS = 8192
# Buckets that are compared although crowded are cut into cells of this size.
CELL_ROWS = 2048
# Crowded buckets are looked up by broadcast up to this many; beyond that every
# bucket is split, which is just as exact.
MAX_CROWDED = 300_000
# Levels of splitting, and of masks. At distance 3 the sixth level has 4,096
# masks that leave 11 free bits: no bucket can hold more than 2,048 fingerprints.
MAX_LEVELS = 6
MAX_MASKS = 5000

_SEQ = "seq long"


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _narrower(mask: int, parts: int) -> list[int]:
    """Masks that pin ``mask`` and one of ``parts`` groups of its free bits.

    Two fingerprints that agree on ``mask`` and differ in fewer than ``parts``
    bits agree on at least one of these (pigeonhole). Empty when too few bits
    are free.
    """
    free = [bit for bit in range(64) if not mask >> bit & 1]
    if len(free) < parts:
        return []
    cuts = [len(free) * i // parts for i in range(parts + 1)]
    return [mask | sum(1 << b for b in free[lo:hi]) for lo, hi in zip(cuts, cuts[1:])]


def bit_groups(parts: int) -> list[tuple[int, int]]:
    """The 64 bits in ``parts`` groups [low, high)."""
    cuts = [64 * i // parts for i in range(parts + 1)]
    return list(zip(cuts, cuts[1:]))


def pinned(fp: Column, low: int, high: int) -> Column:
    """The bits [low, high) of a fingerprint, others zero."""
    return fp.bitwiseAND(F.lit(_signed(sum(1 << b for b in range(low, high)))).cast("long"))


def _compare(keyed: DataFrame, max_distance: int, cells: bool = False) -> DataFrame:
    """Pairs within a bucket (mask, pin).

    With ``cells`` a bucket of ``n`` rows is compared in square cells of about
    CELL_ROWS by CELL_ROWS, so that no task gets a whole crowded bucket.
    """
    on = ["mask", "pin"]
    left = keyed.select(*on, F.col("seq").alias("a"), F.col("fp").alias("fa"), *(["n"] if cells else []))
    # Known rows come before all others, so only given ones are the later side of a pair.
    right = keyed.where(~F.col("old")).select(*on, F.col("seq").alias("b"), F.col("fp").alias("fb"), *(["n"] if cells else []))
    if cells:
        width = F.ceil(F.col("n") / CELL_ROWS)
        every = F.explode(F.sequence(F.lit(0), width - 1))
        left = left.withColumn("_i", F.pmod(F.xxhash64("a"), width)).withColumn("_j", every)
        right = right.withColumn("_j", F.pmod(F.xxhash64("b"), width)).withColumn("_i", every)
        on = [*on, "_i", "_j"]
    distance = hamming(F.col("fa"), F.col("fb"))
    close = left.drop("n").join(right.drop("n"), on)
    return close.where((F.col("a") < F.col("b")) & (distance <= max_distance)).select(
        "a", "b", distance.alias("distance")
    )


def near_dup_pairs(
    prints: DataFrame,
    max_distance: int = MAX_DISTANCE,
    bucket_rows: int = BUCKET_ROWS,
    known: DataFrame | None = None,
) -> DataFrame:
    """All pairs (a, b, distance), a before b, of distinct fingerprints (seq, fp).

    With ``known`` (seq, fp), which all come before ``prints``, a pair's earlier
    side may be known too; two known ones are never compared. Known rows that
    share no first-level bucket with a given one are left out of every shuffle.

    A bucket is a set of pinned bits and their value. The first level pins one
    of ``max_distance + 1`` bit groups; every pair in question shares a bucket.
    Buckets that are too crowded to compare pin one more group of their free
    bits, with copies only of their own rows. So the key width follows the data:
    16 bits for millions of fingerprints, 28 or 37 where there are billions or
    where one band value is common. A crowded bucket that splitting does not thin
    out is a dense cluster; it is compared in cells over many tasks.

    The result cannot explode: of distinct fingerprints at most 128 can all lie
    within distance 3 of each other (Kleitman's diameter bound), and none has
    more than 43,744 neighbours.
    """
    if not 0 <= max_distance < 64:
        raise ValueError("max_distance must be in 0..63")
    parts = max_distance + 1
    masks = _narrower(0, parts)
    pending = _masked(prints, masks).withColumn("old", F.lit(False))
    if known is not None:
        pin = F.col("fp").bitwiseAND(F.col("mask")).alias("pin")
        given = pending.select("mask", pin).distinct()
        met = _masked(known, masks).select("*", pin).join(given, ["mask", "pin"], "left_semi")
        pending = stage(pending.unionByName(met.drop("pin").withColumn("old", F.lit(True))), "pending")
    found = []
    for level in range(MAX_LEVELS):
        keyed = pending.withColumn("pin", F.col("fp").bitwiseAND(F.col("mask")))
        sizes = keyed.groupBy("mask", "pin").agg(
            F.count(F.lit(1)).alias("n"), F.count_if(~F.col("old")).alias("given")
        )
        crowded, n_crowded = stage_counted(
            sizes.where((F.col("n") > bucket_rows) & (F.col("given") > 0)).drop("given"), "crowded"
        )
        if n_crowded == 0:
            found.append(_compare(keyed, max_distance))
            break
        splits = {mask: _narrower(mask, parts) for mask in masks}
        last = (
            level == MAX_LEVELS - 1
            or len(masks) * parts > MAX_MASKS
            or not all(splits.values())
        )
        if n_crowded > MAX_CROWDED and not last:
            pending, masks = stage(_split(keyed, splits), "pending"), _inner(splits)
            continue
        lookup = F.broadcast(crowded) if n_crowded <= MAX_CROWDED else crowded
        found.append(
            _compare(keyed.join(lookup.drop("n"), ["mask", "pin"], "left_anti"), max_distance)
        )
        dense = keyed.join(lookup, ["mask", "pin"])
        if last:
            found.append(_compare(dense, max_distance, cells=True))
            break
        worth = stage(_worth_splitting(dense, splits), "worth")
        chosen = F.broadcast(worth)
        found.append(
            _compare(dense.join(chosen, ["mask", "pin"], "left_anti"), max_distance, cells=True)
        )
        pending = stage(_split(dense.join(chosen, ["mask", "pin"], "left_semi"), splits), "pending")
        masks = _inner(splits)
    return reduce(DataFrame.unionByName, found).distinct()


def _split(keyed: DataFrame, splits: dict[int, list[int]], *keep: str) -> DataFrame:
    """Each row once per narrower mask; the table of masks has at most 4**5 rows at distance 3."""
    rows = [(_signed(mask), [_signed(m) for m in inner]) for mask, inner in splits.items()]
    table = keyed.sparkSession.createDataFrame(rows, "mask long, inner array<long>")
    exploded = keyed.join(F.broadcast(table), "mask").select(
        *keep, "seq", "fp", "old", F.explode("inner").alias("_mask")
    )
    return exploded if keep else exploded.withColumnRenamed("_mask", "mask")


def _inner(splits: dict[int, list[int]]) -> list[int]:
    return sorted({mask for inner in splits.values() for mask in inner})


def _worth_splitting(dense: DataFrame, splits: dict[int, list[int]]) -> DataFrame:
    """(mask, pin) of the crowded buckets that splitting thins out.

    Some of the parts may hold almost all rows (where the newly pinned bits are
    common too), as long as the comparisons of all parts together are at most
    half of what they would be if no part got smaller.
    """
    parts = _split(dense, splits, "mask", "pin", "n")
    inner = parts.groupBy("mask", "pin", "_mask", F.col("fp").bitwiseAND(F.col("_mask")).alias("_pin"))
    sizes = inner.agg(F.count(F.lit(1)).cast("double").alias("m"), F.any_value("n").alias("n"))
    costs = sizes.groupBy("mask", "pin").agg(
        F.sum(F.col("m") * F.col("m")).alias("cost"), F.any_value("n").cast("double").alias("n")
    )
    copies = len(next(iter(splits.values())))
    thinner = F.col("cost") <= F.col("n") * F.col("n") * copies / 2
    return costs.where(thinner).select("mask", "pin")


def _masked(prints: DataFrame, masks: list[int]) -> DataFrame:
    every = F.array(*[F.lit(_signed(mask)).cast("long") for mask in masks])
    return prints.select("seq", "fp", F.explode(every).alias("mask"))


def greedy_losers(edges: DataFrame) -> DataFrame:
    """(seq) of nodes dropped by the greedy first-come rule on edges (a, b), a < b.

    A node is dropped when an earlier neighbour is kept. Per round, nodes without
    an undecided earlier neighbour are kept and their later neighbours dropped.
    Runs until no undecided edge is left, however many rounds that takes; the
    work per round is one pass over the remaining edges.
    """
    spark = edges.sparkSession
    live, left = stage_counted(edges.select("a", "b"), "edges")
    folder, rounds = scratch_path(spark, "beaten"), 0
    while left:
        waiting = live.select(F.col("b").alias("a")).distinct()
        path = f"{folder}/round={rounds}"
        live.join(waiting, "a", "left_anti").select(F.col("b").alias("seq")).distinct().write.parquet(path)
        beaten = spark.read.schema(_SEQ).parquet(path)
        live, left = stage_counted(
            live.join(beaten.withColumnRenamed("seq", "b"), "b", "left_anti")
            .join(beaten.withColumnRenamed("seq", "a"), "a", "left_anti")
            .select("a", "b"),
            "edges",
        )
        rounds += 1
    if not rounds:
        return spark.createDataFrame([], _SEQ)
    return spark.read.schema(_SEQ).parquet(folder).select("seq")


def near_dedup_greedy(
    prints: DataFrame,
    max_distance: int = MAX_DISTANCE,
    bucket_rows: int = BUCKET_ROWS,
    known: DataFrame | None = None,
) -> DataFrame:
    """(seq) of the rows that survive near deduplication of (seq, fp), in ``seq`` order.

    ``known`` (seq, fp) has survivors of before, all earlier; rows near one of
    them do not survive.

    Rows with the same fingerprint can only survive through their first one, so
    they are folded first; that keeps a group of many copies at one row.
    """
    heads = stage(prints.groupBy("fp").agg(F.min("seq").alias("seq")).select("seq", "fp"), "heads")
    losers = greedy_losers(near_dup_pairs(heads, max_distance, bucket_rows, known))
    return heads.select("seq").join(losers, "seq", "left_anti")
