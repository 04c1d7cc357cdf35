"""Evaluation runs over time: idempotent appends, scores valid at a time, regressions between runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY = 86_400


def append_run(scores: DataFrame, path: str, run: str) -> None:
    """Store ``scores`` as run ``run``; the same run sent again replaces itself, others stay.

    One folder per run, overwritten by dynamic partitions. An empty table stores nothing.
    """
    tagged = scores.withColumn("run", F.lit(run))
    writer = tagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("run").parquet(path)


def scores_as_of(
    scores: DataFrame,
    asked: DataFrame,
    case: str,
    at: str = "at",
    score: str = "score",
    order: str = "run",
    span: int = DAY,
) -> DataFrame:
    """``asked`` and the score of its ``case`` valid at its time: the last one not after it.

    Null before the first score; of scores at one time, that of the largest ``order``. Rows
    with a null case or time get null. Time is cut into spans of ``span`` seconds: a case's rows
    are sorted span by span, and only one row per case and span carries the last score over, so
    a case with very many scores is dealt over many tasks.
    """
    columns = asked.columns
    row = F.struct(*[F.col(f"`{c}`") for c in columns])
    when, owner = F.col(at), F.col(case)
    known = scores.where(when.isNotNull() & owner.isNotNull())
    part = F.floor(F.unix_micros(when.cast("timestamp")) / (span * 1_000_000))
    value = F.struct(F.col(score).alias("score"))
    left = known.select(
        owner.alias("k"), part.alias("p"), when.alias("t"), F.lit(0).alias("side"), F.col(order).alias("o"),
        value.alias("v"), F.lit(None).cast(asked.select(row.alias("r")).schema["r"].dataType).alias("r"),
    )
    right = asked.select(
        owner.alias("k"), part.alias("p"), when.alias("t"), F.lit(1).alias("side"),
        F.lit(None).cast(scores.schema[order].dataType).alias("o"),
        F.lit(None).cast(left.schema["v"].dataType).alias("v"), row.alias("r"),
    )
    # Scores of a time stand before what is asked at that time.
    near = Window.partitionBy("k", "p").orderBy("t", "side", "o").rowsBetween(Window.unboundedPreceding, 0)
    rows = left.unionByName(right).withColumn("near", F.last("v", ignorenulls=True).over(near)).where("side = 1")

    lasts = left.groupBy("k", "p").agg(F.max_by("v", F.struct("t", "o")).alias("v"))
    spans = lasts.unionByName(right.groupBy("k", "p").agg(F.first("v").alias("v"))).groupBy("k", "p").agg(
        F.max("v").alias("v")
    )
    before = Window.partitionBy("k").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    carried = spans.select("k", "p", F.last("v", ignorenulls=True).over(before).alias("far"))
    joined = rows.join(carried.where("far IS NOT NULL"), ["k", "p"], "left")
    found = F.coalesce("near", "far")["score"]
    return joined.select(*[F.col("r")[c].alias(c) for c in columns], found.alias("valid_score"))


def run_changes(runs: DataFrame, before: str, after: str, case: str, score: str = "score") -> DataFrame:
    """(case, before, after, status) over the cases of two runs, one row per case of each.

    ``status`` is regressed, improved, same, added or removed. The filter on ``run`` reads the
    two folders only. A case stands once in a run; a null score counts as missing.
    """

    def of(run: str, name: str) -> DataFrame:
        scored = runs.where((F.col("run") == run) & F.col(score).isNotNull())
        return scored.select(case, F.col(score).alias(name))

    old, new = F.col("before"), F.col("after")
    status: Column = (
        F.when(old.isNull(), "added")
        .when(new.isNull(), "removed")
        .when(new < old, "regressed")
        .when(new > old, "improved")
        .otherwise("same")
    )
    return of(before, "before").join(of(after, "after"), case, "full").withColumn("status", status)
