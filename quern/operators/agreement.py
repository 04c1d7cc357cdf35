"""Agreement of many annotators: coincidences of values, Krippendorff's alpha, kappa of each pair."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _counts(marks: DataFrame, item: str, value: str) -> DataFrame:
    """(item, value, n): combined on the map side, so an item with very many marks is dealt by value."""
    marked = marks.where(F.col(value).isNotNull())
    return marked.groupBy(F.col(item).alias("item"), F.col(value).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def coincidences(marks: DataFrame, item: str, value: str) -> DataFrame:
    """(value, other, weight): Krippendorff's coincidence matrix; missing marks are null.

    An item with m marks gives every ordered pair of its marks the weight 1 / (m - 1); items
    with one mark count nothing. Pairs are made of an item's distinct values, never of marks.
    """
    counts = _counts(marks, item, value)
    cells = F.struct("value", "n")
    items = counts.groupBy("item").agg(F.collect_list(cells).alias("v"), F.sum("n").alias("m")).where("m > 1")
    one = items.select("v", "m", F.explode("v").alias("a"))
    both = one.select("m", "a", F.explode("v").alias("b"))
    pairs = F.col("a.n") * (F.col("b.n") - F.when(F.col("a.value") == F.col("b.value"), 1).otherwise(0))
    weight = pairs / (F.col("m") - 1)
    found = both.groupBy(F.col("a.value").alias("value"), F.col("b.value").alias("other"))
    return found.agg(F.sum(weight).alias("weight")).where("weight > 0")


def krippendorff_alpha(marks: DataFrame, item: str, value: str, metric: str = "nominal") -> DataFrame:
    """One row: items with two marks or more, their marks, observed and expected disagreement, alpha.

    ``metric`` is ``nominal`` (values differ or not) or ``interval`` (squared difference of
    numbers). Both come from sums per item and per value, without any pairs. Alpha is null
    where all marks agree or nothing can be compared.
    """
    if metric not in ("nominal", "interval"):
        raise ValueError(f"unknown metric {metric}")
    counts = _counts(marks, item, value)
    number = F.col("value").cast("double") if metric == "interval" else F.lit(0.0)
    items = counts.groupBy("item").agg(
        F.sum("n").alias("m"),
        F.sum(F.col("n") * F.col("n")).alias("squares"),
        F.sum(F.col("n") * number).alias("s"),
        F.sum(F.col("n") * number * number).alias("ss"),
        F.min("value").alias("single"),
    )
    paired = F.col("m") > 1
    within = (
        F.col("m").cast("double") * F.col("m") - F.col("squares")
        if metric == "nominal"
        else 2 * (F.col("m") * F.col("ss") - F.col("s") * F.col("s"))
    )
    total = items.where(paired).agg(
        F.count(F.lit(1)).alias("items"),
        F.coalesce(F.sum("m"), F.lit(0)).alias("marks"),
        F.sum(within / (F.col("m") - 1)).alias("within"),
        F.sum("s").alias("s"),
        F.sum("ss").alias("ss"),
        F.lit(1).alias("_one"),
    )
    n = F.col("marks").cast("double")
    if metric == "nominal":
        # Marks of items that have only one are taken off: the value is the item's only one.
        singles = items.where(~paired).groupBy(F.col("single").alias("value")).agg((-F.count(F.lit(1))).alias("n"))
        values = counts.select("value", "n").unionByName(singles).groupBy("value").agg(F.sum("n").alias("n"))
        same = values.agg(F.sum(F.col("n").cast("double") * F.col("n")).alias("same"), F.lit(1).alias("_one"))
        total = total.join(F.broadcast(same), "_one")
        between = n * n - F.col("same")
    else:
        between = 2 * (n * F.col("ss") - F.col("s") * F.col("s"))
    observed, expected = F.try_divide("within", n), F.try_divide(between, n * (n - 1))
    sums = total.select("items", "marks", observed.alias("observed"), expected.alias("expected"))
    return sums.withColumn("alpha", 1 - F.try_divide("observed", "expected"))


def pair_kappas(marks: DataFrame, item: str, annotator: str, value: str) -> DataFrame:
    """(first, second, items, agreement, kappa) for each two annotators with an item in common.

    Null items, annotators and values are missing marks; of an annotator's marks of one item the
    largest value counts. Kappa is null where chance alone would always agree. An item is one row
    of its marks, so pairs grow with the square of the annotators of one item, never of all marks.
    """
    held = marks.where(F.col(item).isNotNull() & F.col(annotator).isNotNull() & F.col(value).isNotNull())
    single = held.groupBy(F.col(item).alias("item"), F.col(annotator).alias("who")).agg(F.max(value).alias("mark"))
    items = single.groupBy("item").agg(F.array_sort(F.collect_list(F.struct("who", "mark"))).alias("v"))
    one = items.where(F.size("v") > 1).select("v", F.posexplode("v").alias("place", "a"))
    two = one.select("a", F.explode(F.slice("v", F.col("place") + 2, F.size("v"))).alias("b"))
    cells = two.groupBy(
        F.col("a.who").alias("first"), F.col("b.who").alias("second"), F.col("a.mark").alias("x"), F.col("b.mark").alias("y")
    ).agg(F.count(F.lit(1)).alias("n"))
    # Marginals from the small table of cells: one row per pair, label and side.
    side = F.explode(F.array(F.struct(F.col("x").alias("mark"), F.col("n").alias("l"), F.lit(0).cast("long").alias("r")),
                             F.struct(F.col("y").alias("mark"), F.lit(0).cast("long").alias("l"), F.col("n").alias("r"))))
    margins = cells.select("first", "second", side.alias("s")).groupBy("first", "second", "s.mark")
    chance = margins.agg((F.sum("s.l").cast("double") * F.sum("s.r")).alias("both"))
    chance = chance.groupBy("first", "second").agg(F.sum("both").alias("both"))
    same = F.sum(F.when(F.col("x") == F.col("y"), F.col("n")).otherwise(0))
    seen = cells.groupBy("first", "second").agg(F.sum("n").alias("items"), same.alias("same"))
    share, expected = F.col("same") / F.col("items"), F.col("both") / (F.col("items").cast("double") * F.col("items"))
    return seen.join(chance, ["first", "second"]).select(
        "first", "second", "items", share.alias("agreement"), F.try_divide(share - expected, 1 - expected).alias("kappa")
    )
