"""Corpus profile: null rates, language shares, length quantiles, checks per record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.text import strip_text

QUANTILES = (0.0, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0)
# Characters that readable text does not hold: controls other than space, and the replacement sign.
GARBLED = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f\x{fffd}]"
MAX_GARBLED = 0.1


def null_rates(rows: DataFrame) -> DataFrame:
    """(column, rows, nulls, null_rate) of every column; the rate of an empty table is 0. One pass."""
    counts = [
        F.struct(F.lit(c).alias("column"), F.count_if(F.col(f"`{c}`").isNull()).alias("nulls"))
        for c in rows.columns
    ]
    totals = rows.agg(F.count(F.lit(1)).alias("rows"), F.array(*counts).alias("c"))
    rate = F.coalesce(F.try_divide("c.nulls", "rows"), F.lit(0.0))
    return totals.select("rows", F.explode("c").alias("c")).select(
        "c.column", "rows", "c.nulls", rate.alias("null_rate")
    )


def shares(rows: DataFrame, by: str) -> DataFrame:
    """(by, rows, share); null is a group of its own."""
    counted = rows.groupBy(by).agg(F.count(F.lit(1)).alias("rows"))
    total = rows.agg(F.count(F.lit(1)).alias("_total"))
    # One row beside one row per group.
    joined = counted.withColumn("_one", F.lit(1)).join(F.broadcast(total.withColumn("_one", F.lit(1))), "_one")
    return joined.select(by, "rows", (F.col("rows") / F.col("_total")).alias("share"))


def length_quantiles(docs: DataFrame, text: str = "text") -> DataFrame:
    """(quantile, chars), exact and interpolated; null texts have no length.

    Lengths are counted first, so what is ranked has one row per distinct length.
    """
    lengths = docs.where(F.col(text).isNotNull()).groupBy(F.length(text).alias("chars")).agg(
        F.count(F.lit(1)).alias("n")
    )
    levels = F.array(*[F.lit(q) for q in QUANTILES])
    found = lengths.agg(F.percentile("chars", levels, F.col("n")).alias("v"))
    return found.select(F.posexplode("v").alias("at", "chars")).select(
        F.element_at(levels, F.col("at") + 1).alias("quantile"), "chars"
    )


def garbled_ratio(text: Column) -> Column:
    """Share of characters that readable text does not hold; 0 for an empty one."""
    return F.coalesce(
        F.try_divide(F.length(text) - F.length(F.regexp_replace(text, GARBLED, "")), F.length(text)), F.lit(0.0)
    )


def record_checks(docs: DataFrame, languages: list[str], text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` and ``is_empty`` (null or blank), ``garbled_ratio``, ``lang_known``, ``passes`` (all checks)."""
    empty = F.coalesce(strip_text(F.col(text)) == "", F.lit(True))
    known = F.coalesce(F.col(lang).isin(languages), F.lit(False))
    checked = docs.withColumns(
        {"is_empty": empty, "garbled_ratio": garbled_ratio(F.col(text)), "lang_known": known}
    )
    passes = ~F.col("is_empty") & (F.col("garbled_ratio") <= MAX_GARBLED) & F.col("lang_known")
    return checked.withColumn("passes", passes)


def agreement(rows: DataFrame, first: str, second: str) -> DataFrame:
    """One row: items both annotators marked, observed agreement, Cohen's kappa (null where chance is 1)."""
    pairs = rows.where(F.col(first).isNotNull() & F.col(second).isNotNull())
    cells = pairs.groupBy(F.col(first).alias("_a"), F.col(second).alias("_b")).agg(F.count(F.lit(1)).alias("n"))
    # Marginals from the small table of cells: one row per label and side.
    sides = F.array(
        F.struct(F.lit(0).alias("side"), F.col("_a").alias("label")),
        F.struct(F.lit(1).alias("side"), F.col("_b").alias("label")),
    )
    labels = cells.select("n", F.explode(sides).alias("x")).groupBy("x.label").agg(
        F.sum(F.when(F.col("x.side") == 0, F.col("n")).otherwise(0)).cast("double").alias("a"),
        F.sum(F.when(F.col("x.side") == 1, F.col("n")).otherwise(0)).cast("double").alias("b"),
    )
    total = cells.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("items"),
        F.coalesce(F.sum(F.when(F.col("_a") == F.col("_b"), F.col("n"))), F.lit(0)).alias("agreed"),
    ).withColumn("_one", F.lit(1))
    chance = labels.agg(F.sum(F.col("a") * F.col("b")).alias("products")).withColumn("_one", F.lit(1))
    expected = F.try_divide("products", F.col("items").cast("double") * F.col("items"))
    both = total.join(F.broadcast(chance), "_one").withColumn(
        "agreement", F.try_divide("agreed", "items")
    )
    kappa = F.try_divide(F.col("agreement") - expected, 1 - expected)
    return both.select("items", "agreement", kappa.alias("kappa"))
