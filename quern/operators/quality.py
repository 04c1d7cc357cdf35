"""Corpus quality: features, counts, duplicates and token totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.hashing import content_hash, sha256_hash
from quern.functions.text import char_count, strip_text, tokenize
from quern.session import stage_counted


def add_features(docs: DataFrame, text: str = "text") -> DataFrame:
    """Stripped text, its length and SHA-256; every other column stays."""
    return docs.withColumn(text, strip_text(F.col(text))).withColumns(
        {"char_count": char_count(F.col(text)), "sha256": sha256_hash(F.col(text))}
    )


def quality_features(docs: DataFrame, text: str = "text") -> DataFrame:
    """Length and 64-bit content hash; every other column stays."""
    return docs.withColumns(
        {"char_count": char_count(F.col(text)), "content_hash": content_hash(F.col(text))}
    )


def duplicate_rows(total: Column, unique: Column) -> Column:
    return F.greatest(total - unique, F.lit(0))


def quality_report(featured: DataFrame) -> DataFrame:
    """One row over (char_count, content_hash): totals, distinct texts, lengths.

    Two aggregation steps, first per hash: the distinct count needs no expanded
    rows, and a text with many copies is one row per task before the shuffle.
    """
    per_text = featured.groupBy("content_hash").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("char_count").alias("chars"),
        F.count("char_count").alias("measured"),
        F.min("char_count").alias("low"),
        F.max("char_count").alias("high"),
    )
    totals = per_text.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count("content_hash").alias("unique_texts"),
        (F.sum("chars") / F.nullif(F.sum("measured"), F.lit(0))).alias("mean"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
    )
    return totals.select(
        "total_rows",
        "unique_texts",
        duplicate_rows(F.col("total_rows"), F.col("unique_texts")).alias("duplicate_rows"),
        cell_default(F.round("mean", 2), 0.0).alias("average_chars"),
        cell_default(F.col("low"), 0).alias("min_chars"),
        cell_default(F.col("high"), 0).alias("max_chars"),
    )


def cell_default(value: Column, default) -> Column:
    return F.coalesce(value, F.lit(default))


def rows_by_source(docs: DataFrame, source: str = "source") -> DataFrame:
    """(source, rows); a null source is a group of its own."""
    return docs.groupBy(source).agg(F.count(F.lit(1)).alias("rows"))


def sources_by_rows(docs: DataFrame, source: str = "source") -> DataFrame:
    """Largest source first; equal counts in the order of their names."""
    return rows_by_source(docs, source).orderBy(F.desc("rows"), source)


def clean_report(cleaned: DataFrame, text: str = "text") -> DataFrame:
    """One row: number of rows and mean text length; zeros when empty."""
    return cleaned.agg(
        F.count(F.lit(1)).alias("clean_rows"),
        cell_default(F.round(F.avg(F.length(text)), 2), 0.0).alias("average_chars"),
    )


def token_counts_per_row(docs: DataFrame, text: str = "text") -> DataFrame:
    return docs.withColumn("token_count", F.size(tokenize(F.col(text))))


def token_total(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row: documents, and tokens in all of them."""
    return token_counts_per_row(docs, text).agg(
        F.count(F.lit(1)).alias("documents"),
        F.coalesce(F.sum("token_count"), F.lit(0)).alias("tokens"),
    )


def _bag(tokens: Column) -> Column:
    """Array of (token, n) of an array of tokens: runs of equal ones after sorting."""

    def runs(ordered: Column) -> Column:
        changes = lambda i: (i == 1) | (F.get(ordered, i - 1) != F.get(ordered, i - 2))
        first = F.filter(F.sequence(F.lit(1), F.size(ordered)), changes)
        return F.transform(F.array(first), lambda starts: sized(ordered, starts))[0]

    def sized(ordered: Column, starts: Column) -> Column:
        def run(start: Column, i: Column) -> Column:
            stop = F.coalesce(F.get(starts, i + 1), F.size(ordered) + 1)
            return F.struct(F.get(ordered, start - 1).alias("token"), (stop - start).cast("long").alias("n"))

        return F.transform(starts, run)

    # Bound as lambda variables, so that tokens are found, sorted and cut up once.
    counted = F.transform(F.array(F.sort_array(tokens)), runs)[0]
    return F.when(F.size(tokens) > 0, counted)


def token_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, token, n): each text as a bag of tokens; texts of the same key are one bag.

    A text is counted in its row. Only the counts of keys that stand in several rows are
    shuffled, and the keys alone to find these.
    """
    sizes = docs.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_rows"))
    repeated, n_repeated = stage_counted(sizes.where("_rows > 1").select("_key"), "repeated")

    def counted(rows: DataFrame) -> DataFrame:
        bags = rows.select(key, tokenize(F.col(text)).alias("_tokens")).select(key, _bag(F.col("_tokens")).alias("_bag"))
        # The outer form: for the inner one the planner would work out the bags a second time, in a filter.
        return bags.select(key, F.inline_outer("_bag")).where(F.col("token").isNotNull())

    if not n_repeated:
        return counted(docs)
    same = F.col(key).eqNullSafe(F.col("_key"))
    merged = counted(docs.join(repeated, same, "left_semi")).groupBy(key, "token").agg(F.sum("n").alias("n"))
    return counted(docs.join(repeated, same, "left_anti")).unionByName(merged)
