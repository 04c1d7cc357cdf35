"""Repeated text: shares within a document, lines that many documents hold, and their removal."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.text import strip_text, tokenize
from quern.session import stage

from .skew import HOT_ROWS, join_groups

LINES = r"\n"
PARAGRAPHS = r"\n[ \t]*\n\s*"
WIDTHS = (2, 3, 5)
# A line in this many documents is boilerplate.
MIN_DOCS = 10


def _units(text: Column, separator: str) -> Column:
    """Stripped units of the text that are not blank, in order."""
    pieces = F.transform(F.split(F.coalesce(text, F.lit("")), separator, -1), strip_text)
    return F.filter(pieces, lambda p: p != "")


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def _chars(units: Column) -> Column:
    return F.aggregate(units, F.lit(0).cast("bigint"), lambda sum_, u: sum_ + F.length(u))


def _grams(tokens: Column, width: int) -> Column:
    """A hash of every run of ``width`` tokens, by place; empty for a shorter text."""
    starts = F.sequence(F.lit(1), F.size(tokens) - (width - 1))
    hashed = F.transform(starts, lambda at: F.xxhash64(F.slice(tokens, at, width)))
    return F.when(F.size(tokens) >= width, hashed).otherwise(F.array().cast("array<bigint>"))


def repetition(docs: DataFrame, key: str = "doc_id", text: str = "text", widths: Iterable[int] = WIDTHS) -> DataFrame:
    """(key, n_lines, line_repeats, line_repeat_chars, n_paragraphs, paragraph_repeats, gram<w>_repeats).

    Shares of a document's units that stand in it before; 0 where there are none. Lines and
    paragraphs count stripped, blank ones not at all. Everything is folded inside the row.
    """
    tokens = tokenize(F.coalesce(F.col(text), F.lit("")))
    parts = docs.select(
        key,
        _units(F.col(text), LINES).alias("_lines"),
        _units(F.col(text), PARAGRAPHS).alias("_paragraphs"),
        # Bound once, so that the tokenizer does not run for every width and place.
        F.transform(F.array(tokens), lambda t: F.struct(*[_grams(t, w).alias(f"_{w}") for w in widths]))[0].alias("_g"),
    )

    def repeats(units: Column) -> Column:
        return _share(F.size(units) - F.size(F.array_distinct(units)), F.size(units))

    lines = F.col("_lines")
    chars = _chars(lines)
    return parts.select(
        key,
        F.size("_lines").cast("bigint").alias("n_lines"),
        repeats(lines).alias("line_repeats"),
        _share(chars - _chars(F.array_distinct(lines)), chars).alias("line_repeat_chars"),
        F.size("_paragraphs").cast("bigint").alias("n_paragraphs"),
        repeats(F.col("_paragraphs")).alias("paragraph_repeats"),
        *[repeats(F.col(f"_g._{w}")).alias(f"gram{w}_repeats") for w in widths],
    )


def _places(docs: DataFrame, key: str, text: str, separator: str) -> DataFrame:
    """(key, pos, digest) of all units that are not blank: 16 bytes instead of the unit."""
    pieces = F.posexplode(F.split(F.col(text), separator, -1)).alias("pos", "unit")
    units = docs.select(key, pieces).withColumn("unit", strip_text(F.col("unit"))).where("unit != ''")
    return units.select(key, "pos", F.unhex(F.md5("unit")).alias("digest"))


def _frequencies(places: DataFrame, key: str) -> DataFrame:
    """(digest, docs, rows). A unit counts once per document before it is counted over all.

    The first grouping is by (document, digest), so a unit of every document is dealt over
    all tasks; the second then combines on the map side to one row per task and digest.
    """
    per_doc = places.groupBy(key, "digest").agg(F.count(F.lit(1)).alias("n"))
    return per_doc.groupBy("digest").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("rows"))


def common_units(
    docs: DataFrame, min_docs: int = MIN_DOCS, key: str = "doc_id", text: str = "text", separator: str = LINES
) -> DataFrame:
    """(digest, docs, rows) of the units that at least ``min_docs`` documents hold."""
    return _frequencies(_places(docs, key, text, separator), key).where(F.col("docs") >= min_docs)


def strip_common_lines(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    key: str = "doc_id",
    text: str = "text",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``docs`` without the lines that at least ``min_docs`` documents hold, and ``n_removed``.

    ``key`` is unique. Lines are compared stripped and kept as they are; blank lines stay. A
    null text stays null. Only digests and places are grouped; texts move once, to the places
    of their own document.
    """
    places = stage(_places(docs, key, text, LINES), "places")
    common = stage(_frequencies(places, key).where(F.col("docs") >= min_docs).select("digest", "rows"), "common")
    removed = join_groups(places, common, "digest", "rows", hot_rows)
    per_doc = removed.groupBy(F.col(key).alias("_key")).agg(F.collect_list("pos").alias("_drop"))
    lines = F.split(F.col(text), LINES, -1)
    # Kept places by a set difference, which is linear in the number of lines.
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_drop"))
    rest = F.array_join(F.transform(F.array(lines), lambda ls: F.transform(kept, lambda at: ls[at]))[0], "\n")
    joined = docs.join(per_doc, F.col(key) == F.col("_key"), "left")
    return joined.withColumns(
        {
            text: F.when(F.col("_drop").isNull(), F.col(text)).otherwise(rest),
            "n_removed": F.coalesce(F.size("_drop"), F.lit(0)).cast("bigint"),
        }
    ).drop("_key", "_drop")
