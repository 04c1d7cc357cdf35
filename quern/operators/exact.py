"""Exact deduplication: the first row of each text survives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.text import clean_text, strip_text
from quern.functions.hashing import text_key

from .filters import MIN_RECORD_CHARS


def first_rows(df: DataFrame, key: Column, order: str) -> DataFrame:
    """Rows that come first, by the unique column ``order``, within their key.

    ``min`` combines on the map side, so a key that holds a third of all rows
    sends one row per task. The survivors are picked by ``order``, which is
    unique: no join here ever meets a hot key, and no text is shuffled by its
    digest.
    """
    winners = df.groupBy(key.alias("_key")).agg(F.min(order).alias(order)).select(order)
    return df.join(winners, order, "left_semi")


def exact_dedup_sha256(docs: DataFrame, order: str = "doc_id", text: str = "text") -> DataFrame:
    """Clean the text and keep the first row per SHA-256 of it."""
    cleaned = docs.withColumn(text, clean_text(F.col(text)))
    return first_rows(cleaned, text_key(F.col(text)), order)


def exact_dedup_text(
    docs: DataFrame, order: str = "doc_id", text: str = "text", min_chars: int = MIN_RECORD_CHARS
) -> DataFrame:
    """Strip, drop short texts, keep the first row per stripped text."""
    stripped = docs.withColumn(text, strip_text(F.col(text))).where(F.length(text) >= min_chars)
    return first_rows(stripped, text_key(F.col(text)), order)
