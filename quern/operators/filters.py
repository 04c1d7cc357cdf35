"""Row predicates. Each returns a boolean column for ``where``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.text import clean_text, strip_text

# Default length limits of the jobs, the preference labels that
# count, and the rating range.
MIN_CLEAN_CHARS = 80
MIN_USEFUL_CHARS = 20
MIN_RECORD_CHARS = 15
PREFERENCE_LABELS = ("candidate", "baseline", "tie")
RATING_RANGE = (1, 5)


def min_chars_clean(text: Column, min_chars: int = MIN_CLEAN_CHARS) -> Column:
    """Long enough after cleaning and masking."""
    return F.length(clean_text(text)) >= min_chars


def keep_useful_text(text: Column, min_chars: int = MIN_USEFUL_CHARS) -> Column:
    """Long enough without the outer whitespace; the text itself is not changed."""
    return F.length(strip_text(text)) >= min_chars


def valid_record(text: Column, min_chars: int = MIN_RECORD_CHARS) -> Column:
    """A text that is present and long enough without the outer whitespace."""
    return F.coalesce(F.length(strip_text(text)) >= min_chars, F.lit(False))


def preference_filter(label: Column) -> Column:
    return F.coalesce(label.isin(*PREFERENCE_LABELS), F.lit(False))


def html_only(content_type: Column, html: Column) -> Column:
    """Response declared as HTML and not empty; a missing header drops it."""
    return F.contains(F.coalesce(content_type, F.lit("")), F.lit("text/html")) & (
        F.coalesce(html, F.lit("")) != ""
    )


def predicate_filter(df: DataFrame, predicate: Callable[..., Column], column: str, **bound) -> DataFrame:
    """User predicate with bound parameters, as a column expression."""
    return df.where(predicate(F.col(column), **bound))


def row_filter_map(
    df: DataFrame, keep: Callable[[DataFrame], Column], change: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """User filter followed by a user map, both over whole DataFrames."""
    return df.where(keep(df)).transform(change)
