"""Corpus preparation: clean, mask, filter, deduplicate, report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.text import clean_text
from quern.operators.filters import MIN_CLEAN_CHARS
from quern.operators.near import MAX_DISTANCE
from quern.operators.outcomes import Decisions, record_traits
from quern.session import spread
from quern.sources.jsonl import lenient_records, replace_text
from quern.sources.sinks import write_json_report, write_json_lines


@dataclass(frozen=True)
class Prepared:
    """``kept`` records with cleaned text, ``outcomes`` per record, one-row ``stats``."""

    kept: DataFrame
    decisions: Decisions

    @property
    def outcomes(self) -> DataFrame:
        return self.decisions.outcomes()

    @property
    def stats(self) -> DataFrame:
        return self.decisions.stats()


def prepare(
    docs: DataFrame,
    order: str = "doc_id",
    text: str = "text",
    min_chars: int = MIN_CLEAN_CHARS,
    max_distance: int = MAX_DISTANCE,
    family: str = "blake2b",
) -> Prepared:
    """Prepare a table whose unique column ``order`` gives the input order.

    A null text counts as invalid. Decisions are made on a narrow table (order,
    digest, fingerprint); the texts themselves are moved once, to meet the list
    of kept records on the unique order column. A table bucketed by that column
    is not moved at all.
    """
    decisions = Decisions(record_traits(docs, order, text, min_chars, family), max_distance)
    kept = spread(docs, order).join(
        decisions.kept().withColumnRenamed("seq", order), order, "left_semi"
    ).withColumn(text, clean_text(F.col(text)))
    return Prepared(kept, decisions)


def prepare_json_lines(
    spark: SparkSession,
    source: str,
    target: str,
    report: str,
    min_chars: int = MIN_CLEAN_CHARS,
    family: str = "blake2b",
) -> DataFrame:
    """File to file: kept records with every other key as it was, and the counters."""
    records = lenient_records(spark, source)
    result = prepare(records, "seq", "text", min_chars, family=family)
    kept = result.kept.select("seq", replace_text(F.col("fields"), F.col("text")).alias("value"))
    write_json_lines(kept, target, order="seq")
    stats = result.stats
    write_json_report(stats, report)
    return stats
