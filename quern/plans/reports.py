"""End-to-end jobs over files, apart from preparation and crawling."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions.text import strip_text
from quern.operators import evals, quality
from quern.operators.exact import exact_dedup_text
from quern.operators.feedback import append_feedback, preference_tasks, read_feedback
from quern.operators.filters import MIN_USEFUL_CHARS, keep_useful_text, valid_record
from quern.schemas import PLAIN_DOC, PREFERENCE_TASK, SCORED_CASE, SOURCE_DOC
from quern.sources import jsonl, sinks


def quality_run(
    spark: SparkSession, source: str, table: str, report: str, schema: T.StructType | None = None
) -> DataFrame:
    """JSON Lines to a featured Parquet table, then a report over that table.

    Without a schema all keys are kept. A malformed line fails the job.
    """
    featured = quality.quality_features(jsonl.dataset_records(spark, source, schema, SOURCE_DOC))
    featured.write.mode("overwrite").parquet(table)
    stored = spark.read.parquet(table)
    summary = quality.quality_report(stored)
    sources = quality.rows_by_source(stored), [F.desc("rows"), F.col("source")]
    sinks.write_json_report(summary, report, rows_by_source=sources)
    return summary


def filter_map_run(
    spark: SparkSession, source: str, table: str, schema: T.StructType | None = None
) -> int:
    """Filter and add features, write Parquet, return the number of rows written.

    Without a schema all keys are kept. A malformed line fails the job.
    """
    docs = jsonl.dataset_records(spark, source, schema, SOURCE_DOC)
    return sinks.write_parquet_counted(
        quality.add_features(docs.where(valid_record(F.col("text")))), table
    )


def filter_split_run(
    spark: SparkSession,
    source: str,
    target: str,
    min_chars: int = MIN_USEFUL_CHARS,
) -> DataFrame:
    """Kept and removed rows to two folders; returns the token count of the kept ones.

    Records keep all their keys. Lines that are not one JSON object go to a third
    folder, ``split=malformed``, as they are; blank lines are not records.
    """
    lines = spark.read.text(source).where(strip_text(F.col("value")) != "")
    parsed = lines.select("value", jsonl.json_object(F.col("value")).alias("fields"))
    useful = F.coalesce(keep_useful_text(jsonl.string_field(F.col("fields"), "text"), min_chars), F.lit(False))
    split = F.when(F.col("fields").isNull(), "malformed").when(useful, "kept").otherwise("removed")
    parsed.select("value", split.alias("split")).write.mode("overwrite").partitionBy("split").text(target)
    # Read by its parent folder: there is no folder for a split without rows.
    stored = spark.read.schema("text string, split string").json(target)
    return quality.token_total(stored.where("split = 'kept'"))


def clean_step(spark: SparkSession, raw: str, target: str) -> str:
    """Strict read, strip, drop short and repeated texts, replace the output safely.

    Other keys of a record stay as they are. Returns the path for the next step.
    """
    lines = jsonl.numbered_lines(spark, raw)
    fields = lines.select("seq", jsonl.strict_object(F.col("value")).alias("fields"))
    text = jsonl.string_field(F.col("fields"), "text")
    records = fields.select(
        "seq", "fields", F.coalesce(text, F.raise_error(F.lit("record without text"))).alias("text")
    )
    kept = exact_dedup_text(records, "seq")
    out = kept.select("seq", jsonl.replace_text(F.col("fields"), F.col("text")).alias("value"))
    sinks.replace_output(spark, target, lambda path: sinks.write_json_lines(out, path, "seq"))
    return target


def report_step(spark: SparkSession, cleaned: str, report: str) -> DataFrame:
    """Row count and mean length of a committed clean output."""
    if not sinks.is_complete(spark, cleaned):
        raise FileNotFoundError(f"{cleaned} is not a complete output")
    summary = quality.clean_report(jsonl.strict_records(spark, cleaned, PLAIN_DOC))
    sinks.write_json_report(summary, report)
    return summary


def three_step_clean(spark: SparkSession, raw: str, target: str, report: str) -> DataFrame:
    """Clean, then report over what the clean step committed."""
    return report_step(spark, clean_step(spark, raw, target), report)


@dataclass(frozen=True)
class Evaluation:
    """One-row ``summary``, per-case ``scores``, and the two row-shaped parts."""

    summary: DataFrame
    scores: DataFrame
    preferences: DataFrame
    regressions: DataFrame


def evaluate(cases: DataFrame, order: str = "seq") -> Evaluation:
    scores = evals.eval_case_scores(cases, order)
    return Evaluation(
        evals.eval_report(scores),
        scores,
        evals.preference_counts(cases),
        evals.regressions(scores, order),
    )


def eval_cases(spark: SparkSession, path: str) -> DataFrame:
    """Evaluation cases from strict JSON Lines.

    An absent field is empty and an absent id 'unknown'; an explicit null is the
    text 'None', and numbers and booleans become text.
    """
    lines = jsonl.numbered_lines(spark, path).where(strip_text(F.col("value")) != "")
    parsed = lines.select("seq", jsonl.strict_object(F.col("value")).alias("fields"))
    fields = F.col("fields")
    shown = [
        jsonl.display_text(fields, name).alias(name)
        for name in ("prompt", "expected", "baseline", "candidate")
    ]
    return parsed.select(
        "seq",
        jsonl.display_text(fields, "id", "unknown").alias("id"),
        *shown,
        jsonl.string_field(fields, "human_preference").alias("human_preference"),
    )


def eval_regression(spark: SparkSession, path: str, report: str) -> Evaluation:
    """Score the cases of a file and write the report with its parts."""
    result = evaluate(eval_cases(spark, path))
    full = sinks.with_map(result.summary, result.preferences, "preference", "n", "human_preferences")
    sinks.write_json_report(full, report, regressions=(result.regressions, "seq"))
    return result


def score_eval(spark: SparkSession, path: str, report: str, model: str, scorer=None) -> DataFrame:
    """Mean score of responses against references, with the per-case scores."""
    cases = jsonl.strict_records(spark, path, SCORED_CASE, order="seq")
    scored = evals.scored_cases(cases, "seq", scorer).join(cases.select("seq", "id"), "seq")
    summary = evals.score_report(scored, model)
    cases = scored.select("seq", "id", "score")
    sinks.write_json_report(summary.drop("n_cases"), report, cases=(cases, "seq"))
    return summary


def feedback_roundtrip(entries: DataFrame, table: str, export: str, order: list[str], created_at=None) -> int:
    """Store entries, export the whole table in id order, return the exported rows."""
    append_feedback(entries, table, order, created_at)
    stored = read_feedback(entries.sparkSession, table)
    return sinks.write_jsonl_counted(stored, export, order="id")


def preference_dataset(spark: SparkSession, path: str) -> DataFrame:
    """Annotation tasks from JSON Lines in which every required key must be present."""
    return preference_tasks(jsonl.required_records(spark, path, PREFERENCE_TASK).drop("seq"))
