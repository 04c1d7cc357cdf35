"""Human feedback table and preference tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quern.session import exists
from quern.schemas import FEEDBACK, PREFERENCE_ANSWER

from .filters import RATING_RANGE
from .numbering import number_rows

# The answers a preference question accepts and the score range.
PREFERENCE_ANSWERS = ("A", "B", "平局", "都不好")
SCORE_RANGE = (1, 5)


def utc_now() -> Column:
    """Current time as ISO-8601 text with a +00:00 offset, in any session time zone."""
    utc = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return F.concat(F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def with_defaults(entries: DataFrame, created_at: Column | None = None) -> DataFrame:
    """Entries with the optional columns filled: tags, notes, created_at."""
    present = set(entries.columns)
    stamp = created_at if created_at is not None else utc_now()

    def filled(name: str, default: Column) -> Column:
        return F.coalesce(F.col(name), default) if name in present else default

    return entries.withColumns(
        {
            "tags": filled("tags", F.lit("")),
            "notes": filled("notes", F.lit("")),
            "created_at": filled("created_at", stamp),
        }
    )


def rejection() -> Column:
    """Why a feedback row cannot be stored; null when it can."""
    low, high = RATING_RANGE
    checks = [
        (F.col("prompt").isNull(), "prompt is null"),
        (F.col("response").isNull(), "response is null"),
        (F.col("rating").isNull(), "rating is null"),
        (~F.col("rating").between(low, high), "rating out of range"),
    ]
    reason = F.when(*_case(checks[0]))
    for check in checks[1:]:
        reason = reason.when(*_case(check))
    return reason


def _case(check: tuple[Column, str]) -> tuple[Column, Column]:
    return check[0], F.lit(check[1])


def feedback_checks(entries: DataFrame) -> DataFrame:
    """Add ``reason``: null for rows that may be stored."""
    return entries.withColumn("reason", rejection())


def read_feedback(spark: SparkSession, path: str) -> DataFrame:
    """The stored table; order it by ``id`` where order matters."""
    return spark.read.schema(FEEDBACK).parquet(path)


def _last_id(spark: SparkSession, path: str) -> int:
    if not exists(spark, path):
        return 0
    return read_feedback(spark, path).agg(F.max("id")).first()[0] or 0


def append_feedback(
    entries: DataFrame, path: str, order: list[str], created_at: Column | None = None
) -> tuple[int, int]:
    """Store the valid entries; ids go on from the largest one, in ``order``.

    Rows with a reason in ``feedback_checks`` are added to ``<path>_rejected``, all
    columns as text, with that reason. Returns how many rows were stored and
    rejected. One writer at a time: ids are taken from the table as it is.
    """
    spark = entries.sparkSession
    checked = with_defaults(entries, created_at).withColumn("reason", rejection())
    columns = ["prompt", "response", "rating", "tags", "notes", "created_at", "reason"]
    refused = checked.where("reason is not null").select(*[F.col(c).cast("string") for c in columns])
    rejected = Observation()
    refused.observe(rejected, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(f"{path}_rejected")
    valid = checked.where("reason is null")
    stored = Observation()
    numbered = number_rows(valid, order, "id", _last_id(spark, path) + 1)
    numbered.select(
        F.col("id").cast("long"),
        "prompt",
        "response",
        F.col("rating").cast("int"),
        "tags",
        "notes",
        "created_at",
    ).observe(stored, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(path)
    return stored.get["rows"], rejected.get["rows"]


def preference_tasks(records: DataFrame) -> DataFrame:
    """Annotation records: the three texts and empty, typed answer columns."""
    answers = [F.lit(None).cast(f.dataType).alias(f.name) for f in PREFERENCE_ANSWER.fields]
    return records.select("*", *answers)


def valid_answer() -> Column:
    """Answer columns hold allowed values; the reason is optional."""
    low, high = SCORE_RANGE
    return F.coalesce(
        F.col("preference").isin(*PREFERENCE_ANSWERS) & F.col("score").between(low, high), F.lit(False)
    )


def low_ratings(entries: DataFrame, below: int = 3) -> DataFrame:
    """Entries that may be stored and are rated under ``below``, with all their columns."""
    return entries.where(rejection().isNull() & (F.col("rating") < below))
