"""Writers: JSON Lines, split folders, Parquet, safe replacement, reports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quern.session import exists, hadoop_path


def in_order(df: DataFrame, order: str | list[Column], keep: bool = True) -> DataFrame:
    """Range-sorted rows: the part files, read by name, are in input order."""
    by = [order] if isinstance(order, str) else order
    placed = df.repartitionByRange(*by).sortWithinPartitions(*by)
    return placed if keep else placed.drop(order)


def write_jsonl(df: DataFrame, path: str, order: str | None = None, keep_order: bool = True) -> None:
    """One JSON object per line: UTF-8, nulls written, existing output replaced.

    ``keep_order=False`` leaves the ordering column out of the output.
    """
    _save_json(in_order(df, order, keep_order) if order else df, path)


def _save_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_json_lines(lines: DataFrame, path: str, order: str) -> None:
    """Write ready-made JSON texts (column ``value``) in the order of ``order``."""
    in_order(lines.select(order, "value"), order, keep=False).write.mode("overwrite").text(path)


def write_split(df: DataFrame, keep: Column, path: str) -> None:
    """Kept and removed rows to separate folders, in one pass over the input."""
    split = F.when(F.coalesce(keep, F.lit(False)), "kept").otherwise("removed")
    df.withColumn("split", split).write.mode("overwrite").option("ignoreNullFields", "false").partitionBy(
        "split"
    ).json(path)


def write_parquet_counted(df: DataFrame, path: str) -> int:
    """Write Parquet and return the number of rows, without a second pass."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return seen.get["rows"]


def write_jsonl_counted(
    df: DataFrame, path: str, order: str | list[Column] | None = None, keep_order: bool = True
) -> int:
    """Write JSON Lines and return the number of rows.

    Counted after the sort: range partitioning samples its input, and rows below
    it would be seen twice.
    """
    seen = Observation()
    ordered = in_order(df, order, keep_order) if order else df
    _save_json(ordered.observe(seen, F.count(F.lit(1)).alias("rows")), path)
    return seen.get["rows"]


def replace_output(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Let ``write`` fill a folder beside ``path``, then swap: no half output is seen.

    The old output is moved aside first and removed after the swap.
    """
    fresh, old = f"{path}.tmp", f"{path}.old"
    write(fresh)
    files, target = hadoop_path(spark, path)
    _, ready = hadoop_path(spark, fresh)
    _, aside = hadoop_path(spark, old)
    files.delete(aside, True)
    if files.exists(target) and not files.rename(target, aside):
        raise OSError(f"cannot move {path} aside")
    if not files.rename(ready, target):
        raise OSError(f"cannot move {fresh} to {path}")
    files.delete(aside, True)


def is_complete(spark: SparkSession, path: str) -> bool:
    """True when a job has committed its whole output to ``path``."""
    return exists(spark, f"{path}/_SUCCESS")


def with_map(report: DataFrame, rows: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Add a (key -> value) map to a one-row report; only for keys of a fixed, short list."""
    folded = rows.agg(F.map_from_entries(F.collect_list(F.struct(F.col(key), F.col(value)))).alias(name))
    return _beside(report, folded)


def _beside(left: DataFrame, right: DataFrame) -> DataFrame:
    one = F.lit(1)
    return (
        left.withColumn("_one", one).join(F.broadcast(right.withColumn("_one", one)), "_one").drop("_one")
    )


def write_json_report(report: DataFrame, path: str, **parts: tuple[DataFrame, str | list[Column]]) -> None:
    """A one-row report as one indented JSON object, with lists and maps as rows beside it.

    Each part is (rows, order) and goes to ``<path>_<name>`` as JSON Lines,
    whatever its size; the object has its number of rows as ``<name>_rows``.
    """
    for name, (rows, order) in parts.items():
        written = write_jsonl_counted(rows, f"{path}_{name}", order)
        report = report.withColumn(f"{name}_rows", F.lit(written).cast("long"))
    options = {"pretty": "true", "ignoreNullFields": "false"}
    text = report.select(F.to_json(F.struct("*"), options).alias("value"))
    text.coalesce(1).write.mode("overwrite").text(path)
