"""Dense row numbers over a total order, without a single-partition window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.session import stage, stage_counted

# monotonically_increasing_id() keeps the partition in the upper bits and the
# row's place within it in the lower 33.
_ROW_BITS = 33
# One task may sort this many narrow rows.
SMALL_ROWS = 100_000


def with_offsets(placed: DataFrame, number: str, start: int = 1) -> DataFrame:
    """Turn partition-local places (column ``_at``) into dense numbers.

    ``_at`` orders the rows; its upper bits name the partition. The table of
    partition sizes has one row per partition, which bounds both the window over
    it and its broadcast.
    """
    part = F.shiftrightunsigned("_at", _ROW_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    local = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1).cast("long"))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(number, F.col("_before") + local + start)
        .drop("_part", "_before", "_at")
    )


def number_rows(df: DataFrame, order: list[str], number: str, start: int = 1) -> DataFrame:
    """Add ``number``: start, start + 1, ... in the order of the columns ``order``.

    The rows are written once and counted. Up to SMALL_ROWS of them are numbered
    by a plain window; more are range-partitioned and sorted by Spark, and only
    partition sizes are brought together.
    """
    rows, n = stage_counted(df, "unnumbered")
    if n <= SMALL_ROWS:
        place = F.row_number().over(Window.orderBy(*order)).cast("long")
        return rows.withColumn(number, place + (start - 1))
    placed = (
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    return with_offsets(stage(placed, "numbered"), number, start)
