"""Event-time deduplication of a stream: a watermark bounds the state and decides what is late."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# Events may come this much later than the newest one seen.
DELAY = "10 minutes"


def first_events(events: DataFrame, keys: Sequence[str], time: str, delay: str = DELAY) -> DataFrame:
    """The first event of every key on the stream; a key is forgotten when the watermark is ``delay`` past it.

    An event that is not newer than the watermark is late and dropped. The state holds
    a key and an expiry per key, for keys within the delay only, so it does not grow
    with the stream. Rows with a null time are late; null keys are a key.
    """
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def deduplicate_stream(
    events: DataFrame,
    output: str,
    checkpoint: str,
    keys: Sequence[str],
    time: str,
    delay: str = DELAY,
    **trigger,
) -> StreamingQuery:
    """Start writing the first events of a stream to ``output``; returns the running query.

    Every batch owns one folder and replaces it when it runs again, so a restart
    from ``checkpoint`` neither loses nor doubles events.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{output}/batch={batch_id}")

    return (
        first_events(events, keys, time, delay)
        .writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def progress_counts(query: StreamingQuery) -> dict[str, int]:
    """Of a query that has ended: events read, and late ones dropped, in all its batches.

    Spark keeps the progress of the last batches (``spark.sql.streaming.numRecentProgressUpdates``);
    a run with more batches than that needs a listener.
    """
    read = late = 0
    for progress in query.recentProgress:
        read += progress["numInputRows"]
        late += sum(state["numRowsDroppedByWatermark"] for state in progress["stateOperators"])
    return {"read": read, "late": late}


def utc_micros(time: str):
    """A timestamp column as microseconds since 1970, whatever the session's time zone."""
    return F.unix_micros(F.col(time).cast("timestamp"))
