"""Incremental preparation: each micro-batch is decided against all texts kept so far."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quern.functions.text import clean_text
from quern.operators.filters import MIN_CLEAN_CHARS
from quern.operators.near import MAX_DISTANCE
from quern.operators.outcomes import Decisions, record_traits
from quern.session import stage

from .state import BUCKET_BITS, FingerprintState

def prepare_stream(
    docs: DataFrame,
    output: str,
    state: str,
    checkpoint: str,
    order: str = "doc_id",
    text: str = "text",
    min_chars: int = MIN_CLEAN_CHARS,
    max_distance: int = MAX_DISTANCE,
    family: str = "blake2b",
    bucket_bits: int = BUCKET_BITS,
    **trigger,
) -> StreamingQuery:
    """Start preparing a stream of documents; returns the running query.

    ``order`` must be unique and grow from batch to batch; then the result equals
    that of the batch job over all documents. The state (``FingerprintState``) holds
    narrow rows (digest, order, fingerprint) by bucket; a batch reads the buckets of
    its own fingerprints. An equal text has an equal fingerprint, so that is where its
    digest is. Every batch owns one folder of ``output`` and ``state`` and replaces it
    when it is run again, so a restart neither loses nor doubles records.
    """

    def prepare_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        kept_before = FingerprintState(spark, state, max_distance, bucket_bits)
        kept_before.compact(batch_id)
        traits = stage(record_traits(batch, order, text, min_chars, family), "batch")
        known = stage(kept_before.known(traits.where("fp IS NOT NULL"), batch_id), "known")
        decisions = Decisions(traits, max_distance, known)
        kept = decisions.kept().withColumnRenamed("seq", order)
        rows = batch.join(kept, order, "left_semi").withColumn(text, clean_text(F.col(text)))
        rows.write.mode("overwrite").parquet(f"{output}/batch={batch_id}")
        kept_before.commit(decisions.kept_texts(), batch_id)

    return (
        docs.writeStream.foreachBatch(prepare_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
