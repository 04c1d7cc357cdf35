"""What happens to each record: invalid, short, exact or near duplicate, kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.hashing import simhash64, text_key
from quern.functions.text import clean_text
from quern.session import spread, stage

from .filters import MIN_CLEAN_CHARS
from .near import MAX_DISTANCE, near_dedup_greedy
from .skew import HOT_ROWS, join_groups

# The outcome names, in the order in which the checks apply.
STATUSES = ("invalid", "short", "exact_duplicate", "near_duplicate", "kept")


def record_traits(
    docs: DataFrame,
    order: str,
    text: str = "text",
    min_chars: int = MIN_CLEAN_CHARS,
    family: str = "blake2b",
) -> DataFrame:
    """One narrow row per record: (seq, early, key, fp). One scan, no shuffle.

    ``early`` is the verdict that needs no other record (invalid for a null
    text, or short); key and fingerprint are null then. Fingerprints are taken
    in the scan, also for copies: that is cheaper than moving texts first.
    """
    given = spread(
        docs.select(F.col(order).cast("long").alias("seq"), F.col(text).alias("text")), "seq"
    )
    cleaned = given.select("seq", clean_text(F.col("text")).alias("clean"))
    early = F.when(F.col("clean").isNull(), "invalid").when(
        F.length("clean") < min_chars, "short"
    )
    usable = cleaned.select(
        "seq", early.alias("early"), F.when(early.isNull(), F.col("clean")).alias("clean")
    )
    return usable.select(
        "seq",
        "early",
        text_key(F.col("clean")).alias("key"),
        simhash64(F.col("clean"), family).alias("fp"),
    )


class Decisions:
    """Deduplication decisions over the traits of a corpus.

    ``traits`` and ``texts`` are staged narrow tables; everything else is derived
    from them lazily.
    """

    def __init__(
        self,
        traits: DataFrame,
        max_distance: int = MAX_DISTANCE,
        known: DataFrame | None = None,
    ):
        """``known`` (key, seq, fp): texts kept before, all ordered before these records."""
        self.traits = stage(traits, "traits")
        distinct = stage(
            self.traits.where(F.col("early").isNull())
            .groupBy("key")
            .agg(
                F.min("seq").alias("first_seq"),
                F.count(F.lit(1)).alias("copies"),
                F.any_value("fp").alias("fp"),
            ),
            "distinct",
        )
        fresh = distinct
        if known is not None:
            fresh = distinct.join(known.select("key"), "key", "left_anti")
        prints = fresh.select(F.col("first_seq").alias("seq"), "fp")
        before = None if known is None else known.select("seq", "fp")
        survivors = near_dedup_greedy(prints, max_distance, known=before)
        kept = survivors.select(F.col("seq").alias("first_seq"), F.lit(True).alias("kept"))
        texts = distinct.join(kept, "first_seq", "left").fillna(False, ["kept"])
        if known is not None:
            # A text kept before makes all its records here later copies of it.
            before = known.select("key", F.col("seq").alias("_before"))
            texts = texts.join(before, "key", "left").select(
                F.coalesce("_before", "first_seq").alias("first_seq"),
                "key",
                F.when(F.col("_before").isNotNull(), F.col("copies") + 1)
                .otherwise(F.col("copies"))
                .alias("copies"),
                "fp",
                (F.col("kept") | F.col("_before").isNotNull()).alias("kept"),
                F.col("_before").isNull().alias("new"),
            )
        else:
            texts = texts.withColumn("new", F.lit(True))
        self.texts = stage(texts, "texts")

    def kept(self) -> DataFrame:
        """(seq) of the records kept here."""
        return self.kept_texts().select("seq")

    def kept_texts(self) -> DataFrame:
        """(key, seq, fp) of the texts kept here."""
        return self.texts.where("kept AND new").select(
            "key", F.col("first_seq").alias("seq"), "fp"
        )

    def outcomes(self, hot_rows: int = HOT_ROWS) -> DataFrame:
        """(seq, status) of every record.

        Only kept texts count as seen: a later copy of a kept text is an exact
        duplicate, a later copy of a near duplicate is a near duplicate again.
        """
        early = self.traits.where(F.col("early").isNotNull()).select(
            "seq", F.col("early").alias("status")
        )
        rows = self.traits.where(F.col("early").isNull()).select("seq", "key")
        joined = join_groups(rows, self.texts, "key", "copies", hot_rows)
        status = (
            F.when(~F.col("kept"), "near_duplicate")
            .when(F.col("seq") == F.col("first_seq"), "kept")
            .otherwise("exact_duplicate")
        )
        return early.unionByName(joined.select("seq", status.alias("status")))

    def stats(self) -> DataFrame:
        """One row with all six counters, from group sizes alone."""

        def total(amount: Column) -> Column:
            return F.coalesce(F.sum(amount), F.lit(0))

        early = self.traits.agg(
            F.count(F.lit(1)).alias("read"),
            F.count_if(F.col("early") == "invalid").alias("invalid"),
            F.count_if(F.col("early") == "short").alias("short"),
        )
        dup = self.texts.agg(
            total(F.when(F.col("kept"), F.col("copies") - 1)).alias("exact_duplicate"),
            total(F.when(~F.col("kept"), F.col("copies"))).alias("near_duplicate"),
            F.count_if(F.col("kept") & F.col("new")).alias("kept"),
        )
        # Two one-row results side by side.
        return early.withColumn("_one", F.lit(1)).join(
            F.broadcast(dup.withColumn("_one", F.lit(1))), "_one"
        ).drop("_one")


def rejected(docs: DataFrame, outcomes: DataFrame, order: str) -> DataFrame:
    """``docs`` that were not kept, with all their columns and the ``reason``."""
    reasons = outcomes.where("status <> 'kept'").select(
        F.col("seq").alias(order), F.col("status").alias("reason")
    )
    return docs.join(reasons, order)
