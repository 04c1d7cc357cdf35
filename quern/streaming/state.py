"""Kept fingerprints between batches, laid out by pinned bits so that a batch reads its own buckets only."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators.near import MAX_DISTANCE, bit_groups, pinned
from quern.session import exists, hadoop_path, stage

# Leading bits of a pinned group that name its bucket: 64 partitions. A corpus of many millions of texts
# takes 8 (1,024 partitions); a small one pays for every file.
BUCKET_BITS = 4
# Batches that are kept apart before they are merged into a new base.
COMPACT_AFTER = 8

_ROW = "key binary, seq long, fp long, mask int, bucket int"


class FingerprintState:
    """(key, seq, fp) of all kept texts, in a folder.

    Two fingerprints within ``max_distance`` agree on one of ``max_distance + 1``
    groups of bits. Every text has one row per group, in the partition of that
    group's number (``mask``) and leading bits (``bucket``). A batch owns a folder
    ``batch=<n>``; every COMPACT_AFTER batches all that came before are merged into
    ``base=<n>`` with one file per partition, so neither folders nor small files
    pile up. A batch that runs again sees what it saw the first time: folders
    before its number, and no base made after it.
    """

    def __init__(self, spark: SparkSession, path: str, max_distance: int = MAX_DISTANCE, bucket_bits: int = BUCKET_BITS):
        self.spark, self.path, self.groups, self.bits = spark, path.rstrip("/"), bit_groups(max_distance + 1), bucket_bits

    def _placed(self, rows: DataFrame) -> DataFrame:
        """One row per bit group: ``mask``, ``pin`` and ``bucket`` added."""
        every = F.array(*[F.struct(F.lit(i).alias("mask"), pin.alias("pin"), bucket.alias("bucket")) for i, pin, bucket in self._pins()])
        return rows.withColumn("_p", F.explode(every)).select(*rows.columns, "_p.*")

    def _pins(self) -> list[tuple[int, Column, Column]]:
        out = []
        for i, (low, high) in enumerate(self.groups):
            width = min(self.bits, high - low)
            bucket = F.shiftrightunsigned("fp", high - width).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
            out.append((i, pinned(F.col("fp"), low, high), bucket.cast("int")))
        return out

    def _folders(self, kind: str) -> list[int]:
        """Numbers of the complete folders of a kind."""
        if not exists(self.spark, self.path):
            return []
        files, target = hadoop_path(self.spark, self.path)
        names = [status.getPath().getName() for status in files.listStatus(target)]
        numbers = [int(m[1]) for m in (re.fullmatch(rf"{kind}=(\d+)", n) for n in names) if m]
        return sorted(n for n in numbers if exists(self.spark, f"{self.path}/{kind}={n}/_SUCCESS"))

    def _live(self, batch: int) -> list[str]:
        """Folders that hold what was kept before ``batch``, each text once."""
        base = max((n for n in self._folders("base") if n <= batch), default=0)
        names = [f"base={base}"] if base else []
        return names + [f"batch={n}" for n in self._folders("batch") if base <= n < batch]

    def _read(self, names: list[str]) -> DataFrame:
        """The rows of some folders, of which there are few; each has its own partitions."""
        tables = [self.spark.read.schema(_ROW).parquet(f"{self.path}/{n}") for n in names]
        return reduce(DataFrame.unionByName, tables or [self.spark.createDataFrame([], _ROW)])

    def _write(self, rows: DataFrame, name: str) -> None:
        dealt = rows.repartition("mask", "bucket")
        dealt.write.mode("overwrite").partitionBy("mask", "bucket").parquet(f"{self.path}/{name}")

    def known(self, prints: DataFrame, batch: int) -> DataFrame:
        """(key, seq, fp) of the texts kept before ``batch`` that agree with one of
        ``prints`` (fp) on a bit group; only those can be equal or near.

        The batch's buckets, no more than there are partitions, become a partition
        filter, so no other file is opened.
        """
        given = stage(self._placed(prints.select("fp").distinct()).select("mask", "bucket", "pin").distinct(), "pins")
        hits: dict[int, list[int]] = {}
        for r in given.select("mask", "bucket").distinct().collect():  # at most groups * 2**bits
            hits.setdefault(r.mask, []).append(r.bucket)
        wanted = F.lit(False)
        for mask, buckets in hits.items():
            wanted = wanted | ((F.col("mask") == mask) & F.col("bucket").isin(sorted(buckets)))
        held = self._read(self._live(batch)).where(wanted)
        pin = F.lit(None).cast("long")
        for i, value, _ in self._pins():
            pin = F.when(F.col("mask") == i, value).otherwise(pin)
        met = held.withColumn("pin", pin).join(given.select("mask", "pin"), ["mask", "pin"], "left_semi")
        return met.select("key", "seq", "fp").dropDuplicates(["seq"])

    def commit(self, kept: DataFrame, batch: int) -> None:
        """Store what ``batch`` kept: (key, seq, fp). Replaces what it stored before."""
        self._write(self._placed(kept.select("key", "seq", "fp")).drop("pin"), f"batch={batch}")

    def compact(self, batch: int) -> bool:
        """Merge the folders before ``batch`` when there are enough; call before ``batch`` is read.

        Folders that the base before this one covers are deleted; nothing reads them any more.
        """
        bases = self._folders("base")
        names = self._live(batch)
        if batch in bases or len(names) <= COMPACT_AFTER:
            return False
        self._write(self._read(names), f"base={batch}")
        last = max(bases, default=0)
        for kind, numbers in (("batch", self._folders("batch")), ("base", bases)):
            for n in numbers:
                if n < last:
                    files, target = hadoop_path(self.spark, f"{self.path}/{kind}={n}")
                    files.delete(target, True)
        return True
