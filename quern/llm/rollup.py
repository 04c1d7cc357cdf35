"""Token-count rollups kept up to date by signed deltas.

A change is a signed row: +1 for what a document counts from now on, -1 for what it
counted before. Inserts, deletes and revised counts (a -1 and a +1) are all sums, so a
batch is pre-aggregated to one row per source, language and tokenizer version, and
the totals are the sums over all committed batches; a document's text or count is
never read again.

A batch is written beside the commits and then renamed to its own id, which the file
system does once or not at all. A batch that is committed already is skipped, so a
batch may be sent again after any failure. ``compact`` folds commits into one
snapshot that names the batches it holds.

Defined results: null source, language or tokenizer are groups of their own; a null
count adds a document without tokens; a group whose documents and tokens have all
gone is left out of the totals.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.packing import encoder
from quern.session import exists, hadoop_path

KEYS = ["source", "lang", "tokenizer"]
_SUMS = "source string, lang string, tokenizer string, docs long, tokens long"


def token_counts(texts: DataFrame, vocabulary: str, text_col: str = "text", count_col: str = "tokens") -> DataFrame:
    """``texts`` without its text column, with the number of tokens (null text: 0)."""
    import pyarrow as pa

    others = [c for c in texts.columns if c != text_col]
    kinds = ", ".join(f"`{c}` {texts.schema[c].dataType.simpleString()}" for c in others)

    def run(batches):
        encode = encoder(vocabulary)
        for batch in batches:
            n = [len(encode(t)) if t else 0 for t in batch.column(len(others)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(n, pa.int64())], names=[*others, count_col])

    return texts.select(*[f"`{c}`" for c in others], text_col).mapInArrow(run, f"{kinds}, {count_col} long")


def changes(before: DataFrame, after: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Signed rows that turn ``before`` into ``after`` (id, source, lang, tokenizer, tokens; one row per id and tokenizer)."""
    left = before.select(id_col, *KEYS, "tokens", F.lit(-1).alias("sign"))
    right = after.select(id_col, *KEYS, "tokens", F.lit(1).alias("sign"))
    net = left.unionByName(right).groupBy(id_col, *KEYS, "tokens").agg(F.sum("sign").cast("int").alias("sign"))
    return net.where("sign != 0")


class Rollup:
    """Totals by source, language and tokenizer version under a folder of any Hadoop file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def commit(self, batch: str, signed: DataFrame) -> bool:
        """Add a batch of signed rows (source, lang, tokenizer, tokens, sign); False if it is there already."""
        if not re.fullmatch(r"[A-Za-z0-9-]+", batch):
            raise ValueError(f"batch id {batch!r}: letters, digits and hyphens only")
        if batch in self.batches():
            return False
        sums = signed.groupBy(*KEYS).agg(
            F.sum(F.col("sign").cast("long")).alias("docs"),
            F.sum(F.col("sign") * F.coalesce("tokens", F.lit(0))).cast("long").alias("tokens"),
        )
        beside = f"{self.path}/writing/{uuid.uuid4().hex}"
        sums.where("docs != 0 or tokens != 0").write.parquet(beside)
        files, source = hadoop_path(self.spark, beside)
        _, target = hadoop_path(self.spark, f"{self.path}/commits/{batch}")
        files.mkdirs(target.getParent())
        # A rename onto a folder that another writer made first would move into it.
        if files.exists(target) or not files.rename(source, target):
            files.delete(source, True)
            return False
        return True

    def batches(self) -> set[str]:
        """Committed batches, those in the snapshot included."""
        return self._listed() | self._snapshot()[1]

    def _listed(self) -> set[str]:
        if not exists(self.spark, f"{self.path}/commits"):
            return set()
        files, folder = hadoop_path(self.spark, f"{self.path}/commits")
        return {s.getPath().getName() for s in files.listStatus(folder)}

    def _snapshot(self) -> tuple[str | None, set[str]]:
        """Newest snapshot and the batches it holds."""
        if not exists(self.spark, f"{self.path}/snapshots"):
            return None, set()
        files, folder = hadoop_path(self.spark, f"{self.path}/snapshots")
        names = sorted(s.getPath().getName() for s in files.listStatus(folder))
        if not names:
            return None, set()
        path = f"{self.path}/snapshots/{names[-1]}"
        return path, {r.batch for r in self.spark.read.parquet(f"{path}/batches").collect()}

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, docs, tokens."""
        snapshot, held = self._snapshot()
        parts = [f"{self.path}/commits/{b}" for b in sorted(self._listed() - held)]
        if snapshot:
            parts.append(f"{snapshot}/sums")
        rows = self.spark.read.schema(_SUMS).parquet(*parts) if parts else self.spark.createDataFrame([], _SUMS)
        sums = rows.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return sums.where("docs != 0 or tokens != 0")

    def compact(self) -> None:
        """Fold all commits into a new snapshot; commits it holds are no longer read, and may be deleted later."""
        held = sorted(self.batches())
        snapshot, _ = self._snapshot()
        number = int(snapshot.rpartition("/")[2]) + 1 if snapshot else 1
        beside = f"{self.path}/writing/{uuid.uuid4().hex}"
        self.totals().write.parquet(f"{beside}/sums")
        self.spark.createDataFrame([(b,) for b in held], "batch string").write.parquet(f"{beside}/batches")
        files, source = hadoop_path(self.spark, beside)
        _, target = hadoop_path(self.spark, f"{self.path}/snapshots/{number:010d}")
        files.mkdirs(target.getParent())
        if files.exists(target) or not files.rename(source, target):
            files.delete(source, True)
