"""Row keys, staging and connected components for the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.session import hadoop_path, scratch_path

# Removes a query's shuffle files when that query has ended (Spark 4 setting).
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


class Staging:
    """Intermediate tables of one operator call, in the shared scratch folder.

    A written table cuts the lineage, survives lost executors and frees the
    shuffle files of the query that made it. ``drop`` removes tables that are
    not read any more.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = scratch_path(spark, label)
        self.made = 0

    def write(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{self.made}"
        self.made += 1
        with _shuffles_removed(self.spark):
            df.write.parquet(path)
        staged = self.spark.read.schema(df.schema).parquet(path)
        staged.staged_at = path
        return staged

    def drop(self, *tables: DataFrame) -> None:
        for staged in tables:
            files, target = hadoop_path(self.spark, staged.staged_at)
            files.delete(target, True)


def keyed(docs: DataFrame, id_col: str, key: str, staging: Staging) -> tuple[DataFrame, bool]:
    """``docs`` as (``key`` long, ``row`` struct of all its columns), and whether ``key`` is the id.

    The id column is the key where it is an integer column without nulls and
    repeats. Otherwise the rows are written once with a number each, so that
    every later read sees the same keys.
    """
    row = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")
    kind = docs.schema[id_col].dataType
    if isinstance(kind, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        ids = docs.select(F.col(id_col).alias("id"))
        repeated = ids.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or id is null")
        if repeated.isEmpty():
            return docs.select(F.col(id_col).cast("long").alias(key), row), True
    return staging.write(docs.select(F.monotonically_increasing_id().alias(key), row)), False


def components(edges: DataFrame, staging: Staging) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b long); component = smallest node reachable.

    Smallest-label propagation with label jumping; every round is written, and
    the rounds end when no label changes.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = staging.write(both.where("a != b").distinct())
    labels = staging.write(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("label")))
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
        lowest = labels.join(near.agg(F.min("label").alias("_near")), "node")
        lowest = lowest.select("node", F.col("label").alias("_old"), F.least("label", "_near").alias("_low"))
        jump = labels.select(F.col("node").alias("_low"), F.col("label").alias("_jump"))
        moved = lowest.join(jump, "_low", "left").select("node", "_old", F.least("_low", "_jump").alias("label"))
        following = staging.write(moved)
        changed = not following.where("label != _old").isEmpty()
        staging.drop(labels)
        labels = following.select("node", "label")
        labels.staged_at = following.staged_at
        if not changed:
            return labels.select("node", F.col("label").alias("component"))
