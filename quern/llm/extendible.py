"""Exact deduplication over an extendible-hash index on shared files.

All steps are DataFrame operations. A directory maps the upper bits of a text's
64-bit hash to a bucket. It starts at the depth that gives buckets of the wanted
capacity on average; where a bucket is overfull the directory doubles for it, so
it splits by one more bit, until every bucket fits. The index is written to the
shared folder in bucket order, so that each task owns a range of keys. A row looks
its bucket up in the directory and meets the index entries of that bucket only.
Within a bucket, texts with the same hash form chains: the row with the largest id is
compared byte by byte with the others, and those that differ form the next chain.

Copies never meet in one task: counts are combined on the map side, and the
comparison deals a group of n rows over n / SALT_ROWS tasks. Joins that fetch texts
always shuffle: the list of copies grows with the input, so it is never broadcast,
however short it is on a small table.

Defined results: null text counts as empty, so null and empty texts are copies;
rows with a null id order before all ids; repeated rows are copies of each other.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import Staging, keyed
from quern.operators.skew import join_groups

CAPACITY = 65_536
# Doublings beyond the starting depth that the cell counts can tell apart.
EXTRA_DEPTH = 6
SALT_ROWS = 2_000


def build_directory(hashes: DataFrame, staging: Staging, capacity: int = CAPACITY) -> tuple[DataFrame, int]:
    """(cell, bucket, depth, n) and the cells' depth, for distinct ``hash`` values.

    A cell is the hash's upper bits at the largest depth looked at; ``bucket`` is
    the lowest cell of the bucket. A bucket that is overfull even there stays so.
    """
    n = hashes.count()
    depth = max(1, math.ceil(math.log2(max(n, 1) / capacity))) if n > capacity else 1
    deepest = min(depth + EXTRA_DEPTH, 62)
    cell = F.shiftrightunsigned("hash", 64 - deepest).alias("cell")
    rest = staging.write(hashes.groupBy(cell).agg(F.count(F.lit(1)).alias("n")))
    placed: list[DataFrame] = []
    while True:
        bits = deepest - depth
        bucket = F.shiftleft(F.shiftrightunsigned("cell", bits), bits).alias("bucket")
        sizes = rest.groupBy(bucket).agg(F.sum("n").alias("total"))
        sized = staging.write(rest.select("cell", bucket).join(sizes, "bucket"))
        fits = F.lit(True) if depth == deepest else F.col("total") <= capacity
        placed.append(sized.where(fits).select("cell", "bucket", F.lit(depth).alias("depth"), F.col("total").alias("n")))
        rest = rest.join(sized.where(~fits).select("cell"), "cell", "left_semi")
        if depth == deepest or rest.isEmpty():
            directory = placed[0]
            for more in placed[1:]:
                directory = directory.unionByName(more)
            return directory, deepest
        depth += 1


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise: Callable[[Column], Column] | None = None,
    hash_of: Callable[[Column], Column] = F.xxhash64,
    capacity: int = CAPACITY,
) -> tuple[DataFrame, DataFrame]:
    """(rows, source): ``rows`` has key, id, keep_key, keep_id, group_size, kept and
    text_sha256 for every row; ``source`` has key and the input row."""
    staging = Staging(docs.sparkSession, "extendible")
    source, _ = keyed(docs, id_col, "key", staging)
    text = F.coalesce(F.col("row").getField(text_col), F.lit(""))
    text = normalise(text) if normalise else text
    narrow = staging.write(
        source.select(
            "key", F.col("row").getField(id_col).alias("id"), hash_of(text).cast("long").alias("hash"), F.sha2(text, 256).alias("text_sha256")
        )
    )
    groups = staging.write(
        narrow.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("id", "key")).alias("head"))
    )
    directory, depth = build_directory(groups.select("hash"), staging, capacity)
    cell = F.shiftrightunsigned("hash", 64 - depth).alias("cell")
    # Directory cells that hold chains, with all their rows, which a hot cell has many of.
    cells = groups.groupBy(cell).agg(F.sum("n").alias("rows"), F.max("n").alias("longest")).where("longest > 1")
    routes = staging.write(cells.join(directory.select("cell", "bucket"), "cell").select("cell", "bucket", "rows"))
    # The index: entries in bucket order, one range of keys per task.
    entry = F.struct("bucket", "hash").alias("entry")
    index = staging.write(
        groups.where("n > 1")
        .withColumn("cell", cell)
        .join(routes, "cell")
        .select(entry, "n", F.col("head.key").alias("head"))
        .repartitionByRange("entry")
        .sortWithinPartitions("entry")
    )
    routed = join_groups(narrow.select("key", "id", "hash", cell), routes, "cell", "rows").select("key", "id", entry)
    salts = F.ceil(F.col("n") / SALT_ROWS).cast("int")
    open_rows = staging.write(
        join_groups(routed, index, "entry", "n").select(
            "key", "id", "entry", F.pmod(F.xxhash64("key"), salts.cast("long")).alias("salt"), salts.alias("salts"), "head"
        )
    )
    texts = staging.write(
        source.select("key", text.alias("text")).join(open_rows.select("key", "entry", "salt").hint("merge"), "key")
    )
    chained = None
    while True:
        heads = open_rows.where("key = head").select("key", "salts").hint("merge")
        heads = heads.join(texts.select("key", "entry", "text"), "key")
        heads = heads.select(
            F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts").cast("long") - 1)).alias("salt"), "entry", F.col("key").alias("head"), F.col("text").alias("head_text")
        )
        waiting = texts.join(open_rows.select("key"), "key", "left_semi") if chained is not None else texts
        compared = staging.write(
            waiting.join(heads.hint("merge"), ["entry", "salt"]).select("key", "head", (F.col("text") == F.col("head_text")).alias("same"))
        )
        equal = compared.where("same").select("key", F.col("head").alias("keep_key"))
        chained = equal if chained is None else chained.unionByName(equal)
        differ = compared.where("not same").select("key")
        if differ.isEmpty():
            break
        # Collision: the rest of the entry's rows make the next chain.
        left = open_rows.join(differ, "key").drop("head")
        nexts = left.groupBy("entry").agg(F.max(F.struct("id", "key")).alias("_h"), F.count(F.lit(1)).alias("n"))
        nexts = nexts.select("entry", "n", F.col("_h.key").alias("head"))
        open_rows = staging.write(join_groups(left, nexts, "entry", "n").drop("n"))
    sizes = chained.groupBy("keep_key").agg(F.count(F.lit(1)).alias("group_size"))
    heads = sizes.join(narrow.select(F.col("key").alias("keep_key"), F.col("id").alias("keep_id")), "keep_key")
    grouped = join_groups(chained, staging.write(heads), "keep_key", "group_size")
    rows = narrow.join(grouped, "key", "left").select(
        "key",
        "id",
        F.coalesce("keep_key", "key").alias("keep_key"),
        F.when(F.col("keep_key").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.coalesce("keep_key", "key") == F.col("key")).alias("kept"),
        "text_sha256",
    )
    return rows, source


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    rows, source = exact_groups(docs, id_col, text_col)
    return source.join(rows.where("kept").select("key"), "key").select("row.*")
