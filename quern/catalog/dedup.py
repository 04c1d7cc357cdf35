"""Exact and near deduplication over ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.catalog import query, sql, table
from quern.functions.hashing import simhash64
from quern.operators import exact, near
from quern.operators.outcomes import Decisions, record_traits, rejected
from quern.plans.prepare import prepare
from quern.session import scratch_path, spread, stage
from quern.streaming.ingest import prepare_stream


def _docs(spark, sf):
    return spread(table(spark, sf, "documents"), "doc_id")


def _prints(spark, sf):
    """(seq, fp) of all documents, MD5 family."""
    return _docs(spark, sf).select(F.col("doc_id").alias("seq"), simhash64(F.col("text"), "md5").alias("fp"))


def _wide(spark, sf):
    """Every document, and a copy of it with one word more under a number of its own."""
    docs = _docs(spark, sf).select("doc_id", "text")
    edited = docs.select((2 * F.col("doc_id") + 1).alias("doc_id"), F.concat("text", F.lit(" appendix")).alias("text"))
    return docs.withColumn("doc_id", 2 * F.col("doc_id")).unionByName(edited)


def _wide_prints(spark, sf):
    return _wide(spark, sf).select(F.col("doc_id").alias("seq"), simhash64(F.col("text"), "md5").alias("fp"))


def _heads(prints):
    return prints.groupBy("fp").agg(F.min("seq").alias("seq")).select("seq", "fp")


_PAIRS = """WITH RECURSIVE {votes},
    heads AS (SELECT min(doc_id) AS doc_id, fp FROM prints GROUP BY fp),{greedy}"""


_WIDE_DOCS = """(SELECT 2 * doc_id AS doc_id, text FROM documents
      UNION ALL SELECT 2 * doc_id + 1, text || ' appendix' FROM documents)"""


def _greedy(docs="documents"):
    return _PAIRS.format(votes=sql.votes_ctes(docs), greedy=sql.greedy_ctes("heads", 3))


@query("exact_dedup_sha256", f"WITH {sql.distinct_clean_ctes(0)} SELECT doc_id, text FROM firsts")
def exact_dedup_sha256(spark, sf):
    return exact.exact_dedup_sha256(_docs(spark, sf)).select("doc_id", "text")


@query(
    "exact_dedup_text",
    f"""WITH s AS (SELECT doc_id, {sql.strip('text')} AS text FROM documents)
    SELECT min(doc_id) AS doc_id, text FROM s WHERE length(text) >= 15 GROUP BY text""",
)
def exact_dedup_text(spark, sf):
    return exact.exact_dedup_text(_docs(spark, sf)).select("doc_id", "text")


@query("near_dup_pairs", f"{_greedy()} SELECT a, b, distance FROM edges")
def near_dup_pairs(spark, sf):
    pairs = near.near_dup_pairs(stage(_heads(_prints(spark, sf)), "heads"))
    return pairs.withColumn("distance", F.col("distance").cast("bigint"))


@query("near_dup_pairs_wide", f"{_greedy(_WIDE_DOCS)} SELECT a, b, distance FROM edges")
def near_dup_pairs_wide(spark, sf):
    """Every document and an edited copy: most documents have a pair."""
    pairs = near.near_dup_pairs(stage(_heads(_wide_prints(spark, sf)), "heads"))
    return pairs.withColumn("distance", F.col("distance").cast("bigint"))


def _survivors_sql(docs="documents"):
    return f"""{_greedy(docs)}
    SELECT doc_id FROM heads WHERE doc_id NOT IN (SELECT doc_id FROM losers)"""


@query("near_dedup_greedy", _survivors_sql())
def near_dedup_greedy(spark, sf):
    return near.near_dedup_greedy(_prints(spark, sf)).select(F.col("seq").alias("doc_id"))


@query("near_dedup_greedy_wide", _survivors_sql(_WIDE_DOCS))
def near_dedup_greedy_wide(spark, sf):
    return near.near_dedup_greedy(_wide_prints(spark, sf)).select(F.col("seq").alias("doc_id"))


def _outcomes_sql(family="md5"):
    return f"""WITH RECURSIVE {sql.distinct_clean_ctes()},{sql.votes_ctes('firsts', family=family)},
    heads AS (SELECT min(doc_id) AS doc_id, fp FROM prints GROUP BY fp),{sql.greedy_ctes('heads', 3)},
    kept AS (SELECT doc_id FROM heads WHERE doc_id NOT IN (SELECT doc_id FROM losers)),
    outcomes AS (
      SELECT c.doc_id,
        CASE WHEN length(c.text) < 80 THEN 'short'
             WHEN c.doc_id IN (SELECT doc_id FROM kept) THEN 'kept'
             WHEN f.doc_id IN (SELECT doc_id FROM kept) THEN 'exact_duplicate'
             ELSE 'near_duplicate' END AS status
      FROM cleaned c LEFT JOIN firsts f ON f.text = c.text)"""


_OUTCOMES, _OUTCOMES_BLAKE2B = _outcomes_sql(), _outcomes_sql("blake2b")
_KEPT = """SELECT c.doc_id, c.text, d.lang, d.source, d.n_chars
    FROM cleaned c JOIN outcomes o USING (doc_id) JOIN documents d USING (doc_id)
    WHERE o.status = 'kept'"""


def _decisions(spark, sf, family="md5"):
    return Decisions(record_traits(table(spark, sf, "documents"), "doc_id", family=family))


@query("prepare_outcomes", f"{_OUTCOMES} SELECT doc_id, status FROM outcomes")
def prepare_outcomes(spark, sf):
    return _decisions(spark, sf).outcomes().withColumnRenamed("seq", "doc_id")


@query(
    "prepare_stats",
    f"""{_OUTCOMES} SELECT count(*) AS read, 0::BIGINT AS invalid,
      count(*) FILTER (status = 'short') AS short,
      count(*) FILTER (status = 'exact_duplicate') AS exact_duplicate,
      count(*) FILTER (status = 'near_duplicate') AS near_duplicate,
      count(*) FILTER (status = 'kept') AS kept FROM outcomes""",
)
def prepare_stats(spark, sf):
    return _decisions(spark, sf).stats()


@query("corpus_prepare", f"{_OUTCOMES} {_KEPT}")
def corpus_prepare(spark, sf):
    """MD5 family."""
    return prepare(table(spark, sf, "documents"), family="md5").kept


@query("corpus_prepare_blake2b", f"{_OUTCOMES_BLAKE2B} {_KEPT}")
def corpus_prepare_blake2b(spark, sf):
    """The default family."""
    return prepare(table(spark, sf, "documents")).kept


@query("prepare_outcomes_blake2b", f"{_OUTCOMES_BLAKE2B} SELECT doc_id, status FROM outcomes")
def prepare_outcomes_blake2b(spark, sf):
    return _decisions(spark, sf, "blake2b").outcomes().withColumnRenamed("seq", "doc_id")


@query(
    "rejected_records",
    f"""{_OUTCOMES} SELECT d.*, o.status AS reason FROM documents d JOIN outcomes o USING (doc_id)
    WHERE o.status <> 'kept'""",
)
def rejected_records(spark, sf):
    """The records that preparation leaves out, whole, each with its reason."""
    docs = table(spark, sf, "documents")
    return rejected(docs, _decisions(spark, sf).outcomes(), "doc_id")


@query(
    "incremental_prepare",
    f"""{_OUTCOMES} SELECT doc_id, c.text FROM cleaned c JOIN outcomes o USING (doc_id)
    WHERE o.status = 'kept'""",
)
def incremental_prepare(spark, sf):
    """All documents in three parts by ``doc_id``; the stream takes each up where it ended."""
    path = scratch_path(spark, "stream")
    docs = table(spark, sf, "documents").select("doc_id", "text")
    last = docs.agg(F.max("doc_id")).first()[0]
    for part in range(3):
        low, high = part * (last + 1) // 3, (part + 1) * (last + 1) // 3
        span = docs.where((F.col("doc_id") >= low) & (F.col("doc_id") < high))
        span.write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(docs.schema).parquet(f"{path}/in")
        started = prepare_stream(
            stream, f"{path}/out", f"{path}/state", f"{path}/checkpoint", family="md5"
        )
        started.awaitTermination()
    return spark.read.schema("doc_id long, text string").parquet(f"{path}/out").select("doc_id", "text")
