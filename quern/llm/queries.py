"""Registered queries of this subpackage, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import (
    centroids,
    extendible,
    hyperminhash,
    langid,
    licenses,
    nearest,
    packing,
    pieces,
    repeats,
    rollup,
    sitetree,
    toxicity,
    whitening,
)
from quern.llm.common import Staging

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


@_query("op1_token_rollup")
def op1_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, then two revisions: other languages than English change to the
    multilingual tokenizer, toxic documents go; every batch is sent twice."""
    staging = Staging(spark, "rollup")
    docs = _table(spark, sf_dir, "documents")
    first, second = "byte_bpe_50k", "byte_bpe_multi_50k"
    keys = [c for c in ("doc_id", "source", "lang")]
    loaded = rollup.token_counts(docs.select(*keys, "text"), first).withColumn("tokenizer", F.lit(first))
    loaded = staging.write(loaded)
    other = docs.where("lang is null or lang != 'en'")
    revised = rollup.token_counts(other.select(*keys, "text"), second).withColumn("tokenizer", F.lit(second))
    revised = staging.write(revised)
    moved = rollup.changes(loaded.where("lang is null or lang != 'en'"), revised)
    current = loaded.where("lang = 'en'").unionByName(revised)
    toxic = _table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id").distinct()
    totals = rollup.Rollup(spark, f"{staging.root}/totals")
    for _ in range(2):
        totals.commit("load", loaded.withColumn("sign", F.lit(1)))
        totals.commit("revise", moved)
        totals.commit("delete", current.join(toxic, "doc_id").withColumn("sign", F.lit(-1)))
    return totals.totals()


@_query("op3_sentencepiece")
def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pieces.encode_documents(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("row.doc_id", "n_pieces", "ids_crc32", "decoded_sha256", "round_trip")


@_query("op2_nearest_neighbours")
def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(_table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 50 == 0, k=5)


@_query("op4_license_scan", licenses.licenses_sql())
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf_dir, "documents"))


OP5_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@_query("op5_exact_dedup", OP5_SQL)
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = extendible.exact_groups(_table(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


@_query("op6_repeat_removal")
def op6_repeat_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strings of 400 bytes up to ``kept_text``; after it, repeated passages of over 50 words, which may be shorter."""
    found = repeats.remove_repeats(_table(spark, sf_dir, "documents"), passages=True)
    strings = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"]
    return found.select(F.col("row.doc_id").alias("doc_id"), *strings, "passage_text", "n_passage_removed", "n_passages")


@_query("op7_best_fit_packing")
def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


@_query("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    scored = toxicity.score_documents(docs.select("doc_id", "text"), model)
    doc_id = F.col("row.doc_id")
    return scored.select(doc_id.alias("doc_id"), toxicity.held_out(doc_id).alias("held_out"), "score", "predicted")


@_query("op9_language_id")
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    labelled = langid.label_documents(docs.select("doc_id", "text"), langid.fit(docs))
    doc_id = F.col("row.doc_id")
    return labelled.select(doc_id.alias("doc_id"), langid.held_out(doc_id).alias("held_out"), "lang_pred", "score")


@_query("op10_near_dedup")
def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = hyperminhash.near_components(_table(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


@_query("op11_html_extraction")
def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sitetree.extract_main(_table(spark, sf_dir, "pages"))
    return found.select(F.col("row.page_id").alias("page_id"), F.col("row.url").alias("url"), "text", "n_chars")


@_query("op12_embedding_whitening")
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


@_query("op13_centroid_clustering")
def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(_table(spark, sf_dir, "embeddings"))
