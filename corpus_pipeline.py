"""Corpus pipeline: toxicity, exact copies, near copies, repeated passages, packing.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and
returns the columns of ``documents``; the last returns one row per packed piece.
``run`` writes each stage's result to the shared scratch folder and rereads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.extendible import drop_copies
from quern.llm.hyperminhash import drop_near_copies
from quern.llm.packing import pack_documents
from quern.llm.repeats import PASSAGE_BYTES, PASSAGE_WORDS, remove_repeats
from quern.llm.toxicity import drop_toxic
from quern.session import stage

# Words in a shingle of the near_dedup stage.
SHINGLE = 5

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the clause grammar does not reject."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: that with the largest id."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component: that with the smallest id."""
    return drop_near_copies(docs, shingle=SHINGLE)


def repeat_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of over PASSAGE_WORDS words that occur elsewhere too; ``n_chars`` follows the text."""
    found = remove_repeats(docs, length=PASSAGE_BYTES, spare_words=PASSAGE_WORDS)
    columns = {c: F.col("row").getField(c) for c in docs.columns if c != "text"}
    columns |= {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return found.select(*[columns[c].alias(c) for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document, with its place in a sequence."""
    return pack_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("repeat_removal", repeat_removal),
    ("packing", packing),
]

# Learned scores, components and packing have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
