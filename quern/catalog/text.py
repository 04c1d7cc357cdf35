"""Text projections, filters and quality reports over ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.catalog import query, sql, table
from quern.functions import hashing, text
from quern.operators import filters, profile, quality
from quern.operators.skew import join_groups
from quern.operators.votes import simhash64_md5, simhash_votes
from quern.session import spread, stage


def _docs(spark, sf):
    return spread(table(spark, sf, "documents"), "doc_id")


# Documents have no phone numbers, so one is added to every text.
_WITH_PHONE = "text || ' tel 1' || (3 + doc_id % 7)::VARCHAR || lpad(doc_id::VARCHAR, 9, '0') || ' x1' || lpad(doc_id::VARCHAR, 11, '3')"


def _with_phone(docs):
    return docs.withColumn(
        "text",
        F.concat(
            F.col("text"),
            F.lit(" tel 1"),
            (3 + F.col("doc_id") % 7).cast("string"),
            F.lpad(F.col("doc_id").cast("string"), 9, "0"),
            F.lit(" x1"),
            F.lpad(F.col("doc_id").cast("string"), 11, "3"),
        ),
    )


@query("clean_text", f"SELECT doc_id, {sql.clean(_WITH_PHONE)} AS text FROM documents")
def clean_text(spark, sf):
    return _with_phone(_docs(spark, sf)).select("doc_id", text.clean_text(F.col("text")).alias("text"))


@query("normalize_whitespace", f"SELECT doc_id, {sql.squeeze('text')} AS text FROM documents")
def normalize_whitespace(spark, sf):
    return _docs(spark, sf).select("doc_id", text.normalize_whitespace(F.col("text")).alias("text"))


@query("mask_email", f"SELECT doc_id, {sql.mask_email('text')} AS text FROM documents")
def mask_email(spark, sf):
    return _docs(spark, sf).select("doc_id", text.mask_email(F.col("text")).alias("text"))


@query("mask_phone", f"SELECT doc_id, {sql.mask_phone(_WITH_PHONE)} AS text FROM documents")
def mask_phone(spark, sf):
    return _with_phone(_docs(spark, sf)).select("doc_id", text.mask_phone(F.col("text")).alias("text"))


_PADDED = "chr(160) || chr(10) || ' ' || text || chr(12288) || chr(9)"


@query("strip_text", f"SELECT doc_id, {sql.strip(_PADDED)} AS text FROM documents")
def strip_text(spark, sf):
    padded = F.concat(F.lit(" \n "), F.col("text"), F.lit("　\t"))
    return _docs(spark, sf).select("doc_id", text.strip_text(padded).alias("text"))


@query("char_count", "SELECT doc_id, length(text)::BIGINT AS char_count FROM documents")
def char_count(spark, sf):
    return _docs(spark, sf).select(
        "doc_id", text.char_count(F.col("text")).cast("bigint").alias("char_count")
    )


@query(
    "content_hash",
    "SELECT min(doc_id) AS first_id, count(*) AS copies FROM documents GROUP BY text",
)
def content_hash(spark, sf):
    """The hash value is engine-specific; its equality classes are compared."""
    hashed = _docs(spark, sf).select("doc_id", hashing.content_hash(F.col("text")).alias("h"))
    return hashed.groupBy("h").agg(
        F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies")
    ).drop("h")


@query("sha256_hash", "SELECT doc_id, sha256(text) AS sha256 FROM documents")
def sha256_hash(spark, sf):
    return _docs(spark, sf).select("doc_id", hashing.sha256_hash(F.col("text")).alias("sha256"))


@query(
    "add_features",
    f"""WITH s AS (SELECT * REPLACE ({sql.strip('text')} AS text) FROM documents)
    SELECT *, length(text)::BIGINT AS char_count, sha256(text) AS sha256 FROM s""",
)
def add_features(spark, sf):
    featured = quality.add_features(_docs(spark, sf))
    return featured.withColumn("char_count", F.col("char_count").cast("bigint"))


@query(
    "quality_features",
    """SELECT *, length(text)::BIGINT AS char_count,
       min(doc_id) OVER (PARTITION BY text) AS first_with_hash FROM documents""",
)
def quality_features(spark, sf):
    """The hash column is shown as the first document that has the same hash."""
    featured = quality.quality_features(_docs(spark, sf))
    first = featured.groupBy("content_hash").agg(
        F.min("doc_id").alias("first_with_hash"), F.count(F.lit(1)).alias("copies")
    )
    return (
        join_groups(featured, stage(first, "hashes"), "content_hash", "copies")
        .drop("content_hash", "copies")
        .withColumn("char_count", F.col("char_count").cast("bigint"))
    )


@query(
    "tokenize",
    f"""SELECT doc_id, unnest(t) AS token, unnest(range(0, len(t))) AS pos
    FROM (SELECT doc_id, {sql.tokens('text')} AS t FROM documents)""",
)
def tokenize(spark, sf):
    return _docs(spark, sf).select(
        "doc_id", F.posexplode(text.tokenize(F.col("text"))).alias("pos", "token")
    ).withColumn("pos", F.col("pos").cast("bigint"))


@query(
    "shingles5",
    f"""WITH s AS (SELECT doc_id, {sql.shingles('t')} AS s
                  FROM (SELECT doc_id, {sql.tokens('text')} AS t FROM documents))
    SELECT doc_id, unnest(s) AS shingle, unnest(range(0, len(s))) AS pos FROM s""",
)
def shingles5(spark, sf):
    runs = text.shingles(text.tokenize(F.col("text")))
    return _docs(spark, sf).select("doc_id", F.posexplode(runs).alias("pos", "shingle")).withColumn(
        "pos", F.col("pos").cast("bigint")
    )


@query(
    "simhash64",
    f"WITH {sql.votes_ctes('documents')} SELECT doc_id, {sql.signed('fp')} AS fingerprint FROM prints",
)
def simhash64(spark, sf):
    """MD5 family, built-ins only."""
    return simhash64_md5(_docs(spark, sf))


@query(
    "simhash64_blake2b",
    f"""WITH RECURSIVE {sql.votes_ctes('documents', family='blake2b')}
    SELECT doc_id, {sql.signed('fp')} AS fingerprint FROM prints""",
)
def simhash64_blake2b(spark, sf):
    """The default family."""
    return _docs(spark, sf).select("doc_id", hashing.simhash64(F.col("text")).alias("fingerprint"))


@query(
    "simhash_votes",
    f"WITH {sql.votes_ctes('documents')} SELECT doc_id, bit::BIGINT AS bit, votes FROM votes",
)
def votes(spark, sf):
    return simhash_votes(_docs(spark, sf)).withColumn("bit", F.col("bit").cast("bigint"))


@query("min_chars_clean", f"SELECT doc_id FROM documents WHERE length({sql.clean('text')}) >= 80")
def min_chars_clean(spark, sf):
    return _docs(spark, sf).where(filters.min_chars_clean(F.col("text"))).select("doc_id")


@query("keep_useful_text", f"SELECT doc_id, text FROM documents WHERE length({sql.strip('text')}) >= 20")
def keep_useful_text(spark, sf):
    return _docs(spark, sf).where(filters.keep_useful_text(F.col("text"))).select("doc_id", "text")


_SPARSE = "CASE WHEN doc_id % 13 <> 0 THEN text END"


@query(
    "valid_record",
    f"SELECT doc_id FROM documents WHERE length({sql.strip(_SPARSE)}) >= 15",
)
def valid_record(spark, sf):
    """Every 13th text is taken as missing."""
    sparse = F.when(F.col("doc_id") % 13 != 0, F.col("text"))
    return _docs(spark, sf).where(filters.valid_record(sparse)).select("doc_id")


@query("predicate_filter", f"SELECT doc_id FROM documents WHERE length({sql.strip('text')}) >= 500")
def predicate_filter(spark, sf):
    return filters.predicate_filter(
        _docs(spark, sf), filters.keep_useful_text, "text", min_chars=500
    ).select("doc_id")


@query(
    "row_filter_map",
    f"""WITH s AS (SELECT doc_id, source, {sql.strip('text')} AS text FROM documents)
    SELECT doc_id, source, text, length(text)::BIGINT AS char_count, sha256(text) AS sha256
    FROM s WHERE length(text) >= 15""",
)
def row_filter_map(spark, sf):
    docs = _docs(spark, sf).select("doc_id", "source", "text")
    mapped = filters.row_filter_map(
        docs, lambda d: filters.valid_record(d["text"]), quality.add_features
    )
    return mapped.withColumn("char_count", F.col("char_count").cast("bigint"))


@query(
    "quality_report",
    """SELECT count(*) AS total_rows, count(DISTINCT text) AS unique_texts,
       greatest(count(*) - count(DISTINCT text), 0) AS duplicate_rows,
       coalesce(round(avg(length(text)), 2), 0.0) AS average_chars,
       coalesce(min(length(text)), 0)::BIGINT AS min_chars,
       coalesce(max(length(text)), 0)::BIGINT AS max_chars FROM documents""",
)
def quality_report(spark, sf):
    report = quality.quality_report(quality.quality_features(table(spark, sf, "documents")))
    return report.withColumns(
        {name: F.col(name).cast("bigint") for name in ("min_chars", "max_chars")}
    )


@query(
    "duplicate_rows",
    "SELECT greatest(count(*) - count(DISTINCT text), 0) AS duplicate_rows FROM documents",
)
def duplicate_rows(spark, sf):
    return quality.quality_report(quality.quality_features(_docs(spark, sf))).select("duplicate_rows")


_BY_SOURCE = """SELECT CASE WHEN doc_id % 17 <> 0 THEN source END AS source, count(*) AS rows
    FROM documents GROUP BY 1"""


@query("rows_by_source", _BY_SOURCE)
def rows_by_source(spark, sf):
    """Every 17th source is taken as missing, which makes a group of its own."""
    source = F.when(F.col("doc_id") % 17 != 0, F.col("source"))
    return quality.rows_by_source(table(spark, sf, "documents").select(source.alias("source")))


@query(
    "sources_by_rows",
    "SELECT source, count(*) AS rows FROM documents GROUP BY source ORDER BY rows DESC, source",
)
def sources_by_rows(spark, sf):
    return quality.sources_by_rows(table(spark, sf, "documents"))


@query(
    "clean_report",
    "SELECT count(*) AS clean_rows, coalesce(round(avg(length(text)), 2), 0.0) AS average_chars FROM documents",
)
def clean_report(spark, sf):
    return quality.clean_report(table(spark, sf, "documents"))


@query(
    "token_total",
    f"SELECT count(*) AS documents, coalesce(sum(len({sql.tokens('text')})), 0)::BIGINT AS tokens FROM documents",
)
def token_total(spark, sf):
    return quality.token_total(_docs(spark, sf))


@query(
    "token_counts",
    f"""SELECT doc_id, token, count(*) AS n
    FROM (SELECT doc_id, unnest({sql.tokens('text')}) AS token FROM documents) GROUP BY ALL""",
)
def token_counts(spark, sf):
    return quality.token_counts(_docs(spark, sf))


@query(
    "cell_defaults",
    """SELECT source, coalesce(round(avg(quality), 2), 0.0) AS average_quality
       FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source""",
)
def cell_defaults(spark, sf):
    """Mean label quality per source; 0 where no document of it has a label."""
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    joined = table(spark, sf, "documents").select("doc_id", "source").join(labels, "doc_id", "left")
    return joined.groupBy("source").agg(
        quality.cell_default(F.round(F.avg("quality"), 2), 0.0).alias("average_quality")
    )


_MARKED = "documents LEFT JOIN labels USING (doc_id)"
_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"]
_RATES = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) AS rows, count(*) - count({c}) AS nulls, "
    f"coalesce((count(*) - count({c})) / nullif(count(*), 0)::DOUBLE, 0.0) AS null_rate FROM {_MARKED}"
    for c in _COLUMNS
)


@query("null_rates", _RATES)
def null_rates(spark, sf):
    """Documents with their labels, which only some have."""
    marked = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return profile.null_rates(marked.select(*_COLUMNS))


@query(
    "language_shares",
    """SELECT lang, count(*) AS rows, count(*) / (SELECT count(*) FROM documents)::DOUBLE AS share
    FROM documents GROUP BY lang""",
)
def language_shares(spark, sf):
    return profile.shares(table(spark, sf, "documents"), "lang")


@query(
    "length_quantiles",
    " UNION ALL ".join(
        f"SELECT {q}::DOUBLE AS quantile, round(quantile_cont(length(text)::DOUBLE, {q}), 6) AS chars FROM documents"
        for q in profile.QUANTILES
    ),
)
def length_quantiles(spark, sf):
    found = profile.length_quantiles(table(spark, sf, "documents"))
    return found.withColumn("chars", F.round("chars", 6))


_GARBLED = r"regexp_replace(t, '[\x{0}-\x{8}\x{b}\x{c}\x{e}-\x{1f}\x{7f}\x{fffd}]', '', 'g')"


@query(
    "record_checks",
    f"""WITH d AS (SELECT doc_id, lang,
        CASE doc_id % 9 WHEN 0 THEN ' ' WHEN 1 THEN chr(65533) || chr(1) || left(text, 8) ELSE text END AS t
      FROM documents),
    c AS (SELECT doc_id, {sql.strip('t')} = '' AS is_empty,
        round((length(t) - length({_GARBLED})) / length(t)::DOUBLE, 9) AS garbled_ratio,
        lang IN ('en', 'de') AS lang_known FROM d)
    SELECT *, NOT is_empty AND garbled_ratio <= 0.1 AND lang_known AS passes FROM c""",
)
def record_checks(spark, sf):
    """Some texts are taken as blank, some as garbled."""
    kind = F.col("doc_id") % 9
    garbled = F.concat(F.lit("\ufffd\x01"), F.left("text", F.lit(8)))
    text_or = F.when(kind == 0, " ").when(kind == 1, garbled).otherwise(F.col("text"))
    docs = _docs(spark, sf).select("doc_id", "lang", text_or.alias("text"))
    checked = profile.record_checks(docs, ["en", "de"])
    return checked.drop("lang", "text").withColumn("garbled_ratio", F.round("garbled_ratio", 9))


@query(
    "annotator_agreement",
    """WITH m AS (SELECT quality AS a, 1 - toxic AS b FROM labels WHERE quality IS NOT NULL AND toxic IS NOT NULL),
    s AS (SELECT count(*) AS items, avg((a = b)::INT) AS agreement, avg(a) * avg(b) + (1 - avg(a)) * (1 - avg(b)) AS e FROM m)
    SELECT items, round(agreement, 9) AS agreement, round((agreement - e) / nullif(1 - e, 0), 9) AS kappa FROM s""",
)
def annotator_agreement(spark, sf):
    """Good quality against not toxic, as two annotators' marks of the same documents."""
    marks = table(spark, sf, "labels").select("quality", (1 - F.col("toxic")).alias("clean"))
    found = profile.agreement(marks, "quality", "clean")
    return found.withColumns({c: F.round(c, 9) for c in ("agreement", "kappa")})
