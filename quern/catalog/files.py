"""Sources, sinks and file-to-file jobs: the tables written out and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.catalog import dedup, evals, query, sql, table
from quern.operators import feedback
from quern.operators.filters import keep_useful_text
from quern.plans import prepare as preparing
from quern.plans import reports
from quern.session import scratch_path
from quern.sources import jsonl, sinks

DOC = "doc_id bigint, source string, text string"
DOC_SQL = "SELECT doc_id, source, text FROM documents"


def _schema(spark, ddl):
    return spark.createDataFrame([], ddl).schema


def _docs(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "source", "text")


def _written(spark, sf):
    """Documents as JSON Lines in the scratch area; the path."""
    path = scratch_path(spark, "docs.jsonl")
    sinks.write_jsonl(_docs(spark, sf), path, order="doc_id")
    return path


def _spoilt(spark, sf):
    """Documents as JSON Lines with a malformed line after many of them."""
    path = scratch_path(spark, "spoilt.jsonl")
    bad = ["not json", "[1]", '{"id":"3"}', "   ", '{"text":5}', '{"text":null}', '{"text":"a"} b']
    extra = F.get(F.array(*[F.lit(b) for b in bad]), (F.col("doc_id") % 10).cast("int"))
    good = F.to_json(F.struct("doc_id", "source", "text"))
    rows = _docs(spark, sf).select("doc_id", good.alias("good"), extra.alias("bad"))
    lines = rows.select("doc_id", F.explode(F.array_compact(F.array("good", "bad"))).alias("value"))
    sinks.write_json_lines(lines, path, "doc_id")
    return path


@query(
    "jsonl_lenient_scan",
    """SELECT doc_id, text FROM documents
    UNION ALL SELECT NULL, NULL FROM documents WHERE doc_id % 10 IN (0, 1, 2, 4, 5, 6)""",
)
def jsonl_lenient_scan(spark, sf):
    """Valid records, and a row of nulls per invalid line; blank lines are not rows."""
    records = jsonl.lenient_records(spark, _spoilt(spark, sf))
    doc_id = F.try_variant_get(F.col("fields")["doc_id"], "$", "bigint")
    return records.select(doc_id.alias("doc_id"), "text")


@query(
    "malformed_filter",
    "SELECT count(*) AS invalid FROM documents WHERE doc_id % 10 IN (0, 1, 2, 4, 5, 6)",
)
def malformed_filter(spark, sf):
    return jsonl.malformed_records(spark, _spoilt(spark, sf)).agg(F.count(F.lit(1)).alias("invalid"))


@query("jsonl_strict_scan", DOC_SQL)
def jsonl_strict_scan(spark, sf):
    return jsonl.strict_records(spark, _written(spark, sf), _schema(spark, DOC))


@query("jsonl_dataset_scan", DOC_SQL)
def jsonl_dataset_scan(spark, sf):
    return jsonl.dataset_records(spark, _written(spark, sf), _schema(spark, DOC))


@query("input_order", "SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS seq FROM documents")
def input_order(spark, sf):
    """Line numbers of an ordered output follow the order column."""
    lines = jsonl.numbered_lines(spark, _written(spark, sf))
    return lines.select(F.get_json_object("value", "$.doc_id").cast("bigint").alias("doc_id"), "seq")


@query(
    "required_fields_scan",
    f"""WITH {evals.CASES} SELECT seq,
    array_to_string(list_filter(['prompt', 'response_a', 'response_b'], lambda f:
      (f = 'response_a' AND expected IS NULL) OR (f = 'response_b' AND candidate IS NULL)), ',') AS missing
    FROM cases WHERE expected IS NULL OR candidate IS NULL""",
)
def required_fields_scan(spark, sf):
    """Records written without their null fields; those that lack a required key."""
    path = scratch_path(spark, "tasks.jsonl")
    evals.conversation_cases(spark, sf).select(
        "seq", "prompt", F.col("expected").alias("response_a"), F.col("candidate").alias("response_b")
    ).write.json(path)
    bad = jsonl.field_violations(spark, path, ["prompt", "response_a", "response_b"])
    return bad.select(
        F.get_json_object("value", "$.seq").cast("bigint").alias("seq"),
        F.array_join("missing", ",").alias("missing"),
    )


@query("parquet_scan", "SELECT source, count(*) AS rows, avg(n_chars) AS mean_chars FROM documents GROUP BY source")
def parquet_scan(spark, sf):
    return spark.sql(
        "SELECT source, count(*) AS rows, avg(n_chars) AS mean_chars FROM {docs} GROUP BY source",
        docs=table(spark, sf, "documents"),
    )


@query("jsonl_sink", "SELECT doc_id, CASE WHEN doc_id % 3 <> 0 THEN source END AS source, text FROM documents")
def jsonl_sink(spark, sf):
    """Null values are written as nulls and come back as nulls."""
    path = scratch_path(spark, "sink.jsonl")
    sparse = F.when(F.col("doc_id") % 3 != 0, F.col("source"))
    sinks.write_jsonl(_docs(spark, sf).withColumn("source", sparse), path)
    return spark.read.schema(DOC).json(path)


@query(
    "split_sink",
    f"""SELECT doc_id, text, CASE WHEN length({sql.strip('text')}) >= 200 THEN 'kept' ELSE 'removed' END
    AS split FROM documents""",
)
def split_sink(spark, sf):
    path = scratch_path(spark, "split")
    sinks.write_split(_docs(spark, sf), keep_useful_text(F.col("text"), 200), path)
    return spark.read.schema(DOC + ", split string").json(path).select("doc_id", "text", "split")


@query("parquet_sink", DOC_SQL)
def parquet_sink(spark, sf):
    path = scratch_path(spark, "table")
    sinks.write_parquet_counted(_docs(spark, sf), path)
    return spark.read.schema(DOC).parquet(path)


@query("output_row_count", "SELECT count(*) AS rows FROM documents")
def output_row_count(spark, sf):
    """The count taken while writing, beside no second pass over the output."""
    path = scratch_path(spark, "table")
    written = sinks.write_parquet_counted(_docs(spark, sf), path)
    return spark.range(1).select(F.lit(written).cast("bigint").alias("rows"))


@query("atomic_overwrite_sink", DOC_SQL)
def atomic_overwrite_sink(spark, sf):
    """Written twice; the second run replaces the first and gives the same output."""
    path = scratch_path(spark, "replaced")
    docs = _docs(spark, sf)
    for _ in range(2):
        sinks.replace_output(spark, path, lambda fresh: sinks.write_jsonl(docs, fresh))
    return spark.read.schema(DOC).json(path)


@query(
    "json_report_sink",
    "SELECT count(*) AS clean_rows, coalesce(round(avg(length(text)), 2), 0.0) AS average_chars FROM documents",
)
def json_report_sink(spark, sf):
    from quern.operators.quality import clean_report

    path = scratch_path(spark, "report")
    sinks.write_json_report(clean_report(_docs(spark, sf)), path)
    return spark.read.schema("clean_rows bigint, average_chars double").option("multiLine", "true").json(path)


def _stored(spark, sf):
    path = scratch_path(spark, "feedback")
    feedback.append_feedback(
        evals.feedback_entries(spark, sf), path, ["conv_id", "turn"], F.lit(evals.STAMP)
    )
    return path


@query("feedback_append", f"{evals.STORED} SELECT * FROM stored")
def feedback_append(spark, sf):
    return feedback.read_feedback(spark, _stored(spark, sf))


@query("feedback_scan", f"{evals.STORED} SELECT * FROM stored ORDER BY id")
def feedback_scan(spark, sf):
    return feedback.read_feedback(spark, _stored(spark, sf)).orderBy("id")


@query("feedback_export", f"{evals.STORED} SELECT * FROM stored")
def feedback_export(spark, sf):
    path = scratch_path(spark, "export")
    sinks.write_jsonl_counted(feedback.read_feedback(spark, _stored(spark, sf)), path, "id")
    return spark.read.schema(feedback.FEEDBACK).json(path)


@query(
    "feedback_roundtrip",
    f"{evals.STORED} SELECT count(*) AS rows, max(id) AS last_id, sum(rating)::BIGINT AS ratings FROM stored",
)
def feedback_roundtrip(spark, sf):
    path = scratch_path(spark, "roundtrip")
    entries = evals.feedback_entries(spark, sf)
    rows = reports.feedback_roundtrip(
        entries, f"{path}/table", f"{path}/export", ["conv_id", "turn"], F.lit(evals.STAMP)
    )
    back = spark.read.schema(feedback.FEEDBACK).json(f"{path}/export")
    return back.agg(
        F.lit(rows).cast("bigint").alias("rows"),
        F.max("id").alias("last_id"),
        F.sum("rating").alias("ratings"),
    )


@query(
    "prepare_json_lines",
    f"""{dedup._OUTCOMES} SELECT c.doc_id, d.source, c.text
    FROM cleaned c JOIN outcomes o USING (doc_id) JOIN documents d USING (doc_id) WHERE o.status = 'kept'""",
)
def prepare_json_lines(spark, sf):
    """The preparation job from file to file, over lines with malformed ones between."""
    path = scratch_path(spark, "prepared")
    preparing.prepare_json_lines(
        spark, _spoilt(spark, sf), f"{path}/clean", f"{path}/stats", family="md5"
    )
    return spark.read.schema(DOC).json(f"{path}/clean")


@query(
    "quality_run",
    """SELECT count(*) AS total_rows, count(DISTINCT text) AS unique_texts,
    greatest(count(*) - count(DISTINCT text), 0) AS duplicate_rows,
    coalesce(round(avg(length(text)), 2), 0.0) AS average_chars,
    coalesce(min(length(text)), 0)::BIGINT AS min_chars, coalesce(max(length(text)), 0)::BIGINT AS max_chars
    FROM documents""",
)
def quality_run(spark, sf):
    path = scratch_path(spark, "quality")
    reports.quality_run(
        spark, _written(spark, sf), f"{path}/table", f"{path}/report", _schema(spark, DOC)
    )
    report = (
        "total_rows bigint, unique_texts bigint, duplicate_rows bigint, average_chars double, "
        "min_chars bigint, max_chars bigint"
    )
    return spark.read.schema(report).option("multiLine", "true").json(f"{path}/report")


@query(
    "filter_map_run",
    f"""WITH s AS (SELECT doc_id, source, {sql.strip('text')} AS text FROM documents)
    SELECT doc_id, source, text, length(text)::BIGINT AS char_count, sha256(text) AS sha256
    FROM s WHERE length(text) >= 15""",
)
def filter_map_run(spark, sf):
    path = scratch_path(spark, "featured")
    reports.filter_map_run(spark, _written(spark, sf), path, _schema(spark, DOC))
    return spark.read.parquet(path).withColumn("char_count", F.col("char_count").cast("bigint"))


@query(
    "filter_split_run",
    f"""SELECT count(*) AS documents, coalesce(sum(len({sql.tokens('text')})), 0)::BIGINT AS tokens
    FROM documents WHERE length({sql.strip('text')}) >= 20""",
)
def filter_split_run(spark, sf):
    path = scratch_path(spark, "split")
    return reports.filter_split_run(spark, _written(spark, sf), path)


@query(
    "three_step_clean",
    f"""WITH s AS (SELECT DISTINCT {sql.strip('text')} AS text FROM documents)
    SELECT count(*) AS clean_rows, coalesce(round(avg(length(text)), 2), 0.0) AS average_chars
    FROM s WHERE length(text) >= 15""",
)
def three_step_clean(spark, sf):
    path = scratch_path(spark, "steps")
    return reports.three_step_clean(spark, _written(spark, sf), f"{path}/clean", f"{path}/report")


def _case_file(spark, sf):
    """Cases as JSON Lines; null fields are left out, so they count as absent."""
    path = scratch_path(spark, "cases.jsonl")
    cases = evals.conversation_cases(spark, sf).repartitionByRange("seq").sortWithinPartitions("seq")
    cases.drop("seq").write.json(path)
    return path


@query(
    "eval_regression",
    f"""{evals.SCORES}, numbered AS (
      SELECT *, row_number() OVER (ORDER BY seq) AS line FROM scores)
    SELECT line AS seq, id, exact_match, human_preference, round(candidate_f1, {evals.PLACES}) AS candidate_f1,
      round(baseline_f1, {evals.PLACES}) AS baseline_f1, regressed FROM numbered""",
)
def eval_regression(spark, sf):
    path = scratch_path(spark, "report")
    scores = reports.eval_regression(spark, _case_file(spark, sf), path).scores
    return evals._rounded(scores, "candidate_f1", "baseline_f1")


@query(
    "score_eval",
    f"""{evals.SCORES} SELECT 'token-overlap' AS model, coalesce(round(avg(f1), 4), 0.0) AS average_score,
    count(*) AS n_cases FROM candidate_f1""",
)
def score_eval(spark, sf):
    path = scratch_path(spark, "scored")
    evals.conversation_cases(spark, sf).select(
        "id",
        F.col("prompt").alias("question"),
        F.col("candidate").alias("response"),
        F.col("expected").alias("reference"),
    ).write.json(f"{path}/cases")
    return reports.score_eval(spark, f"{path}/cases", f"{path}/report", "token-overlap")


@query(
    "preference_dataset",
    f"""WITH {evals.CASES} SELECT prompt, expected AS response_a, candidate AS response_b,
    NULL::VARCHAR AS preference, NULL::INTEGER AS score, NULL::VARCHAR AS reason FROM cases""",
)
def preference_dataset(spark, sf):
    """Null values are written out here: their keys are present, so they pass."""
    path = scratch_path(spark, "tasks.jsonl")
    records = evals.conversation_cases(spark, sf).select(
        "prompt", F.col("expected").alias("response_a"), F.col("candidate").alias("response_b")
    )
    sinks.write_jsonl(records, path)
    return reports.preference_dataset(spark, path)
