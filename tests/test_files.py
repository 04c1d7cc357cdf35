import json
import os

import pytest
from pyspark.sql import functions as F

from quern import session
from quern.operators import feedback
from quern.plans import prepare as preparing
from quern.plans import reports
from quern.schemas import PLAIN_DOC, PREFERENCE_TASK, SOURCE_DOC
from quern.sources import jsonl, sinks


def read_lines(path):
    found = []
    for name in sorted(os.listdir(path)):
        if name.startswith("part-"):
            with open(os.path.join(path, name), encoding="utf-8") as file:
                found += file.read().splitlines()
    return found


LONG = "河边的老磨坊每天清晨开工，来信请寄 miller@example.org 谢谢。" * 4


def test_prepare_file_to_file(spark, write, tmp_path):
    rows = [{"id": 0, "text": "面粉"}, {"id": 1, "x": {"y": None}, "text": LONG, "z": [1]}, {"id": 2, "text": LONG}]
    source = write(*[json.dumps(r, ensure_ascii=False) for r in rows])
    stats = preparing.prepare_json_lines(spark, source, f"{tmp_path}/out", f"{tmp_path}/stats", min_chars=20)
    assert list(stats.first()) == [3, 0, 1, 1, 0, 1]
    (line,) = read_lines(f"{tmp_path}/out")
    kept = json.loads(line)
    assert list(kept) == ["id", "x", "text", "z"] and kept["x"] == {"y": None} and kept["z"] == [1]
    assert "<EMAIL>" in kept["text"] and "磨坊" in line
    report = "\n".join(read_lines(f"{tmp_path}/stats"))
    assert json.loads(report)["kept"] == 1 and len(report.splitlines()) == 8


def test_lenient_scan(spark, write):
    source = write(
        '{"text":"one"}', "", "   ", "not json", "[1]", '{"id":"3"}', '{"text":5}', '{"text":null}',
        '{"text":"a"} b', '{"text":"a"},{"text":"b"}', '{"text":"x","text":"last"}', '{"text":{"a":1}}',
    )
    got = sorted((r.seq, r.text) for r in jsonl.lenient_records(spark, source).collect())
    assert [t for _, t in got] == ["one", *[None] * 7, "last", None]
    assert [s for s, _ in got] == [1, 4, 5, 6, 7, 8, 9, 10, 11, 12]


def test_line_numbers_over_files_and_splits(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    for f in range(3):
        (folder / f"f{f}.jsonl").write_text("".join(f'{{"f":{f},"i":{i}}}\n' for i in range(2000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        lines = jsonl.numbered_lines(spark, str(folder)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    place = {r.seq: (json.loads(r.value)["f"], json.loads(r.value)["i"], r.line) for r in lines}
    assert [place[s] for s in range(1, 6001)] == [(f, i, i + 1) for f in range(3) for i in range(2000)]


def test_strict_scan_fails(spark, write):
    assert jsonl.strict_records(spark, write('{"id":"1","text":"a"}', ""), PLAIN_DOC).count() == 1
    with pytest.raises(Exception, match="(?i)malformed|corrupt"):
        jsonl.strict_records(spark, write('{"id":"1"}', "[1", name="bad.jsonl"), PLAIN_DOC).collect()
    with pytest.raises(Exception, match="blank line"):
        jsonl.strict_records(spark, write('{"id":"1"}', " ", '{"id":"2"}', name="b.jsonl"), PLAIN_DOC, "fail").collect()
    numbered = jsonl.strict_records(spark, write('{"id":"a"}', '{"id":"b"}', name="n.jsonl"), PLAIN_DOC, order="at")
    assert sorted((r["at"], r["id"]) for r in numbered.collect()) == [(1, "a"), (2, "b")]


def test_required_fields(spark, write):
    bad = write('{"prompt":"p","response_a":null,"response_b":"b"}', '{"prompt":"p","response_a":"a"}', '{"x":1}')
    names = PREFERENCE_TASK.fieldNames()
    found = sorted((r.line, r.missing) for r in jsonl.field_violations(spark, bad, names).collect())
    assert found == [(2, ["response_b"]), (3, ["prompt", "response_a", "response_b"])]
    with pytest.raises(Exception, match="line 2 lacks fields: response_b"):
        jsonl.required_records(spark, write('{"prompt":"p","response_a":null,"response_b":"b"}', '{"prompt":"p","response_a":"a"}', name="c.jsonl"), PREFERENCE_TASK).collect()
    good = write('{"prompt":"p","response_a":"a","response_b":null}', name="good.jsonl")
    (task,) = reports.preference_dataset(spark, good).collect()
    assert (task.prompt, task.response_a, task.response_b, task.preference) == ("p", "a", None, None)


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(3, "ü"), (1, None), (2, "b")], "i int, t string")
    assert sinks.write_jsonl_counted(df, f"{tmp_path}/j", order="i") == 3
    assert read_lines(f"{tmp_path}/j") == ['{"i":1,"t":null}', '{"i":2,"t":"b"}', '{"i":3,"t":"ü"}']
    assert sinks.write_parquet_counted(df.where("i > 1"), f"{tmp_path}/p") == 2
    sinks.write_split(df, F.col("t") == "b", f"{tmp_path}/s")
    assert [json.loads(x)["i"] for x in read_lines(f"{tmp_path}/s/split=kept")] == [2]
    assert len(read_lines(f"{tmp_path}/s/split=removed")) == 2


def test_replace_output(spark, tmp_path):
    path = f"{tmp_path}/out"
    assert not sinks.is_complete(spark, path)
    for n in (2, 3):
        sinks.replace_output(spark, path, lambda p: sinks.write_jsonl(spark.range(n), p))
        assert sinks.is_complete(spark, path) and len(read_lines(path)) == n

    def fails(p):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        sinks.replace_output(spark, path, fails)
    assert len(read_lines(path)) == 3
    assert sorted(os.listdir(tmp_path)) == ["out"]


def test_three_steps(spark, write, tmp_path):
    a, b = "a text that is long enough to stay", "another text that is long enough"
    raw = write(*[json.dumps({"id": str(i), "k": i, "text": t}) for i, t in enumerate(["no", a, f" {a}", b])])
    report = reports.three_step_clean(spark, raw, f"{tmp_path}/clean", f"{tmp_path}/report").first()
    assert list(report) == [2, round((len(a) + len(b)) / 2, 2)]
    assert [json.loads(x)["k"] for x in read_lines(f"{tmp_path}/clean")] == [1, 3]
    with pytest.raises(Exception):
        reports.three_step_clean(spark, write('{"text":"a"}', "", name="e.jsonl"), f"{tmp_path}/x", f"{tmp_path}/y")


def test_quality_and_filter_jobs(spark, write, tmp_path):
    source = write(
        '{"id":"1","source":"web","text":"the same text here"}', '{"id":"2","source":"web","text":"the same text here"}',
        '{"id":"3","source":"book","text":"short"}', '{"id":"4","text":"no source but long enough"}',
    )
    reports.quality_run(spark, source, f"{tmp_path}/t", f"{tmp_path}/r")
    report = json.loads("\n".join(read_lines(f"{tmp_path}/r")))
    assert report["total_rows"] == 4 and report["duplicate_rows"] == 1
    assert report["rows_by_source_rows"] == 3
    sources = [json.loads(x) for x in read_lines(f"{tmp_path}/r_rows_by_source")]
    assert [(s["source"], s["rows"]) for s in sources] == [("web", 2), (None, 1), ("book", 1)]
    assert reports.filter_map_run(spark, source, f"{tmp_path}/m") == 3
    tokens = reports.filter_split_run(spark, source, f"{tmp_path}/s", min_chars=10).first()
    assert list(tokens) == [3, 4 + 4 + 5]


def test_long_report_parts_have_the_same_shape(spark, tmp_path):
    rows = spark.range(25_000).select(F.col("id").alias("seq"), F.col("id").cast("string").alias("id"))
    for n in (3, 25_000):
        sinks.write_json_report(spark.range(1).select(F.lit(n).alias("n")), f"{tmp_path}/{n}", regressions=(rows.limit(n), "seq"))
        assert json.loads("\n".join(read_lines(f"{tmp_path}/{n}"))) == {"n": n, "regressions_rows": n}
        assert len(read_lines(f"{tmp_path}/{n}_regressions")) == n


def test_jobs_keep_other_keys_and_refuse_broken_lines(spark, write, tmp_path):
    good = '{"id":1,"source":"web","text":"a text that is long enough","extra":{"k":[1,2]}}'
    source = write(good, '{"id":"2","text":"another text long enough","lang":"en"}')
    assert reports.filter_map_run(spark, source, f"{tmp_path}/m") == 2
    rows = sorted(spark.read.parquet(f"{tmp_path}/m").collect(), key=lambda r: r.id)
    assert [(r.id, r.lang, r.extra and r.extra.k) for r in rows] == [("1", None, [1, 2]), ("2", "en", None)]
    for n, bad in enumerate(["not json", good + " b", "{'text':'single'}", good + "," + good]):
        broken = write(good, bad, name=f"bad{n}.jsonl")
        with pytest.raises(Exception):
            reports.filter_map_run(spark, broken, f"{tmp_path}/x{n}")
        with pytest.raises(Exception):
            jsonl.strict_records(spark, broken, SOURCE_DOC).collect()
        tokens = reports.filter_split_run(spark, broken, f"{tmp_path}/y{n}").first()
        assert list(tokens) == [1, 6]
        assert json.loads(read_lines(f"{tmp_path}/y{n}/split=kept")[0]) == json.loads(good)
        assert read_lines(f"{tmp_path}/y{n}/split=malformed") == [bad]
    assert list(reports.filter_split_run(spark, write('{"text":"no"}', name="r.jsonl"), f"{tmp_path}/z").first()) == [0, 0]
    assert list(reports.filter_split_run(spark, write("", name="e.jsonl"), f"{tmp_path}/w").first()) == [0, 0]


def test_eval_job(spark, write, tmp_path):
    source = write(
        '{"id":"1","expected":"磨坊","baseline":"河边","candidate":"磨坊","human_preference":"candidate"}',
        '{"id":7,"expected":"a b c","baseline":"a b","candidate":"z","human_preference":"unsure"}',
        '{"expected":"none","baseline":"none","candidate":"x"}',
        '{"id":"4","expected":"None","candidate":null,"human_preference":"tie"}',
        '{"id":"5","human_preference":"tie"}',
        '{"id":"6","expected":1.5,"candidate":true,"human_preference":3}',
    )
    result = reports.eval_regression(spark, source, f"{tmp_path}/r")
    report = json.loads("\n".join(read_lines(f"{tmp_path}/r")))
    assert report["cases"] == 6
    assert report["candidate_exact_match"] == pytest.approx(3 / 6)
    assert report["human_preferences"] == {"candidate": 1, "tie": 2}
    assert report["regressions_rows"] == 2
    assert [json.loads(x)["id"] for x in read_lines(f"{tmp_path}/r_regressions")] == ["7", "unknown"]
    scores = {r.seq: r for r in result.scores.collect()}
    assert scores[1].candidate_f1 == 1.0 and scores[1].baseline_f1 == 0.0
    assert scores[2].baseline_f1 == pytest.approx(0.8)
    assert scores[5].exact_match and scores[5].candidate_f1 == 0.0
    shown = {r.seq: (r.expected, r.candidate, r.baseline) for r in reports.eval_cases(spark, source).collect()}
    assert shown[6] == ("1.5", "True", "") and shown[4][1] == "None"
    empty = reports.evaluate(reports.eval_cases(spark, write("", name="none.jsonl"))).summary.first()
    assert list(empty) == [0, 0.0, 0.0, 0.0]


def test_score_job(spark, write, tmp_path):
    source = write(
        '{"id":"q1","question":"?","response":"a b","reference":"a b"}',
        '{"id":"q2","question":"?","response":"a","reference":"a b c"}',
    )
    assert list(reports.score_eval(spark, source, f"{tmp_path}/r", "m").first()) == ["m", 0.75, 2]
    report = json.loads("\n".join(read_lines(f"{tmp_path}/r")))
    assert report == {"model": "m", "average_score": 0.75, "cases_rows": 2}
    cases = [json.loads(x) for x in read_lines(f"{tmp_path}/r_cases")]
    assert cases == [{"seq": 1, "id": "q1", "score": 1.0}, {"seq": 2, "id": "q2", "score": 0.5}]
    fixed = reports.score_eval(spark, source, f"{tmp_path}/s", "n", lambda a, b: F.lit(0.25)).first()
    assert list(fixed) == ["n", 0.25, 2]


STAMP = "2026-01-01T00:00:00+00:00"


def test_feedback(spark, tmp_path):
    entries = spark.createDataFrame(
        [(1, "p", "r", 5, None), (2, "p", "r", 0, "t"), (3, "p", None, 3, "t"), (4, "q", "s", 1, "t"), (5, "p", "r", None, "")],
        "n int, prompt string, response string, rating int, tags string",
    )
    reasons = [r.reason for r in sorted(feedback.feedback_checks(entries).collect())]
    assert reasons == [None, "rating out of range", "response is null", None, "rating is null"]
    for _ in range(2):
        exported = reports.feedback_roundtrip(entries, f"{tmp_path}/t", f"{tmp_path}/e", ["n"], F.lit(STAMP))
    assert exported == 4
    refused = spark.read.parquet(f"{tmp_path}/t_rejected").select("rating", "reason").collect()
    assert sorted(map(str, (r.reason for r in refused))) == sorted(2 * ["rating out of range", "response is null", "rating is null"])
    assert feedback.append_feedback(entries, f"{tmp_path}/u", ["n"]) == (2, 3)
    rows = [json.loads(x) for x in read_lines(f"{tmp_path}/e")]
    assert [(r["id"], r["prompt"], r["rating"], r["tags"]) for r in rows] == [
        (1, "p", 5, ""), (2, "q", 1, "t"), (3, "p", 5, ""), (4, "q", 1, "t"),
    ]
    assert all(r["created_at"] == STAMP and r["notes"] == "" for r in rows)
    now = spark.range(1).select(feedback.utc_now()).first()[0]
    assert now.endswith("+00:00") and len(now) == 32


def test_valid_answer(spark):
    answers = spark.createDataFrame(
        [("A", 5), ("平局", 1), ("C", 3), ("B", 6), (None, 3)], "preference string, score int"
    )
    assert [r[0] for r in answers.select(feedback.valid_answer()).collect()] == [True, True, False, False, False]


def test_scratch_is_dropped(spark):
    staged = session.stage(spark.range(3), "kept")
    folder = session.scratch_path(spark, "x").rsplit("/", 2)[0]
    assert staged.count() == 3 and session.exists(spark, folder)
    session.drop_scratch(spark)
    assert not session.exists(spark, folder)
