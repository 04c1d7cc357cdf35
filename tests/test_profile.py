"""Corpus profile on small tables with nulls, blanks and no rows; the SQL digest against the library's."""

from hashlib import blake2b

import duckdb
import pytest

from quern.catalog import blake2b as digest
from quern.operators import profile
from quern.operators.evals import preference_pairs
from quern.operators.votes import simhash64_md5, simhash_votes


@pytest.mark.parametrize("size", [0, 1, 8, 127, 128, 129, 256, 1000])
def test_sql_digest(size):
    texts = ["a" * size, "ü" * (size // 2) + "z"]
    db = duckdb.connect()
    db.execute("CREATE TABLE t(s VARCHAR)")
    db.executemany("INSERT INTO t VALUES (?)", [[t] for t in texts])
    got = dict(db.execute(f"WITH RECURSIVE {digest.ctes('t')} SELECT s, h FROM blake").fetchall())
    assert got == {t: int.from_bytes(blake2b(t.encode(), digest_size=8).digest(), "big") for t in texts}


def test_null_rates(spark):
    rows = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "a long, `b.c` string")
    got = {r[0]: tuple(r)[1:] for r in profile.null_rates(rows).collect()}
    assert got == {"a": (3, 1, 1 / 3), "b.c": (3, 2, 2 / 3)}
    empty = profile.null_rates(rows.limit(0)).collect()
    assert [tuple(r) for r in empty] == [("a", 0, 0, 0.0), ("b.c", 0, 0, 0.0)]


def test_shares_and_quantiles(spark):
    docs = spark.createDataFrame([("en", "abcd"), ("en", "ab"), (None, None), ("de", "")], "lang string, text string")
    assert {r.lang: (r.rows, r.share) for r in profile.shares(docs, "lang").collect()} == {
        "en": (2, 0.5), None: (1, 0.25), "de": (1, 0.25),
    }
    found = {r.quantile: r.chars for r in profile.length_quantiles(docs).collect()}
    assert (found[0.0], found[0.5], found[1.0]) == (0.0, 2.0, 4.0)
    assert profile.shares(docs.limit(0), "lang").count() == 0
    assert profile.length_quantiles(docs.limit(0)).count() == 0


def test_record_checks(spark):
    rows = [("en", "plain words"), ("en", " \n"), ("en", None), ("xx", "plain"), (None, "plain"), ("en", "a�\x00b")]
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = [(r.is_empty, r.garbled_ratio, r.lang_known, r.passes) for r in profile.record_checks(docs, ["en"]).collect()]
    assert got == [
        (False, 0.0, True, True),
        (True, 0.0, True, False),
        (True, 0.0, True, False),
        (False, 0.0, False, False),
        (False, 0.0, False, False),
        (False, 0.5, True, False),
    ]


def test_agreement(spark):
    marks = [(1, 1)] * 4 + [(0, 0)] * 3 + [(1, 0)] * 2 + [(0, 1)] + [(None, 1)]
    got = profile.agreement(spark.createDataFrame(marks, "a int, b int"), "a", "b").first()
    assert (got.items, got.agreement) == (10, 0.7) and abs(got.kappa - 0.4) < 1e-12
    one = profile.agreement(spark.createDataFrame([(1, 1)], "a int, b int"), "a", "b").first()
    assert (one.items, one.agreement, one.kappa) == (1, 1.0, None)
    none = profile.agreement(spark.createDataFrame([], "a int, b int"), "a", "b").first()
    assert (none.items, none.agreement, none.kappa) == (0, None, None)


def test_preference_pairs(spark):
    schema = "seq long, prompt string, candidate string, baseline string, human_preference string"
    rows = [(1, "p", "c", "b", "candidate"), (2, "p", "c", "b", "baseline"), (3, "p", "c", "b", "tie"),
            (4, "p", "c", "c", "candidate"), (5, "p", None, "b", "candidate"), (6, "p", "c", "b", None)]
    got = {r.seq: (r.chosen, r.rejected) for r in preference_pairs(spark.createDataFrame(rows, schema)).collect()}
    assert got == {1: ("c", "b"), 2: ("b", "c")}


def test_texts_without_tokens_keep_a_fingerprint_and_have_no_votes(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "?!"), (4, "word")], "doc_id long, text string")
    prints = {r.doc_id: r.fingerprint for r in simhash64_md5(docs).collect()}
    assert [prints[i] for i in (1, 2, 3)] == [0, 0, 0] and prints[4] != 0
    assert {r.doc_id for r in simhash_votes(docs).select("doc_id").distinct().collect()} == {4}
