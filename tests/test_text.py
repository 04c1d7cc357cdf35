import random
import re
from collections import Counter
from hashlib import blake2b, md5

import pytest
from pyspark.sql import functions as F

from quern.functions import hashing, text
from quern.operators import filters, quality
from quern.operators.votes import simhash64_md5


def column(spark, values, expression):
    df = spark.createDataFrame(list(enumerate(values)), "i int, t string")
    return [r[1] for r in df.select("i", expression(F.col("t"))).orderBy("i").collect()]


@pytest.mark.parametrize(
    "raw, clean",
    [
        (" a\t\tb\n", "a b"),
        ("a 　b\u001cc d", "a b c d"),
        ("a​b", "a​b"),
        ("联系邮箱demo@example.com。", "<EMAIL>。"),
        ("a@b.com中文", "a@b.com中文"),
        ("call 13812345678 or 13912345678.", "call <PHONE> or <PHONE>."),
        ("113812345678 138123456789", "113812345678 138123456789"),
        ("电话13812345678", "电话<PHONE>"),
        ("x.y+z@mail.example.org, 12812345678", "<EMAIL>, 12812345678"),
        ("", ""),
    ],
)
def test_clean_text(spark, raw, clean):
    assert column(spark, [raw], text.clean_text) == [clean]


def test_whitespace_set_is_that_of_python(spark):
    spaces = [chr(c) for c in range(1, 0x10000) if chr(c).isspace() and not 0xD800 <= c < 0xE000]
    assert sorted(text.WHITESPACE_CHARS) == sorted(spaces)
    assert column(spark, [s + "a" + s + s + "b" + s for s in spaces], text.normalize_whitespace) == [
        "a b"
    ] * len(spaces)
    assert column(spark, [s + "a" + s for s in spaces], text.strip_text) == ["a"] * len(spaces)


def test_tokens_and_shingles(spark):
    assert column(spark, ["Ab_1 é中文x"], text.tokenize) == [["ab_1", "中", "文", "x"]]
    runs = column(
        spark, ["", "a b", "a b c d e", "a b c d e f"], lambda t: text.shingles(text.tokenize(t))
    )
    assert runs == [[], ["a b"], ["a b c d e"], ["a b c d e", "b c d e f"]]


# Fingerprints computed independently, unsigned.
GOLDEN = [
    ("hello world", 9765549648086544720, 6824707963431612112),
    ("", 0, 0),
    ("a b c d e f g", 4807664412385724768, 629930739431041117),
]


def test_simhash_goldens(spark):
    texts = [g[0] for g in GOLDEN]
    for family, at in (("blake2b", 1), ("md5", 2)):
        got = column(spark, texts, lambda t: hashing.simhash64(t, family))
        assert [value % (1 << 64) for value in got] == [g[at] for g in GOLDEN]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    built_in = {r.doc_id: r.fingerprint % (1 << 64) for r in simhash64_md5(docs).collect()}
    assert built_in == {i: g[2] for i, g in enumerate(GOLDEN)}


def test_simhash_forms_agree_and_nulls_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    long_text = docs.agg(F.lit(-1).alias("doc_id"), F.array_join(F.collect_list("text"), " ").alias("text"))
    cjk = spark.createDataFrame([(-2, "河边的老磨坊 grinds 面粉 all day")], "doc_id int, text string")
    docs = docs.unionByName(long_text).unionByName(cjk)
    one = docs.select("doc_id", hashing.simhash64(F.col("text"), "md5").alias("fp"))
    assert one.exceptAll(simhash64_md5(docs)).isEmpty()
    assert column(spark, [None], hashing.simhash64) == [None]


def test_length_filters(spark):
    assert column(spark, ["  short ", "long enough text"], lambda t: filters.keep_useful_text(t, 10)) == [
        False,
        True,
    ]
    assert column(spark, [None, "tiny", "x" * 15], filters.valid_record) == [False, False, True]
    assert column(spark, ["a@bb.cc " * 3], lambda t: filters.min_chars_clean(t, 23)) == [True]


def test_features_and_reports(spark):
    docs = spark.createDataFrame(
        [("1", "web", " same text "), ("2", "web", "same text"), ("3", None, "other"), ("4", "book", None)],
        "id string, source string, text string",
    )
    row = quality.add_features(docs.where("id = '1'")).first()
    assert (row.text, row.char_count, len(row.sha256), row.source) == ("same text", 9, 64, "web")
    featured = quality.quality_features(docs.union(docs.where("id = '2'")))
    assert quality.quality_report(featured).first().asDict() == {
        "total_rows": 5,
        "unique_texts": 4,
        "duplicate_rows": 1,
        "average_chars": 8.5,
        "min_chars": 5,
        "max_chars": 11,
    }
    assert [tuple(r) for r in quality.sources_by_rows(docs).collect()] == [("web", 2), (None, 1), ("book", 1)]
    empty = docs.limit(0)
    assert list(quality.quality_report(quality.quality_features(empty)).first()) == [0, 0, 0, 0.0, 0, 0]
    assert list(quality.clean_report(empty).first()) == [0, 0.0]
    assert list(quality.token_total(empty).first()) == [0, 0]


def test_duplicate_rows(spark):
    numbers = spark.createDataFrame([(10, 7), (0, 0), (3, 5)], "a long, b long")
    got = numbers.select(quality.duplicate_rows(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in got] == [3, 0, 0]


def _plain_fingerprint(value, digest):
    words = re.findall(text.TOKEN_PATTERN, value.lower())
    runs = [" ".join(words[i : i + 5]).encode() for i in range(max(1, len(words) - 4))] if words else []
    found = [int.from_bytes(digest(run), "big") for run in runs]
    votes = [sum(1 if h >> bit & 1 else -1 for h in found) for bit in range(64)]
    fp = sum(1 << bit for bit in range(64) if runs and votes[bit] >= 0)
    return fp - (1 << 64) if fp >> 63 else fp


@pytest.mark.parametrize("family", ["md5", "blake2b"])
def test_texts_share_a_buffer(monkeypatch, family):
    """Borders of tokens, blocks and texts; MD5 goes message by message only where a block is too short."""
    rng = random.Random(5)
    chars = "aZ_9 \n.,-éİKΣ一丁鿿鿾䶿ꀀ日😀"
    texts = ["", " . ", "a", "一", "鿿㶿一a一", "x" * 55, "x" * 56, "w" * 300 + " b c d e f", "İ K"]
    texts += ["".join(rng.choices(chars, k=rng.randint(0, 200))) for _ in range(300)]
    texts += [" ".join(rng.choices(["word", "ab", "longerwords"], k=2000))]
    digest = {"md5": lambda b: md5(b).digest()[:8], "blake2b": lambda b: blake2b(b, digest_size=8).digest()}[family]
    expected = [_plain_fingerprint(t, digest) for t in texts]
    calls = []
    monkeypatch.setattr(hashing, "md5", lambda b: calls.append(len(b)) or md5(b))
    monkeypatch.setattr(hashing, "_VOTE_CHUNK", 512)
    assert hashing._fingerprints(texts, hashing.FAMILIES[family]).tolist() == expected
    assert all(size > 55 for size in calls)
    assert hashing._fingerprints(["", ""], hashing.FAMILIES[family]).tolist() == [0, 0]


def test_whitespace_runs_by_brute_force(spark):
    rng = random.Random(6)
    values = ["".join(rng.choices(" \t 　\n!~aé\x7f", k=rng.randint(0, 12))) for _ in range(500)]
    assert column(spark, values, text.normalize_whitespace) == [" ".join(v.split()) for v in values]


def test_single_spaces_are_left_alone():
    """Prose has a space after each word; nothing is replaced there."""
    assert re.search(text._TO_SQUEEZE.replace("[[^!-~]&&", "[").replace("]]+", "]+"), "one two, three (four)") is None


def test_token_counts_by_key(spark):
    rng = random.Random(7)
    rows = [(i, " ".join(rng.choices(["a", "B", "b", "一", "c_1", "."], k=rng.randint(0, 9)))) for i in range(40)]
    rows += [(3, "a a"), (3, "x"), (5, None), (None, "a b"), (None, "b"), (99, None), (98, "")]

    def expected(given):
        bags = {}
        for key, value in given:
            bags.setdefault(key, Counter()).update(re.findall(text.TOKEN_PATTERN, (value or "").lower()))
        return sorted(((k, t, n) for k, bag in bags.items() for t, n in bag.items()), key=str)

    for given in (rows, rows[:40], rows[-2:]):
        docs = spark.createDataFrame(given, "doc_id long, text string")
        counted = quality.token_counts(docs)
        assert sorted(map(tuple, counted.collect()), key=str) == expected(given)
    assert counted.columns == ["doc_id", "token", "n"]
    # Where a key is in one row only, nothing is shuffled.
    plan = quality.token_counts(spark.createDataFrame(rows[:40], "doc_id long, text string"))
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()
