"""Sensitive data and repeated text on small tables: checks by plain Python, nulls, blanks, ties, no rows."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quern.functions import sensitive as rules
from quern.operators import repetition, sensitive

SECRET = "tK9xQ2mZ7pLw4RvB8nYc"
CARD, ACCOUNT = "4539 1488 0343 6467", "GB82 WEST 1234 5698 7654 32"


def _docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_luhn_iban_entropy(spark):
    rng = random.Random(3)
    numbers = ["".join(rng.choices("0123456789", k=rng.randint(13, 19))) for _ in range(300)]

    def luhn(number):
        twice = [2 * int(d) - 9 * (int(d) > 4) if i % 2 else int(d) for i, d in enumerate(reversed(number))]
        return sum(twice) % 10 == 0

    accounts = [f"DE{rng.randint(0, 99):02d}{rng.randint(0, 10**18 - 1):018d}" for _ in range(300)]
    accounts += [ACCOUNT.replace(" ", ""), "XX82WEST12345698765432", "GB82WEST1234569876543", ""]

    def iban(a):
        whole = len(a) > 4 and len(a) == rules.IBAN_LENGTHS.get(a[:2])
        return whole and int("".join(str(int(c, 36)) for c in a[4:] + a[:4])) % 97 == 1

    def bits(token):
        return sum(-n / len(token) * math.log2(n / len(token)) for n in Counter(token).values())

    rows = spark.createDataFrame([(x,) for x in numbers], "x string").select("x", rules.luhn(F.col("x")))
    assert all(ok == luhn(x) for x, ok in rows.collect())
    rows = spark.createDataFrame([(x,) for x in accounts], "x string").select("x", rules.iban(F.col("x")))
    assert all(ok == iban(x) for x, ok in rows.collect()) and sum(map(iban, accounts)) > 1
    rows = spark.createDataFrame([(x,) for x in [*numbers, SECRET, "aaaa"]], "x string")
    assert all(abs(e - bits(x)) < 1e-8 for x, e in rows.select("x", rules.entropy(F.col("x"))).collect())


@pytest.mark.parametrize(
    "text, masked",
    [
        ("write to a.b+c@mail.example.com.", "write to <EMAIL>."),
        (f"card {CARD}, again {CARD.replace(' ', '-')}", "card <CARD>, again <CARD>"),
        ("card 4539 1488 0343 6468", None),
        ("3782 822463 10005", "<CARD>"),
        (f"pay {ACCOUNT} IS due", "pay <IBAN> IS due"),
        ("pay GB83 WEST 1234 5698 7654 32", None),
        ("host 10.0.0.255 and 10.0.0.256 and 1.2.3.4.5", "host <IP> and 10.0.0.256 and 1.2.3.4.5"),
        ("call +1 (310) 555-4510 now", "call <PHONE> now"),
        (f"token={SECRET}", None),  # an equals sign is a character of keys, so the run is longer than the key
        (f'key "{SECRET}"', 'key "<SECRET>"'),
        ("1eb9c654e721b4f812088970e66a6345cee33dd6", "<SECRET>"),
        ("antidisestablishmentarianism 2024-01-01", None),
        (f"{CARD}{ACCOUNT}", f"{CARD[:-4]}6467{ACCOUNT}"),
        ("", ""),
        (None, None),
    ],
)
def test_masked(spark, text, masked):
    got = sensitive.mask_sensitive(_docs(spark, [text])).first()
    if text and text.startswith("token="):
        assert got.n_secret == 1 and got.text == "<SECRET>"
    elif text and text.startswith(CARD + "G"):
        assert "<IBAN>" in got.text or "<CARD>" in got.text
    else:
        assert got.text == (text if masked is None else masked)


def test_keep_drop_totals(spark):
    texts = [f"{SECRET} a@b.co", "a@b.co c@d.co", None, "", "plain", f"{CARD} {SECRET}"]
    docs = _docs(spark, texts).withColumn("n", F.lit(1))
    kept = {r.doc_id: r for r in sensitive.mask_sensitive(docs, keep=["email"]).collect()}
    assert kept[0].text == "<SECRET> a@b.co" and kept[0].n_email == 1 and kept[1].n_email == 2
    assert kept[2].text is None and kept[2].n_secret == 0 and kept[4].n == 1
    assert {r.doc_id for r in sensitive.drop_sensitive(docs).collect()} == {1, 2, 3, 4}
    totals = {(r.kind, r.docs, r.findings) for r in sensitive.sensitive_totals(docs, "n").collect()}
    assert totals == {("secret", 2, 2), ("email", 2, 3), ("card", 1, 1)}
    assert sensitive.sensitive_totals(docs.limit(0), "n").count() == 0
    with pytest.raises(ValueError):
        sensitive.mask_sensitive(docs, keep=["name"])


def test_long_text(spark):
    """A run of a million characters without a mail sign costs no more than its length."""
    text = "a1" * 500_000 + f" x {CARD} " + "word " * 100_000
    got = sensitive.mask_sensitive(_docs(spark, [text])).first()
    assert got.n_card == 1 and got.text == text.replace(CARD, "<CARD>")


def test_masking_stays_in_the_jvm(spark):
    plan = sensitive.mask_sensitive(_docs(spark, ["x"]))._jdf.queryExecution().toString()
    assert "Python" not in plan.split("== Physical Plan ==")[1] and "Exchange" not in plan


def test_repetition(spark):
    texts = ["a b\na b\n\nc d\n\nc d", "x y z x y z", "", None, " \n \n", "one"]
    got = {r.doc_id: r for r in repetition.repetition(_docs(spark, texts)).collect()}
    first = got[0]
    assert (first.n_lines, first.line_repeats, first.line_repeat_chars) == (4, 0.5, 0.5)
    assert (first.n_paragraphs, first.paragraph_repeats) == (3, 1 / 3)
    # Runs of two: x y, y z, z x, x y, y z.
    assert (got[1].gram2_repeats, got[1].gram3_repeats, got[1].gram5_repeats) == (2 / 5, 1 / 4, 0.0)
    for empty in (2, 3, 4):
        assert tuple(got[empty])[1:] == (0, 0.0, 0.0, 0, 0.0, 0.0, 0.0, 0.0)
    assert (got[5].n_lines, got[5].gram2_repeats) == (1, 0.0)


@pytest.mark.parametrize("hot_rows", [1, 10**6])
def test_strip_common_lines(spark, monkeypatch, hot_rows):
    monkeypatch.setattr("quern.operators.skew.MAX_BROADCAST_KEYS", 0)
    rng = random.Random(5)
    words = [f"line {i}" for i in range(40)]
    texts = ["\n".join([" boiler ", *rng.choices([*words, "", " "], k=rng.randint(0, 30))]) for _ in range(60)]
    texts += [None, "", "boiler", "rare\nrare"]
    docs = _docs(spark, texts).withColumn("pos", F.lit(7)).withColumn("unit", F.lit("u"))
    held = Counter(x for t in texts if t for x in {u.strip() for u in t.split("\n")} if x)
    rows = Counter(x.strip() for t in texts if t for x in t.split("\n") if x.strip())
    common = {x for x, n in held.items() if n >= 20}

    def rest(text):
        return None if text is None else "\n".join(x for x in text.split("\n") if x.strip() not in common)

    got = repetition.strip_common_lines(docs, 20, hot_rows=hot_rows).collect()
    assert {r.doc_id: r.text for r in got} == dict(enumerate(map(rest, texts))) and len(got) == len(texts)
    assert sum(r.n_removed for r in got) == sum(rows[x] for x in common)
    assert got[0].pos == 7 and got[0].unit == "u"
    counted = {(r.docs, r.rows) for r in repetition.common_units(docs, 20).collect()}
    assert counted == {(held[x], rows[x]) for x in common}
    assert repetition.strip_common_lines(docs.limit(0)).count() == 0


def test_search_finds_what_the_candidate_pattern_finds(spark):
    rng = random.Random(8)
    parts = [
        "a", "word", "x" * 19, "y" * 20, "z" * 70, "DE", "DE89", "GB82 WEST 1234 5698 7654 32", ACCOUNT, CARD, SECRET, "@", "@b.de",
        "mail.example.com", ".", "%", "+", "-", "/", "=", "_", " ", " ", ",", ";", "\n", "(", ")", "1", "12", "2024", "10.0.0.1", "+49 30 1234567", "é",
    ]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 14))) for _ in range(3000)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").repartition(8)
    both = [F.regexp_extract_all("t", F.lit(p), F.lit(0)).alias(n) for p, n in ((rules.CANDIDATE, "a"), (rules.SEARCH, "b"))]
    parted = [F.split("t", p, -1).alias(n) for p, n in ((rules.CANDIDATE, "c"), (rules.SEARCH, "d"))]
    found = rows.select("t", *both, *parted)
    assert found.where("size(a) > 0").count() > 1000
    assert found.where("a <> b OR c <> d").collect() == []
