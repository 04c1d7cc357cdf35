"""Exact and near deduplication against brute force on small tables."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from quern.llm import extendible, hyperminhash
from quern.llm.common import Staging
from quern.llm.extendible import build_directory, drop_copies, exact_groups
from quern.llm.hyperminhash import drop_near_copies, near_components


def brute_exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    return {
        i: (max(g), len(g), i == max(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g
    }


TEXTS = ["a", "a", "A", "", None, "é", "é", "a ", "b", "a", "long " * 30_000, "long " * 30_000]


@pytest.mark.parametrize("hash_of", [F.xxhash64, lambda c: F.pmod(F.length(c), F.lit(2))])
def test_exact_groups(spark, hash_of):
    rows = list(enumerate(TEXTS))
    docs = spark.createDataFrame([(i, t, 1, "h") for i, t in rows], "doc_id long, text string, n int, hash string")
    found, _ = exact_groups(docs, hash_of=hash_of)
    got = {r.key: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in found.collect()}
    assert got == brute_exact(rows)
    kept = drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, r in got.items() if r[2])


def test_exact_null_and_repeated_ids(spark):
    docs = spark.createDataFrame([(None, "x"), (None, "x"), (3, "x"), (3, "y"), (3, None)], "doc_id long, text string")
    found, _ = exact_groups(docs)
    rows = found.collect()
    assert sorted((r.keep_id, r.group_size) for r in rows) == [(3, 1), (3, 1), (3, 3), (3, 3), (3, 3)]
    assert sum(r.kept for r in rows) == 3
    assert exact_groups(docs.limit(0))[0].count() == 0


def test_directory_splits_overfull_buckets(spark):
    staging = Staging(spark, "test")
    uniform = spark.range(4000).select(F.xxhash64("id").alias("hash"))
    crowded = spark.range(300).select(F.shiftrightunsigned(F.xxhash64("id"), 5).alias("hash"))
    directory, depth = build_directory(uniform.union(crowded), staging, capacity=500)
    rows = directory.collect()
    assert len({r.cell for r in rows}) == len(rows)
    assert len({r.depth for r in rows}) > 1
    assert all(r.n <= 500 or r.depth == depth for r in rows)
    buckets = {(r.bucket, r.depth): r.n for r in rows}
    assert sum(buckets.values()) == 4300


@pytest.mark.parametrize("hash_of", [F.xxhash64, lambda c: F.pmod(F.length(c), F.lit(2))])
def test_exact_groups_split_and_salted(spark, monkeypatch, hash_of):
    monkeypatch.setattr(extendible, "SALT_ROWS", 3)
    rows = [(i, f"text {i % 6}") for i in range(60)] + [(200 + i, "hot") for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found, _ = exact_groups(docs, hash_of=hash_of, capacity=4)
    assert {r.key: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in found.collect()} == brute_exact(rows)


def test_rows_are_routed_by_the_directory(spark, monkeypatch):
    """Without the directory's cells no row finds its bucket, and no copy is found."""
    docs = spark.createDataFrame([(i, f"text {i % 10}") for i in range(40)], "doc_id long, text string")
    assert {r.group_size for r in exact_groups(docs)[0].collect()} == {4}

    def emptied(*args, **kwargs):
        directory, depth = build_directory(*args, **kwargs)
        return directory.limit(0), depth

    monkeypatch.setattr(extendible, "build_directory", emptied)
    assert {r.group_size for r in exact_groups(docs)[0].collect()} == {1}


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < 4:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 4]) for i in range(len(words) - 3)}


def brute_near(rows):
    sets = {i: shingles(t) for i, t in rows}
    label = {i: i for i in sets}
    changed = True
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return {i: (len(sets[i]), label[i], label[i] == i) for i in sets}


def near_corpus(seed):
    rng = random.Random(seed)
    prose = lambda n: [rng.choice("abcdefgh") + str(rng.randint(0, 40)) for _ in range(n)]
    texts = ["", None, " \t\n", "one", "ONE", "one two", "one two three", "a b c d", "A b  c\nd", "é è ü ö ß", "É è ü ö ß"]
    for _ in range(25):
        base = prose(rng.randint(4, 120))
        for _ in range(rng.randint(1, 9)):
            words = list(base)
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = "x" + str(rng.randint(0, 9))
            texts.append(" ".join(words))
    passage = prose(60)
    texts += [" ".join(prose(20) + passage + prose(20)) for _ in range(30)]
    texts += ["w " * 50_000, "w " * 49_000]
    order = list(range(len(texts)))
    rng.shuffle(order)
    return list(zip(order, texts))


@pytest.mark.parametrize("seed", [1, 2])
def test_near_components(spark, seed):
    rows = near_corpus(seed)
    docs = spark.createDataFrame([(i, t, 0, 1) for i, t in rows], "doc_id long, text string, n int, key int")
    found, _ = near_components(docs)
    got = {r.id: (r.n_shingles, r.component_id, r.kept) for r in found.collect()}
    want = brute_near(rows)
    assert got == want
    if seed == 1:
        kept = drop_near_copies(docs)
        assert kept.columns == docs.columns
        assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, r in want.items() if r[2])


def edited_corpus(copies, words=200, most=7, seed=4):
    """Copies of one text with 0 to ``most`` - 1 words replaced each, and short texts around a common passage."""
    rng = random.Random(seed)
    prose = lambda n: [rng.choice("abcdefgh") + str(rng.randint(0, 400)) for _ in range(n)]
    base, texts = prose(words), []
    for i in range(copies):
        own = list(base)
        for at in rng.sample(range(words), i % most):
            own[at] = f"e{i}x{at}"
        texts.append(" ".join(own))
    passage = prose(12)
    texts += [" ".join(prose(3) + passage + prose(rng.randint(1, 9))) for _ in range(copies)]
    return list(enumerate(texts))


def test_small_cells_and_heads_give_the_same_components(spark, monkeypatch):
    monkeypatch.setattr(hyperminhash, "CELL", 16)
    monkeypatch.setattr(hyperminhash, "HEAD_ROWS", 8)
    rows = edited_corpus(150)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for stars, bands in ((2, 3), (0, 3), (1, 41)):
        monkeypatch.setattr(hyperminhash, "STARS", stars)
        monkeypatch.setattr(hyperminhash, "STAR_BANDS", bands)
        got = {r.id: (r.n_shingles, r.component_id, r.kept) for r in near_components(docs)[0].collect()}
        assert got == brute_near(rows)


def test_pairs_and_links_grow_in_proportion(spark, monkeypatch):
    written = {}
    real = Staging.write

    def counted(self, df):
        out = real(self, df)
        if df.columns == ["a", "b"]:
            written.setdefault(self.root, []).append(out.count())
        return out

    monkeypatch.setattr(Staging, "write", counted)
    for copies in (300, 600):
        near_components(spark.createDataFrame(edited_corpus(copies), "doc_id long, text string"))[0].count()
    small, large = written.values()
    assert all(n <= 2 * 600 for n in large) and sum(large) <= 2.6 * sum(small)


def test_near_null_and_repeated_ids(spark):
    text = "the quick brown fox jumps over"
    docs = spark.createDataFrame([(None, text), (7, text), (7, text.upper()), (9, "other words here now"), (None, None)], "doc_id long, text string")
    rows = near_components(docs)[0].collect()
    assert sorted((str(r.component_id), r.kept) for r in rows) == [("7", False), ("7", False), ("7", True), ("9", True), ("None", True)]
    assert near_components(docs.limit(0))[0].count() == 0
