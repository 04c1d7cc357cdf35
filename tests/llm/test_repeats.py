"""Removal of repeated strings against a brute-force count of all windows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from pyspark.sql import functions as F

from quern.llm import queries, repeats
from quern.llm.bwt import repeated_starts
from quern.llm.kernels import sliding_minimum
from quern.llm.repeats import remove_repeats


def brute(texts, length):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r) + 2, dtype=bool)
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[1 + i : 1 + i + length] = True
        rest = bytes(b for b, g in zip(r, gone[1:]) if not g)
        spans = int(((~gone[:-1]) & gone[1:]).sum())
        out.append((len(r), int(gone.sum()), spans, hashlib.sha256(rest).hexdigest()))
    return out


def corpus(seed, length):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(rng.randint(length // 5, length // 2)) for _ in range(4)]
    base = prose(length)
    texts = [None, "", "x", prose(30), base, base, base[: length + 3], "ab" * length, "é" * length]
    for _ in range(30):
        parts = [prose(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 2)):
            parts += [rng.choice(passages), prose(rng.randint(1, 50))]
        texts.append(" ".join(parts))
    for _ in range(12):
        edited = list(base)
        for _ in range(rng.randint(1, 3)):
            edited[rng.randrange(len(edited))] = "#"
        texts.append("".join(edited))
    texts.append(passages[0] + " " + prose(5) + passages[0])
    return texts


@pytest.mark.parametrize("length,crowd", [(400, 16384), (400, 2), (150, 3)])
def test_against_all_windows(spark, length, crowd):
    texts = corpus(length + crowd, length)
    rows = [(i, t, "row", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string, n long")
    found = remove_repeats(docs, length=length, crowd=crowd).select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    got = {r[0]: tuple(r[1:]) for r in found.collect()}
    assert got == dict(enumerate(brute(texts, length)))
    assert sum(r[1] for r in got.values()) > 0


def test_null_and_repeated_ids_and_empty(spark):
    text = "0123456789" * 50
    docs = spark.createDataFrame([(None, text), (None, text), (5, "a"), (5, None)], "doc_id long, text string")
    got = sorted(tuple(r) for r in remove_repeats(docs).select("row.doc_id", "n_bytes", "n_removed").collect() if r[0])
    assert got == [(5, 0, 0), (5, 1, 0)]
    assert [r.n_removed for r in remove_repeats(docs).collect() if r.row.doc_id is None] == [500, 500]
    assert remove_repeats(docs.limit(0)).count() == 0


def test_transform_against_counts():
    rng = np.random.default_rng(1)
    for _ in range(100):
        parts = [rng.integers(0, 3, rng.integers(0, 30)) for _ in range(4)]
        symbols = np.concatenate([np.append(p, 10 + i) for i, p in enumerate(parts)]).astype(np.int64)
        size = int(rng.integers(1, 9))
        strings = [tuple(symbols[i : i + size]) for i in range(len(symbols))]
        counts = Counter(s for s in strings if len(s) == size)
        assert repeated_starts(symbols, size).tolist() == [counts[s] > 1 for s in strings]


def test_passages_of_over_50_words_beside_the_strings(spark, tmp_path):
    """A shared passage of 51 words under 400 bytes: no string of 400 bytes, but a passage."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(4, 6)))
    prose = lambda n: " ".join(word() for _ in range(n))
    # Neighbours of the passages differ in their first letter, so that the ranges are theirs alone.
    passage, short, long = "(" + prose(51) + ")", "(" + prose(45) + ")", "(" + prose(120) + ")"
    assert 200 <= len(passage) < 400 and 200 <= len(short) and len(long) > 400
    heads, tails = [prose(30) + x for x in "ABCDEFG"], [x + prose(30) for x in "HIJKLMN"]
    put = lambda i, p: heads[i] + p + tails[i]
    texts = [put(0, passage), put(1, passage), put(2, short), put(3, short), put(4, long), put(5, long), put(6, ""), None]
    rows = [(None if i == 1 else i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    found = queries.QUERIES["op6_repeat_removal"](spark, str(tmp_path)).collect()
    got = {1 if r.doc_id is None else r.doc_id: r for r in found}
    assert len(found) == len(texts)
    # The contract's columns keep to strings of 400 bytes.
    assert {i: tuple(r[1:5]) for i, r in got.items()} == dict(enumerate(brute(texts, 400)))
    gone = {0: passage, 1: passage, 4: long, 5: long}
    for i, text in enumerate(texts):
        assert got[i].passage_text == (text or "").replace(gone.get(i, "\n"), "")
        assert got[i].n_passage_removed == len(gone.get(i, ""))
        assert got[i].n_passages == int(i in gone)
    assert {i for i, r in got.items() if r.n_removed} == {4, 5}


def brute_passages(texts):
    """Texts without the ranges of repeated 200-byte strings that hold over 50 words or 400 bytes."""
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + 200] for r in raws for i in range(len(r) - 199))
    out = []
    for r in raws:
        gone = np.zeros(len(r) + 2, dtype=np.int8)
        for i in range(len(r) - 199):
            if seen[r[i : i + 200]] > 1:
                gone[1 + i : 201 + i] = 1
        edges = np.diff(gone)
        runs = [
            (a, b)
            for a, b in zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist())
            if b - a >= 400 or len(r[a:b].split()) > 50
        ]
        borders = [0, *(x for run in runs for x in run), len(r)]
        rest = b"".join(r[a:b] for a, b in zip(borders[::2], borders[1::2]))
        out.append((rest.decode("utf-8", "ignore"), sum(b - a for a, b in runs), len(runs)))
    return out


@pytest.mark.parametrize("length,crowd", [(400, 16384), (300, 2), (150, 16384)])
def test_both_searches_against_all_windows(spark, length, crowd):
    """The longer strings are looked for in the ranges of the shorter ones only, and none is lost."""
    texts = corpus(7 * length + crowd, 400)
    rng = random.Random(length)
    letters = lambda n: "".join(rng.choice("abcdefé ") for _ in range(n))
    shared, other = letters(700), letters(450)
    # The same range twice, the same bytes in a longer range, a range beside others in one long text.
    texts += ["#" + shared + "#", "+" + shared + "+", letters(90) + shared + other + letters(90)]
    texts += [letters(70_000) + shared[100:] + letters(50) + other + "!", other[30:], shared[:250] + letters(300) + shared[300:]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = remove_repeats(docs, length=length, crowd=crowd, passages=True).collect()
    got = {r.row.doc_id: r for r in found}
    assert len(found) == len(texts)
    columns = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert {i: tuple(r[c] for c in columns) for i, r in got.items()} == dict(enumerate(brute(texts, length)))
    columns = ("passage_text", "n_passage_removed", "n_passages")
    assert {i: tuple(r[c] for c in columns) for i, r in got.items()} == dict(enumerate(brute_passages(texts)))


def test_second_search_reads_only_repeated_ranges(spark, monkeypatch):
    """Strings of 400 bytes are looked for in what repeats by 200 bytes, not in all texts again."""
    rng = random.Random(11)
    letters = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    shared = letters(600)
    texts = [letters(3000) for _ in range(20)] + ["#" + shared + letters(500), "+" + shared + letters(500), letters(500) + shared]
    searched = []
    search = repeats.repeat_spans

    def seen(rows, length, *more):
        searched.append((length, rows.agg(F.sum(F.octet_length("text"))).first()[0]))
        return search(rows, length, *more)

    monkeypatch.setattr(repeats, "repeat_spans", seen)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.row.doc_id: r.n_removed for r in remove_repeats(docs, passages=True).collect()}
    sizes = dict(searched)
    assert sizes[200] == sum(len(t) for t in texts)
    # Equal ranges are searched once.
    assert 600 <= sizes[400] < 2 * 600
    assert {i: n for i, n in found.items() if n} == {i: brute(texts, 400)[i][1] for i in (20, 21, 22)}


def test_minimum_of_runs():
    values = np.random.default_rng(2).integers(0, 1 << 40, 300).astype(np.uint64)
    for width in (1, 2, 3, 64, 137, 300, 301):
        expected = [int(values[i : i + width].min()) for i in range(len(values) - width + 1)]
        assert sliding_minimum(values, width).tolist() == expected
