"""The stages of the corpus pipeline on hand-made documents."""

import random

import pytest

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _docs(spark, texts):
    return spark.createDataFrame([(i, t, "en", "web", len(t)) for i, t in enumerate(texts)], SCHEMA)


def _prose(rng, n, size=5):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(size)) for _ in range(n))


def test_shared_passages_of_over_50_words_go(spark):
    rng = random.Random(3)
    for size in (4, 5):
        shared, short = _prose(rng, 51, size), _prose(rng, 45, size)
        assert 200 <= len(shared) < 400
        texts = [f"{_prose(rng, 30)} {shared} {_prose(rng, 30)}" for _ in range(2)]
        texts += [f"{_prose(rng, 30)} {short} {_prose(rng, 30)}" for _ in range(2)]
        out = {r.doc_id: r for r in corpus_pipeline.repeat_removal(spark, _docs(spark, texts), "").collect()}
        assert all(shared not in out[i].text and len(out[i].text) <= len(texts[i]) - len(shared) for i in (0, 1))
        assert all(out[i].n_chars == len(out[i].text) for i in out)
        assert [out[i].text for i in (2, 3)] == texts[2:]


def test_near_copies_share_five_word_shingles(spark):
    rng = random.Random(4)
    words = _prose(rng, 400).split()
    edited = [f"x{i}" if i % 41 == 20 else w for i, w in enumerate(words)]
    closer = [f"x{i}" if i % 80 == 20 else w for i, w in enumerate(words)]

    def alike(a, b, n):
        x, y = ({tuple(d[i : i + n]) for i in range(len(d) - n + 1)} for d in (a, b))
        return len(x & y) / len(x | y)

    assert alike(words, edited, 4) >= 0.8 > alike(words, edited, 5)
    kept = corpus_pipeline.near_dedup(spark, _docs(spark, [" ".join(words), " ".join(edited)]), "").collect()
    assert sorted(r.doc_id for r in kept) == [0, 1]
    assert alike(words, closer, 5) >= 0.8
    kept = corpus_pipeline.near_dedup(spark, _docs(spark, [" ".join(words), " ".join(closer)]), "").collect()
    assert sorted(r.doc_id for r in kept) == [0]


EDGES = [(1, None, None, None, None), (2, "", "en", "web", 0), (3, "same text here", "en", "web", 14), (9, "same text here", None, "web", 14), (4, "x" * 50_000, "de", None, 5)]


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_nulls_ties_and_nothing(spark, name, stage):
    """Null and empty texts, equal texts, a very long word and an empty table have a result in every stage."""
    docs = spark.createDataFrame(EDGES, SCHEMA)
    out = stage(spark, docs, "/root/testdata/sf0.01")
    rows = {r.doc_id: r for r in out.collect()}
    if name == "packing":
        assert set(rows) == {1, 2, 3, 4, 9}
    else:
        assert out.columns == docs.columns
        kept = {"toxicity": {1, 2, 3, 4, 9}, "exact_dedup": {2, 4, 9}, "near_dedup": {1, 2, 3, 4}, "repeat_removal": {1, 2, 3, 4, 9}}[name]
        assert set(rows) == kept
    assert stage(spark, docs.limit(0), "/root/testdata/sf0.01").count() == 0
