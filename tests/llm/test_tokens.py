"""Token rollups, SentencePiece pieces and language identification."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from quern.llm import langid, pieces, rollup
from quern.llm.common import Staging
from quern.llm.packing import encoder
from quern.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def sums(frame):
    return {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens) for r in frame.collect()}


def test_rollup(spark):
    book = rollup.Rollup(spark, f"{Staging(spark, 'test').root}/book")
    assert sums(book.totals()) == {}
    kind = "doc_id long, source string, lang string, tokenizer string, tokens long"
    before = spark.createDataFrame([(1, "a", "en", "v1", 5), (2, "a", None, "v1", 7), (3, None, "de", "v1", None), (4, "b", "en", "v1", 0)], kind)
    after = spark.createDataFrame([(1, "a", "en", "v1", 6), (2, "a", None, "v1", 7), (4, "b", "en", "v2", 1), (5, "a", "en", "v1", 2)], kind)
    assert book.commit("one", rollup.changes(before.limit(0), before))
    assert not book.commit("one", rollup.changes(before.limit(0), before))
    first = {("a", "en", "v1"): (1, 5), ("a", None, "v1"): (1, 7), (None, "de", "v1"): (1, 0), ("b", "en", "v1"): (1, 0)}
    assert sums(book.totals()) == first
    moved = rollup.changes(before, after)
    assert moved.count() == 6
    assert book.commit("two", moved) and not book.commit("two", moved)
    want = {("a", "en", "v1"): (2, 8), ("a", None, "v1"): (1, 7), ("b", "en", "v2"): (1, 1)}
    assert sums(book.totals()) == want
    book.compact()
    assert sums(book.totals()) == want and book.batches() == {"one", "two"}
    assert not book.commit("two", moved)
    assert book.commit("three", rollup.changes(after, after.limit(0)))
    assert sums(book.totals()) == {}
    with pytest.raises(ValueError):
        book.commit("../x", moved)


def test_rollup_query(spark):
    want = {}
    first, second = encoder("byte_bpe_50k"), encoder("byte_bpe_multi_50k")
    toxic = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if r.toxic == 1}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        if r.doc_id in toxic:
            continue
        name, encode = ("byte_bpe_50k", first) if r.lang == "en" else ("byte_bpe_multi_50k", second)
        docs, tokens = want.get((r.source, r.lang, name), (0, 0))
        want[r.source, r.lang, name] = docs + 1, tokens + len(encode(r.text or ""))
    assert sums(QUERIES["op1_token_rollup"](spark, SF)) == want


def test_token_counts_edges(spark):
    docs = spark.createDataFrame([(1, None, "n"), (1, "", "n"), (None, "a b", "n")], "doc_id long, text string, count string")
    got = sorted((str(r.doc_id), r.tokens) for r in rollup.token_counts(docs, "byte_bpe_50k").collect())
    assert got == [("1", 0), ("1", 0), ("None", 2)]
    assert rollup.token_counts(docs.limit(0), "byte_bpe_50k").count() == 0


ODD = [None, "", " ", "  a  b ", "\n\n x\ty", "a▁b", "日本語 テスト", "\x00é ﬁ ß", "aaaaaaaaaaaaaaaaaaaaaaaa", "<s> <0x41> </s>", "😀 😀", "x" * 3000, " " * 100, "don't stop"]


def test_pieces_equal_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces.MODEL))
    model = pieces.PieceModel()
    texts = ODD + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rng = random.Random(4)
    texts += ["".join(rng.choice("abcdeé ▁\n.,1") for _ in range(60)) for _ in range(300)]
    ids = model.encode(texts)
    assert ids == [library.encode(t or "") for t in texts]
    for text, own in zip(texts, ids):
        assert model.decode(own) == (text or "").replace("▁", " ")
        assert model.decode(own) == library.decode(own)


def test_pieces_query(spark):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(ODD)], "doc_id long, text string, ids string, n_pieces int")
    rows = pieces.encode_documents(docs, with_ids=True).collect()
    assert [r.round_trip for r in rows] == ["▁" not in (t or "") for t in ODD]
    assert all(zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) == r.ids_crc32 for r in rows)
    back = pieces.decode_ids(spark.createDataFrame([(r.row.doc_id, r.ids) for r in rows], "doc_id long, ids array<int>")).collect()
    assert [r.decoded for r in back] == [(t or "").replace("▁", " ") for t in ODD]
    assert pieces.encode_documents(docs.limit(0)).count() == 0


def test_shared_prefixes_are_walked_once():
    model = pieces.PieceModel()
    words = sorted({"▁inter", "▁internal", "▁international", "▁interval"})
    walked = dict(model.walk(words))
    assert all("".join(p) == w for w, p in walked.items())

    class Counted(dict):
        asked = 0

        def get(self, key, default=None):
            Counted.asked += 1
            return super().get(key, default)

    model.pairs = Counted(model.pairs)
    list(model.walk(words))
    together, Counted.asked = Counted.asked, 0
    for w in words:
        list(model.walk([w]))
    assert together < Counted.asked


def test_chain_probabilities_against_all_paths():
    rng = np.random.default_rng(0)
    emissions, transitions, start = rng.normal(size=(1, 4, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    for length in (1, 3, 4):
        mask = np.arange(4)[None] < length
        got = langid.forward_backward(np.where(mask[..., None], emissions, 0), mask, transitions, start)[0][0, :length]
        want = np.zeros((length, 3))
        for path in np.ndindex(*[3] * length):
            score = start[path[0]] + sum(emissions[0, t, y] for t, y in enumerate(path)) + sum(transitions[a, b] for a, b in zip(path, path[1:]))
            for t, y in enumerate(path):
                want[t, y] += np.exp(score)
        assert np.allclose(got, want / want.sum(axis=1, keepdims=True))


def test_language_held_out_and_switches(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    truth = {r.doc_id: (r.lang, r.text) for r in docs.collect()}
    rows = QUERIES["op9_language_id"](spark, SF).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    judged = [r.lang_pred == truth[r.doc_id][0] for r in rows if r.held_out and truth[r.doc_id][0]]
    assert len(judged) > 100 and np.mean(judged) > 0.97
    model = langid.fit(docs)
    by = {}
    for lang, text in truth.values():
        by.setdefault(lang, " ".join(text.split()[:40]))
    mixed = spark.createDataFrame([(1, by["en"] + " " + by["de"])], "doc_id long, text string")
    runs = langid.label_documents(mixed, model, with_runs=True).first().runs
    share = {lang: sum(r.words for r in runs if r.lang == lang) for lang in ("en", "de")}
    assert share["en"] > 25 and share["de"] > 25


def test_language_edges(spark):
    rows = [(1, None, None), (2, "", "en"), (3, "123 !?", "en"), (None, "hello world", "en"), (5, "hello", None)]
    docs = spark.createDataFrame([(*r, 0.1) for r in rows], "doc_id long, text string, lang string, score double")
    assert langid.fit(docs) is None
    assert {r.lang_pred for r in langid.label_documents(docs, None).collect()} == {"und"}
    more = docs.union(spark.createDataFrame([(i, "hello world again " * 3, "en", 0.1) for i in range(10, 20)], docs.schema))
    found = {r.row.doc_id: (r.lang_pred, r.score) for r in langid.label_documents(more, langid.fit(more)).collect()}
    assert found[1] == found[2] == found[3] == ("und", 0.0) and found[5][0] == "en"
    assert langid.label_documents(docs.limit(0), None).count() == 0


def test_long_runs_of_letters_give_features_to_their_end():
    run = "".join(chr(ord("a") + i * i % 26) for i in range(130))
    words = langid.words_of(run)
    assert "".join(words) == run and max(map(len, words)) == 40
    ends = {f for w in words for f in langid.features(w, {})}
    assert set(langid.features(run[120:130], {})) <= ends
    other = run[:60] + "zzzyyyxxx" + run[69:]
    assert {f for w in langid.words_of(other) for f in langid.features(w, {})} != ends
    assert langid.words_of("An ordinary text") == ["an", "ordinary", "text"]
