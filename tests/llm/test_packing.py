"""Packing: coverage, capacity, ids and checksums against the tokenizers file."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quern.llm import packing


def check(rows, texts, capacity):
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: [*whole.encode(t or "", add_special_tokens=False).ids, 2] for i, t in texts.items()}
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append((r.piece, r.start, r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        own = np.array(ids[r.doc_id][r.start : r.start + r.length], dtype="<u4")
        assert zlib.crc32(own.tobytes()) == r.ids_crc32
    for i, found in pieces.items():
        found.sort()
        n = len(ids[i])
        assert [p for p, _, _ in found] == list(range(-(-n // capacity)))
        assert all(size == capacity for _, _, size in found[1:])
        assert sum(size for _, _, size in found) == n
        assert [s for _, s, _ in found] == [sum(x[2] for x in found[:k]) for k in range(len(found))]
    assert set(pieces) == set(texts)
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(x[1] for x in parts[:k]) for k in range(len(parts))]
        assert sum(size for _, size in parts) <= capacity
    total = sum(len(x) for x in ids.values())
    return len(sequences), -(-total // capacity)


@pytest.mark.parametrize("group", [100_000, 50])
def test_pack(spark, monkeypatch, group):
    monkeypatch.setattr(packing, "GROUP_ROWS", group)
    rng = random.Random(3)
    texts = {i: " ".join(rng.choice(["ab", "größe", "42", "don't", "\n\n", "日本"]) for _ in range(rng.randint(0, 90))) for i in range(300)}
    texts |= {1000: None, 1001: "", 1002: "x " * 5000, 1003: "a<|endoftext|>b", 1004: "y" * 100_000}
    docs = spark.createDataFrame([(i, t, 1, "z") for i, t in texts.items()], "doc_id long, text string, piece int, offset string")
    rows = packing.pack_documents(docs, capacity=128).collect()
    made, least = check(rows, texts, 128)
    assert made <= 1.1 * least + 1


def test_pack_edges(spark):
    docs = spark.createDataFrame([(None, "a"), (4, "b"), (4, "b")], "doc_id long, text string")
    rows = packing.pack_documents(docs, with_ids=True).collect()
    assert len(rows) == 3 and len({r.sequence_id for r in rows}) == 1
    assert sorted(len(r.ids) for r in rows) == [2, 2, 2]
    assert packing.pack_documents(docs.limit(0)).count() == 0


def test_rule_against_plain_search():
    rng = np.random.default_rng(0)
    sizes = rng.integers(1, 20, 400)
    bins, offsets = packing.sum_of_squares(sizes, 20)
    used, count = {}, np.zeros(21, int)
    for size, found, offset in zip(sizes, bins, offsets):
        best = []
        for gap in [g for g in range(size, 20) if count[g]] + [20]:
            after = count.copy()
            after[gap] -= gap < 20
            after[gap - size] += gap > size
            best.append(((after[1:20] ** 2).sum(), gap))
        gap = 20 - used.get(found, 0)
        assert (used.get(found, 0), min(best)) == (offset, (min(best)[0], gap))
        count[gap] -= gap < 20
        count[gap - size] += gap > size
        used[found] = used.get(found, 0) + size
    assert max(used.values()) <= 20
