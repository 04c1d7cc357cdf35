"""Best-fit packing of token sequences by the sum-of-squares rule.

A document's ids are cut only where they exceed the capacity. Each piece then goes
where the squared numbers of open sequences per residual gap become smallest:
into an open sequence with some gap, or into a new one; ties go to the tightest
gap.

Pieces are dealt by hash into groups of about GROUP_ROWS narrow rows, and each
group is packed by one task, in hash order, in which the rule wastes least. The
pieces of sequences that did not become full are packed once more, longest first.
Texts never move: tokenising yields one narrow row per piece.

Defined results: null text counts as empty (one piece: the end id); rows with equal
ids are packed separately; an empty table gives no sequences.
"""

from __future__ import annotations

import base64
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quern.llm.common import Staging, keyed

CAPACITY = 1024
END_ID = 2
GROUP_ROWS = 100_000
VOCABULARY = "byte_bpe_50k"
_SPECIAL = "<|endoftext|>"
# Rows encoded in one go; their ids are the only large thing a task holds.
ENCODE_ROWS = 64

_loaded: dict[str, tuple] = {}


def encoder(vocabulary: str = VOCABULARY):
    """texts -> lists of ids, as the ``tokenizers`` file gives them without special tokens added.

    The rank file of the same vocabulary is several times faster and gives the
    same ids for ordinary text; a text that spells out a special token goes to the
    ``tokenizers`` file itself.
    """
    if vocabulary not in _loaded:
        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
        fast = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        # The multilingual vocabulary has no special tokens and no such file.
        whole = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json")) if vocabulary == VOCABULARY else None
        _loaded[vocabulary] = fast, whole
    fast, whole = _loaded[vocabulary]

    def encode(text: str) -> list[int]:
        if whole and _SPECIAL in text:
            return whole.encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return encode


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: all full but the first."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *((at, capacity) for at in range(first, n, capacity))]


def _pieces(capacity: int, end_id: int, vocabulary: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, ENCODE_ROWS):
                rows = []
                part = batch.slice(at, ENCODE_ROWS)
                for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = np.array([*encode(text or ""), end_id], dtype="<u4")
                    for number, (start, length) in enumerate(cut(len(ids), capacity)):
                        own = ids[start : start + length]
                        rows.append((key, number, start, length, zlib.crc32(own.tobytes()), own if with_ids else None))
                cols = list(zip(*rows)) or [()] * 6
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                arrays = [pa.array(c, k) for c, k in zip(cols, kinds)]
                names = ["key", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    arrays.append(pa.array([x.astype(np.int32) for x in cols[5]], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each length, placed in the given order; bins are numbered from 0."""
    bins = np.empty(len(lengths), dtype=np.int64)
    offsets = np.empty(len(lengths), dtype=np.int64)
    count = np.zeros(capacity + 1, dtype=np.int64)  # open bins by gap
    held: list[list[int]] = [[] for _ in range(capacity + 1)]
    made = 0
    for i, size in enumerate(lengths.tolist()):
        # Change of the sum when a bin with gap g takes the piece: g loses a bin, g - size gains one.
        gaps = np.flatnonzero(count[size:capacity]) + size
        gain = 2 * count[gaps - size] + 1
        gain[gaps == size] = 0
        change = gain - 2 * count[gaps] + 1
        left = capacity - size
        fresh = 2 * count[left] + 1 if left else 0
        if len(gaps) and change.min() <= fresh:
            gap = int(gaps[change.argmin()])
            target = held[gap].pop()
            count[gap] -= 1
        else:
            gap, target = capacity, made
            made += 1
        bins[i], offsets[i] = target, capacity - gap
        if gap > size:
            count[gap - size] += 1
            held[gap - size].append(target)
    return bins, offsets


def _pack_group(capacity: int, longest_first: bool):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        order, up = (["length", "deal", "key", "piece"], [False, True, True, True]) if longest_first else (["deal", "key", "piece"], True)
        rows = rows.sort_values(order, ascending=up, ignore_index=True)
        bins, offsets = sum_of_squares(rows["length"].to_numpy(), capacity)
        group = int(rows["group"].iloc[0])
        used = np.bincount(bins, weights=rows["length"].to_numpy()).astype(np.int64)
        return pd.DataFrame(
            {
                "key": rows["key"],
                "piece": rows["piece"],
                "length": rows["length"],
                "bin": (group << 32) + bins,
                "offset": offsets,
                "used": used[bins],
            }
        )

    return run


def _pack(rows: DataFrame, n: int, capacity: int, longest_first: bool) -> DataFrame:
    """(key, piece, length, bin, offset, used) for rows (key, piece, length)."""
    groups = max(1, math.ceil(n / GROUP_ROWS))
    deal = F.xxhash64("key", "piece")
    dealt = rows.select("key", "piece", "length", deal.alias("deal"), F.pmod(deal, F.lit(groups)).alias("group"))
    return dealt.groupBy("group").applyInPandas(
        _pack_group(capacity, longest_first), "key long, piece int, length long, bin long, offset long, used long"
    )


def pack_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    vocabulary: str = VOCABULARY,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset (and ids, if wanted)."""
    staging = Staging(docs.sparkSession, "packing")
    source, by_id = keyed(docs, id_col, "key", staging)
    schema = "key long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    pieces = staging.write(
        source.select("key", F.col("row").getField(text_col).alias("text")).mapInArrow(
            _pieces(capacity, end_id, vocabulary, with_ids), schema
        )
    )
    part = pieces.where(F.col("length") < capacity).select("key", "piece", "length")
    first = staging.write(_pack(part, part.count(), capacity, False))
    # Pieces of sequences that did not become full are packed once more.
    left = first.where(F.col("used") < capacity)
    again = _pack(left, left.count(), capacity, True)
    # Sequence numbers by kind: full at once 4k, packed again 4k + 1, whole pieces 4k + 2.
    placed = first.where(F.col("used") == capacity).select("key", "piece", (F.col("bin") * 4).alias("sequence_id"), "offset")
    placed = placed.unionByName(again.select("key", "piece", (F.col("bin") * 4 + 1).alias("sequence_id"), "offset"))
    packed = pieces.where(F.col("length") < capacity).join(placed, ["key", "piece"])
    alone = pieces.where(F.col("length") == capacity).withColumns(
        {"sequence_id": F.monotonically_increasing_id() * 4 + 2, "offset": F.lit(0).cast("long")}
    )
    out = packed.unionByName(alone)
    columns = ["piece", "start", "length", "ids_crc32", "sequence_id", "offset", *(["ids"] if with_ids else [])]
    if by_id:
        return out.select(F.col("key").alias(id_col), *columns)
    ids = source.select("key", F.col("row").getField(id_col).alias("_id"))
    return out.join(ids, "key").select(F.col("_id").alias(id_col), *columns)
