"""Digests and the 64-bit similarity fingerprint."""

from __future__ import annotations

import math
from hashlib import blake2b, md5

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import SHINGLE_TOKENS

_VOTE_CHUNK = 1 << 15
# Texts are fingerprinted together up to about this many characters.
BUFFER_CHARS = 1 << 20


def sha256_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def text_key(text: Column) -> Column:
    """SHA-256 as 32 bytes: the same classes as the hex form at half the shuffle size."""
    return F.unhex(F.sha2(text, 256))


def content_hash(text: Column) -> Column:
    """64-bit non-cryptographic hash; all null texts share one value."""
    return F.xxhash64(text)


def _blake2b_all(joined: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    data = joined.tobytes()
    cuts = zip(starts.tolist(), stops.tolist())
    return np.frombuffer(b"".join([blake2b(data[a:b], digest_size=8).digest() for a, b in cuts]), dtype=np.uint8).reshape(-1, 8)


# MD5 (RFC 1321): rotations, added constants and the message word of each step.
_TURNS = [[7, 12, 17, 22], [5, 9, 14, 20], [4, 11, 16, 23], [6, 10, 15, 21]]
_SINES = [np.uint32(int(abs(math.sin(i + 1)) * 2**32)) for i in range(64)]
_WORDS = [[i, (5 * i + 1) % 16, (3 * i + 5) % 16, 7 * i % 16][i // 16] for i in range(64)]
_BEGIN = [np.uint32(x) for x in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)]
# The longest message that leaves room for its end in one block.
_BLOCK_BYTES = 55


def _padding() -> tuple[np.ndarray, np.ndarray]:
    """By message length: what to keep of a block, and what to set in it."""
    keep = np.zeros((_BLOCK_BYTES + 1, 64), dtype=np.uint8)
    put = np.zeros_like(keep)
    for size in range(_BLOCK_BYTES + 1):
        keep[size, :size] = 255
        put[size, size] = 128
        put[size, 56:64] = np.frombuffer((8 * size).to_bytes(8, "little"), dtype=np.uint8)
    return keep.view("<u4"), put.view("<u4")


_KEEP, _PUT = _padding()


def _md5_blocks(words: np.ndarray) -> np.ndarray:
    """First 8 bytes of the MD5 of one-block messages; ``words`` has a row per message word."""
    a, b, c, d = (np.full(words.shape[1], x) for x in _BEGIN)
    for i in range(64):
        if i < 16:
            f = d ^ (b & (c ^ d))
        elif i < 32:
            f = c ^ (d & (b ^ c))
        elif i < 48:
            f = b ^ c ^ d
        else:
            f = c ^ (b | ~d)
        f += a
        f += words[_WORDS[i]]
        f += _SINES[i]
        turn = _TURNS[i // 16][i % 4]
        turned = f << np.uint32(turn)
        f >>= np.uint32(32 - turn)
        turned |= f
        turned += b
        a, d, c, b = d, c, b, turned
    return np.stack([a + _BEGIN[0], b + _BEGIN[1]], axis=1).astype("<u4").view(np.uint8)


def _md5_all(joined: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    sizes = stops - starts
    raw = np.empty((len(sizes), 8), dtype=np.uint8)
    short = np.flatnonzero(sizes <= _BLOCK_BYTES)
    # Every place of the buffer as the start of one block, without a copy.
    blocks = np.ndarray(max(0, len(joined) - 63), dtype="V64", buffer=joined, strides=(1,))
    rows = blocks[starts[short]].view("<u4").reshape(-1, 16)
    rows &= _KEEP[sizes[short]]
    rows |= _PUT[sizes[short]]
    raw[short] = _md5_blocks(np.ascontiguousarray(rows.T))
    for i in np.flatnonzero(sizes > _BLOCK_BYTES).tolist():
        raw[i] = np.frombuffer(md5(joined[starts[i] : stops[i]]).digest()[:8], dtype=np.uint8)
    return raw


# TOKEN_PATTERN on UTF-8: bytes of words; an ideograph has three bytes, from E4 B8 80 to E9 BF BF.
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_")] = True


def _joined_tokens(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(joined, starts, stops, places): tokens with one space between, where they are there, where they started."""
    inside = _IN_WORD[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    places, ends = edges[::2], edges[1::2]
    lead = (data >= 0xE4) & (data <= 0xE9)
    if lead.any():
        single = np.flatnonzero(lead)
        single = single[(data[single] > 0xE4) | (data[single + 1] >= 0xB8)]
        for i in range(3):
            inside[single + i] = True
        places, ends = np.concatenate([places, single]), np.concatenate([ends, single + 3])
        order = np.argsort(places)
        places, ends = places[order], ends[order]
    sizes = ends - places
    stops = np.cumsum(sizes + 1) - 1
    # Room for a whole block after the last token.
    joined = np.full(len(places) + int(sizes.sum()) + 64, 32, dtype=np.uint8)
    room = np.ones(len(joined) - 64, dtype=bool)
    room[stops] = False
    joined[: len(room)][room] = data[inside]
    return joined, stops - sizes, stops, places


def _column_sums(bits: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Sums of the rows from each head to the next. Eight columns are added as one word, 255 rows at most."""
    cuts = np.union1d(heads, np.arange(0, len(bits), 255))
    few = np.add.reduceat(bits.view(np.uint64), cuts, axis=0).view(np.uint8).astype(np.int64)
    return np.add.reduceat(few, np.searchsorted(cuts, heads), axis=0)


def _fingerprints(texts: list[str], digests) -> np.ndarray:
    """Signed fingerprints of some texts, which share one buffer."""
    # str.lower() knows all letters, some of which become ASCII.
    parts = [text.lower().encode() for text in texts]
    data = np.frombuffer(b"\n".join([b"", *parts, b""]), dtype=np.uint8)
    joined, starts, stops, places = _joined_tokens(data)
    borders = np.cumsum([1, *(len(part) + 1 for part in parts)])
    first = np.searchsorted(places, borders)
    counts = np.diff(first)
    runs = np.where(counts == 0, 0, np.maximum(counts - (SHINGLE_TOKENS - 1), 1))
    ends = np.cumsum(runs)
    owner = np.repeat(np.arange(len(texts)), runs)
    at = np.arange(len(owner)) + (first[:-1] - (ends - runs))[owner]
    last = np.minimum(at + SHINGLE_TOKENS, first[1:][owner]) - 1
    ones = np.zeros((len(texts), 64), dtype=np.int64)
    for low in range(0, len(owner), _VOTE_CHUNK):
        part = slice(low, low + _VOTE_CHUNK)
        bits = np.unpackbits(digests(joined, starts[at[part]], stops[last[part]]), axis=1)
        heads = np.flatnonzero(np.diff(owner[part], prepend=-1))
        ones[owner[part][heads]] += _column_sums(bits, heads)
    majority = np.packbits((2 * ones >= runs[:, None]) & (runs[:, None] > 0), axis=1)
    return majority.view(">i8")[:, 0].astype(np.int64)


FAMILIES = {"blake2b": _blake2b_all, "md5": _md5_all}


def simhash64(text: Column, family: str = "blake2b") -> Column:
    """Signed 64-bit SimHash of a text column; 0 without tokens, null for null.

    ``blake2b`` has no Spark built-in, so votes are counted in numpy, for about
    BUFFER_CHARS of text at a time. This stays in the scan stage: no shuffle, one
    text in, one long out.
    """
    if family not in FAMILIES:
        raise ValueError(f"hash family must be one of {tuple(FAMILIES)}")
    digests = FAMILIES[family]

    @F.pandas_udf(T.LongType())
    def fingerprints(texts: pd.Series) -> pd.Series:
        found, pending, chars = [None] * len(texts), [], 0
        for i, value in enumerate([*texts, None]):
            if value is not None:
                pending.append((i, value))
                chars += len(value)
            if pending and (chars >= BUFFER_CHARS or i == len(texts)):
                for (place, _), fp in zip(pending, _fingerprints([t for _, t in pending], digests).tolist()):
                    found[place] = fp
                pending, chars = [], 0
        return pd.Series(found, dtype="Int64")

    return fingerprints(text)


def md5_hash64(text: Column) -> Column:
    """First 8 bytes of MD5 as a signed long, built-ins only."""
    return F.conv(F.substring(F.md5(text), 1, 16), 16, -10).cast("long")


def hamming(left: Column, right: Column) -> Column:
    return F.bit_count(left.bitwiseXOR(right))
