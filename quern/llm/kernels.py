"""Vectorised byte kernels shared by the operators that work inside Python tasks.

Texts arrive as Arrow string arrays. Their bytes are used in place: one flat
buffer with one start and one end per row, in slices of a few megabytes, so that
no kernel holds more than a slice (or one chunk of a very long text) at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
# Odd multiplier of the polynomial hash modulo 2**64, and its inverse.
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)

_powers: dict[str, np.ndarray] = {}


def text_slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, row borders) for slices of about ``limit`` bytes.

    Null counts as empty. A row longer than ``limit`` is a slice of its own.
    """
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_binary())
    borders = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    flat = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        after = int(np.searchsorted(borders, borders[row] + limit, side="right")) - 1
        after = min(max(after, row + 1), len(texts))
        yield row, after, flat[borders[row] : borders[after]], borders[row : after + 1] - borders[row]
        row = after


def mix(values: np.ndarray) -> np.ndarray:
    """Bijective finaliser on unsigned 64-bit values."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _power(kind: str, base: int, count: int) -> np.ndarray:
    """base**0 .. base**(count - 1) modulo 2**64, grown as needed and kept per worker."""
    known = _powers.get(kind)
    if known is None or len(known) < count:
        steps = np.full(max(count, 1 << 16), base, dtype=np.uint64)
        steps[0] = 1
        known = _powers[kind] = np.multiply.accumulate(steps)
    return known[:count]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """S with S[i] = sum of (byte + 1) * BASE**j over the first i bytes, modulo 2**64."""
    sums = np.empty(len(data) + 1, dtype=np.uint64)
    sums[0] = 0
    terms = (data.astype(np.uint64) + np.uint64(1)) * _power("forward", BASE, len(data))
    np.add.accumulate(terms, out=sums[1:])
    return sums


def range_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Position-independent hash of each byte range [start, end)."""
    inverse = _power("inverse", BASE_INVERSE, len(sums))
    return mix((sums[ends] - sums[starts]) * inverse[starts])


def gram_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """Hash of every ``width``-byte string, by start."""
    n = len(data) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    sums = prefix_sums(data)
    inverse = _power("inverse", BASE_INVERSE, len(sums))
    return mix((sums[width:] - sums[:n]) * inverse[:n])


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values, by start (runs of doubled width)."""
    if len(values) < width:
        return values[:0]
    known = 1
    while 2 * known <= width:
        values = np.minimum(values[:-known], values[known:])
        known *= 2
    rest = width - known
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def signed(values: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return values.view(np.int64)
