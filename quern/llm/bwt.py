"""Repeated strings of a minimum length from a Burrows-Wheeler transform.

The transform is extended backwards breadth first: an interval of suffixes that
share a string w of length l gives, for each symbol c before them, the interval
of cw. The place after that interval gets the common-prefix value l unless an
earlier level has set it, so values appear in increasing order. The search stops
at the minimum length: a place still unset then has a longer common prefix.
"""

from __future__ import annotations

import numpy as np


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes, sorted by their first ``depth`` symbols or more (prefix doubling)."""
    n = len(symbols)
    _, rank = np.unique(symbols, return_inverse=True)
    rank = rank.astype(np.int64) + 1
    order = np.argsort(rank, kind="stable")
    width = 1
    while width < depth and rank.max() < n:
        later = np.zeros(n, dtype=np.int64)
        later[: n - width] = rank[width:]
        key = rank * (n + 1) + later
        order = np.argsort(key)
        ordered = key[order]
        rank[order] = np.concatenate([[1], 1 + np.cumsum(ordered[1:] != ordered[:-1])])
        width *= 2
    return order


def repeated_starts(symbols: np.ndarray, length: int) -> np.ndarray:
    """For every place: does the string of ``length`` symbols there start at another place too?

    ``symbols`` must end with a symbol that occurs once; strings are kept apart by
    such symbols.
    """
    n = len(symbols)
    order = suffix_order(symbols, length)
    first = symbols[order]
    before = symbols[order - 1]
    # Place of the suffix that is one symbol longer, by place of the suffix.
    step = np.empty(n, dtype=np.int64)
    step[np.argsort(before, kind="stable")] = np.arange(n)
    is_set = np.zeros(n + 1, dtype=bool)
    is_set[0] = is_set[n] = True
    owner = np.empty(n, dtype=np.int64)
    low, high = np.array([0]), np.array([n])
    for _ in range(length):
        sizes = high - low
        if not len(sizes):
            break
        ends = np.cumsum(sizes)
        member = np.repeat(np.arange(len(sizes)), sizes)
        places = step[np.arange(ends[-1]) - np.repeat(ends - sizes, sizes) + low[member]]
        owner[places] = member
        places.sort()
        cut = (
            (places[1:] != places[:-1] + 1)
            | (owner[places[1:]] != owner[places[:-1]])
            | (first[places[1:]] != first[places[:-1]])
        )
        starts = np.concatenate([[0], np.flatnonzero(cut) + 1])
        lows = places[starts]
        highs = places[np.concatenate([starts[1:] - 1, [len(places) - 1]])] + 1
        fresh = ~is_set[highs]
        low, high = lows[fresh], highs[fresh]
        is_set[high] = True
    repeated = np.empty(n, dtype=bool)
    repeated[order] = ~is_set[:-1] | ~is_set[1:]
    return repeated
