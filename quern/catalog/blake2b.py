"""BLAKE2b with an 8-byte digest as plain SQL, so that the default hash family has an oracle."""

from __future__ import annotations

# Fixed values of RFC 7693: initial state and the order of message words per round.
INITIAL = [
    0x6A09E667F3BCC908,
    0xBB67AE8584CAA73B,
    0x3C6EF372FE94F82B,
    0xA54FF53A5F1D36F1,
    0x510E527FADE682D1,
    0x9B05688C2B3E6C1F,
    0x1F83D9ABFB41BD6B,
    0x5BE0CD19137E2179,
]
SIGMA = [
    [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15],
    [14, 10, 4, 8, 9, 15, 13, 6, 1, 12, 0, 2, 11, 7, 5, 3],
    [11, 8, 12, 0, 5, 2, 15, 13, 10, 14, 3, 6, 7, 1, 9, 4],
    [7, 9, 3, 1, 13, 12, 11, 14, 2, 6, 5, 10, 4, 0, 15, 8],
    [9, 0, 5, 7, 2, 4, 10, 15, 14, 1, 11, 12, 6, 8, 3, 13],
    [2, 12, 6, 10, 0, 11, 8, 3, 4, 13, 7, 5, 15, 14, 1, 9],
    [12, 5, 1, 15, 14, 13, 4, 10, 0, 7, 6, 3, 9, 2, 8, 11],
    [13, 11, 7, 14, 12, 1, 3, 9, 5, 0, 15, 4, 8, 6, 2, 10],
    [6, 15, 14, 9, 11, 3, 0, 8, 12, 2, 13, 7, 1, 4, 10, 5],
    [10, 2, 8, 4, 7, 6, 1, 5, 15, 11, 9, 14, 3, 12, 13, 0],
]
ROUNDS = 12
DIGEST_BYTES = 8
BLOCK = 128
MASK = "18446744073709551615"

_STATE = [f"h{i}" for i in range(8)]
_WORDS = [f"m{i}" for i in range(16)]
_WORK = [f"v{i}" for i in range(16)]
_CARRIED = ["s", "bytes", "size", "block", *_STATE]


def _add(*terms: str) -> str:
    return f"(({' + '.join(terms)}) & {MASK})"


def _rotate(x: str, by: int) -> str:
    return f"(({x} >> {by}) | (({x} << {64 - by}) & {MASK}))"


def _lanes(half: int) -> list[tuple[int, int, int, int]]:
    """Work words that are mixed together: columns, then diagonals."""
    return [
        (i, 4 + (i + half) % 4, 8 + (i + 2 * half) % 4, 12 + (i + 3 * half) % 4) for i in range(4)
    ]


def _step(source: str, changed: dict[str, str]) -> str:
    columns = [f"{changed[c]} AS {c}" if c in changed else c for c in [*_CARRIED, *_WORDS, *_WORK]]
    return f"SELECT {', '.join(columns)} FROM ({source})"


def _mixed(source: str, order: list[int], half: int) -> str:
    """Eight updates of each of four lanes; one level of nesting per two updates."""
    for turn, (by_d, by_b) in enumerate([(32, 24), (16, 63)]):
        first, second = {}, {}
        for lane, (a, b, c, d) in enumerate(_lanes(half)):
            word = f"m{order[8 * half + 2 * lane + turn]}"
            first[f"v{a}"] = _add(f"v{a}", f"v{b}", word)
            first[f"v{d}"] = f"xor(v{d}, {first[f'v{a}']})"
            second[f"v{d}"] = _rotate(f"v{d}", by_d)
            second[f"v{c}"] = _add(f"v{c}", second[f"v{d}"])
        source = _step(_step(source, first), second)
        mixed = {f"v{b}": f"xor(v{b}, v{c})" for _, b, c, _ in _lanes(half)}
        turned = {f"v{b}": _rotate(f"v{b}", by_b) for _, b, _, _ in _lanes(half)}
        source = _step(_step(source, mixed), turned)
    return source


def _word(i: int) -> str:
    """Little-endian word ``i`` of the current block, zeros beyond the end."""
    at = f"block * {2 * BLOCK} + {16 * i}"
    pairs = " || ".join(f"rpad(substr(bytes, ({at} + {2 * k + 1})::BIGINT, 2), 2, '0')" for k in reversed(range(8)))
    return f"('0x' || {pairs})::UBIGINT::HUGEINT"


def ctes(source: str) -> str:
    """CTEs up to blake(s, h): the digest, read from the left, of every distinct ``s`` of a relation.

    Needs WITH RECURSIVE: a text longer than a block takes one turn per block.
    """
    start = [f"{value ^ (0x01010000 | DIGEST_BYTES) if i == 0 else value}::HUGEINT" for i, value in enumerate(INITIAL)]
    last = f"(block + 1) * {BLOCK} >= size"
    work = [*_STATE, *[f"{value}::HUGEINT" for value in INITIAL]]
    work[12] = f"xor({INITIAL[4]}::HUGEINT, least((block + 1) * {BLOCK}, size)::HUGEINT)"
    work[14] = f"CASE WHEN {last} THEN xor({INITIAL[6]}::HUGEINT, {MASK}::HUGEINT) ELSE {INITIAL[6]}::HUGEINT END"
    loaded = [*[f"{_word(i)} AS m{i}" for i in range(16)], *[f"{x} AS v{i}" for i, x in enumerate(work)]]
    # The first turn is always taken, also for an empty text.
    body = (
        f"SELECT {', '.join([*_CARRIED, *loaded])} FROM blake_blocks "
        f"WHERE block = 0 OR block * {BLOCK} < size"
    )
    for number in range(ROUNDS):
        for half in range(2):
            body = _mixed(body, SIGMA[number % len(SIGMA)], half)
    folded = [f"xor(xor(h{i}, v{i}), v{i + 8})" for i in range(8)]
    swapped = " + ".join(f"(((h0 >> {8 * k}) & 255) << {56 - 8 * k})" for k in range(8))
    return f"""
    blake_texts AS (SELECT s, hex(encode(s)) AS bytes, octet_length(encode(s))::BIGINT AS size
      FROM (SELECT DISTINCT s FROM {source})),
    blake_blocks(s, bytes, size, block, {', '.join(_STATE)}) AS (
      SELECT s, bytes, size, 0::BIGINT, {', '.join(start)} FROM blake_texts
      UNION ALL
      SELECT s, bytes, size, block + 1, {', '.join(folded)} FROM ({body})),
    blake AS (
      SELECT s, ({swapped})::UBIGINT AS h FROM blake_blocks
      WHERE block = greatest(1, (size + {BLOCK - 1}) // {BLOCK}))"""
