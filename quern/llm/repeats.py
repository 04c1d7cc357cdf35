"""Removal of long repeated passages (suffix-array deduplication).

Every byte covered by a ``length``-byte string that also starts anywhere else,
in the same document or another, is removed; strings are judged on the input.

1. Anchors. Each ``length``-byte window is owned by the smallest hash among its
   ``GRAM``-byte strings. Equal windows have equal anchors at equal offsets, so a
   repeat can only exist among windows of an anchor that occurs twice. One narrow
   row stands for all consecutive windows of an anchor (its region).
2. Identical regions fold to one row with a count; those repeat as a whole. The windows
   of a region all hold its anchor, so those that repeat cover one range of bytes.
3. Other regions are cut into pieces of ``BLOCK`` windows aligned to the anchor.
   All windows of a piece contain its core; beyond it they differ by fewer than
   ``BLOCK`` bytes on either side. Identical pieces fold again.
4. Pieces that share a core but not both flanks are compared by a
   Burrows-Wheeler transform (``quern.llm.bwt``), in which the core is one symbol
   and the minimum length is ``BLOCK`` symbols. Groups are packed into blocks of
   a bounded number of symbols; a core with more than ``crowd`` different flank
   pairs is counted window by window by Spark instead, so no task holds it.

Defined results: null text counts as empty; a text under ``length`` bytes is
kept; copies of a long document lose all their bytes; matches never cross
documents. Document ids may repeat or be null, every row is a document.

Passages are judged by words: ``remove_repeats`` can also return each text without its
repeated passages of over ``PASSAGE_WORDS`` words, most of which are shorter than ``LENGTH``.
A string that repeats lies within the ranges of any shorter length, so the search for the
shorter strings comes first, and the one for the longer strings reads only its ranges.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.bwt import repeated_starts
from quern.llm.common import Staging, keyed
from quern.llm.kernels import gram_hashes, signed, sliding_minimum, text_slices
from quern.operators.skew import join_groups

LENGTH = 400
GRAM = 64
BLOCK = 32
# Repeated passages of more than PASSAGE_WORDS words. 51 words are at least
# PASSAGE_BYTES bytes long in 99.5 per cent of the places of the documents at sf0.1.
PASSAGE_WORDS, PASSAGE_BYTES = 50, 200
CROWD = 16_384
# A transform takes whole cores until it has this many symbols.
BLOCK_SYMBOLS = 1 << 18
# Texts longer than this are searched in chunks that overlap by LENGTH - 1 bytes.
CHUNK = 1 << 23
# Texts are hashed together up to this many bytes, whose hashes stay in a core's cache.
HASHED_BYTES = 1 << 16
# Anchors in a batch of rows.
BATCH_ROWS = 1 << 16
# Anchors and regions with this many places are not shuffled by their hash.
HOT_ROWS = 10_000
_PLACE = np.uint64((1 << 24) - 1)

_ANCHOR = "key long, anchor long, region long, start long, size int, offset int"
_PIECE = "key long, first long, n long, core long, core2 long, flank long, left binary, right binary"


def _regions(data: np.ndarray, length: int):
    """(anchor hash, first window, last window, anchor place) arrays of one stretch of bytes."""
    hashes = gram_hashes(data, GRAM)
    ranked = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    place = (sliding_minimum(ranked, length - GRAM + 1) & _PLACE).astype(np.int64)
    return hashes, place


def _anchors_of(keys: np.ndarray, texts: pa.Array, length: int) -> Iterator[pa.RecordBatch]:
    names = ["key", "anchor", "region", "start", "size", "offset"]
    held: list[tuple] = []
    count = 0

    def joined() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], names=names)

    for row, after, data, borders in text_slices(texts, HASHED_BYTES):
        # Windows from here to the end of their text would reach beyond it.
        beyond = borders[1:][np.diff(borders) >= length] - length + 1
        for base in range(0, max(len(data) - length + 1, 0), CHUNK - length + 1):
            part = data[base : base + CHUNK]
            hashes, place = _regions(part, length)
            marks = np.concatenate([[0], np.flatnonzero(place[1:] != place[:-1]) + 1, borders - base, beyond - base])
            first = np.unique(marks[(marks >= 0) & (marks < len(place))])
            last = np.concatenate([first[1:] - 1, [len(place) - 1]])
            owner = np.searchsorted(borders, first + base, side="right") - 1
            inside = first + base + length <= borders[owner + 1]
            first, last, owner = first[inside], last[inside], owner[inside]
            raw = part.tobytes()
            ends = last + length
            region = [xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(first.tolist(), ends.tolist())]
            at = place[first]
            held.append(
                (
                    keys[row + owner],
                    signed(hashes[at]),
                    signed(np.array(region, dtype=np.uint64)),
                    first + base - borders[owner],
                    (ends - first).astype(np.int32),
                    (at - first).astype(np.int32),
                )
            )
            count += len(first)
            if count >= BATCH_ROWS:
                yield joined()
                held, count = [], 0
    if count:
        yield joined()


def _anchors(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _anchors_of(batch.column(0).to_numpy(), batch.column(1), length)

    return run


def _pieces(length: int):
    """Cut the listed regions of each text into aligned pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        core_size = length - BLOCK + 1
        for batch in batches:
            rows: list[tuple] = []
            keys, texts, listed = batch.columns
            fields = [listed.flatten().field(c).to_pylist() for c in ("n", "start", "size", "offset")]
            regions = zip(np.repeat(np.arange(len(listed)), listed.value_lengths().to_numpy()).tolist(), *fields)
            held, key, raw = -1, 0, b""
            for row, n, start, size, offset in regions:
                if row != held:
                    held, key, raw = row, keys[row].as_py(), texts[row].as_buffer().to_pybytes()
                anchor = start + offset
                last = start + size - length
                for block in range((anchor - last) // BLOCK, (anchor - start) // BLOCK + 1):
                    core_at = anchor - block * BLOCK
                    low = max(start, core_at - BLOCK + 1)
                    high = min(last, core_at)
                    left = raw[low:core_at]
                    right = raw[core_at + core_size : high + length]
                    core = xxhash.xxh3_128_intdigest(raw[core_at : core_at + core_size])
                    flank = xxhash.xxh3_64_intdigest(left + b"|" + right, seed=len(left))
                    rows.append((key, low, n, core >> 64, core & (2**64 - 1), flank, left, right))
            if rows:
                cols = list(zip(*rows))
                hashed = [pa.array(signed(np.array(cols[i], dtype=np.uint64))) for i in (3, 4, 5)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[pa.array(c, pa.int64()) for c in cols[:3]],
                        *hashed,
                        *[pa.array(c, pa.binary()) for c in cols[6:]],
                    ],
                    names=["key", "first", "n", "core", "core2", "flank", "left", "right"],
                )

    return run


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the runs of true values."""
    edges = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by core: the windows of each piece that another piece of its core has too."""

    def solve(held: list[tuple]) -> pa.RecordBatch:
        core, core2, flank, left, right = zip(*held)
        cores: dict[tuple, int] = {}
        groups = np.array([cores.setdefault(pair, len(cores)) for pair in zip(core, core2)])
        # The flanks of each row, its core between them as one symbol, and a symbol that ends the row.
        symbols = np.frombuffer(b"".join([a + b"\0" + b + b"\0" for a, b in zip(left, right)]), np.uint8).astype(np.int64)
        middle = np.array([len(a) for a in left])
        sizes = middle + np.array([len(b) for b in right]) + 2
        ends = np.cumsum(sizes)
        begins = ends - sizes
        symbols[begins + middle] = 256 + groups
        symbols[ends - 1] = -1 - np.arange(len(held))
        repeated = repeated_starts(symbols, BLOCK)
        # Only the first places of a row start a window.
        repeated &= np.arange(len(symbols)) < np.repeat(ends - BLOCK, sizes)
        low, high = _runs(repeated)
        row = np.searchsorted(begins, low, side="right") - 1
        return pa.RecordBatch.from_arrays(
            [
                *[pa.array(np.array(c, dtype=np.int64)[row]) for c in (core, core2, flank)],
                *[pa.array((c - begins[row]).astype(np.int32)) for c in (low, high)],
            ],
            names=["core", "core2", "flank", "low", "high"],
        )

    held: list[tuple] = []
    size = 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if size >= BLOCK_SYMBOLS and row[:2] != held[-1][:2]:
                yield solve(held)
                held, size = [], 0
            held.append(row)
            size += len(row[3]) + len(row[4]) + 2
    if held:
        yield solve(held)


def _met(rows: DataFrame, groups: DataFrame, key: str | list[str], size: str) -> DataFrame:
    """``rows`` joined to one row per key; a key of HOT_ROWS rows or more does not meet in one task."""
    return join_groups(rows, groups, key, size, hot_rows=HOT_ROWS, max_keys=1_000)


def repeat_spans(rows: DataFrame, length: int, staging: Staging, crowd: int = CROWD) -> DataFrame:
    """(key, low, high): byte ranges of the texts of ``rows`` (key, text) that repeat."""
    raw = F.col("text").cast("binary").alias("text")
    long_enough = rows.where(F.octet_length("text") >= length)
    anchors = staging.write(long_enough.select("key", raw).mapInArrow(_anchors(length), _ANCHOR))
    often = staging.write(anchors.groupBy("anchor").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1"))
    kept = staging.write(_met(anchors, often, "anchor", "_n").drop("_n"))
    staging.drop(anchors)
    # One place of each region; its size and the anchor's offset follow from its bytes.
    regions = kept.groupBy("anchor", "region").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("key").alias("key"),
        F.min_by("start", "key").alias("start"),
        F.min("size").alias("size"),
        F.min("offset").alias("offset"),
    )
    regions = staging.write(regions)
    varied = staging.write(regions.groupBy("anchor").agg(F.count(F.lit(1)).alias("_d")).where("_d > 1"))
    listed = (
        _met(regions, varied, "anchor", "_d")
        .select("key", F.struct("n", "start", "size", "offset").alias("r"))
        .groupBy("key")
        .agg(F.collect_list("r").alias("regions"))
    )
    pieces = staging.write(
        rows.join(listed, "key").select("key", raw, "regions").mapInArrow(_pieces(length), _PIECE)
    )
    flanks = pieces.groupBy("core", "core2", "flank").agg(F.sum("n").alias("n"))
    flanks = staging.write(flanks)
    shared = flanks.groupBy("core", "core2").agg(F.count(F.lit(1)).alias("d")).where("d > 1")
    # Pieces whose flanks are not all alike; the bytes of one of each kind.
    mixed = staging.write(
        pieces.join(shared, ["core", "core2"]).groupBy("core", "core2", "flank").agg(
            F.first("left").alias("left"), F.first("right").alias("right"), F.first("d").alias("d")
        )
    )
    compared = (
        mixed.where(F.col("d") <= crowd)
        .select("core", "core2", "flank", "left", "right")
        .repartition("core", "core2")
        .sortWithinPartitions("core", "core2")
        .mapInArrow(_compare, "core long, core2 long, flank long, low int, high int")
    )
    window = F.expr(f"length(left) + length(right) + 2 - {BLOCK}")
    windows = mixed.where(F.col("d") > crowd).withColumn("low", F.explode(F.sequence(F.lit(0), (window - 1).cast("int"))))
    windows = windows.withColumn(
        "text", F.xxhash64(F.expr("substring(left, low + 1)"), F.expr(f"substring(right, 1, {BLOCK} - 1 - length(left) + low)"))
    )
    same = windows.groupBy("core", "core2", "text").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    crowded = windows.join(same, ["core", "core2", "text"]).select("core", "core2", "flank", "low", (F.col("low") + 1).alias("high"))
    parts = compared.unionByName(crowded)
    whole = flanks.where("n > 1").select("core", "core2", "flank", F.lit(0).alias("low"), F.lit(BLOCK).alias("high"))
    found = staging.write(parts.unionByName(whole))
    # A region of one place stands where its pieces were cut; one of several repeats as a whole.
    within = pieces.where("n = 1").join(found, ["core", "core2", "flank"]).select(
        "key",
        (F.col("first") + F.col("low")).alias("low"),
        (F.col("first") + F.least("high", window) + (length - 1)).alias("high"),
    )
    several = regions.where("n > 1").select("anchor", "region", "n")
    entire = _met(kept.select("anchor", "region", "key", "start", "size"), several, ["anchor", "region"], "n")
    spans = within.unionByName(entire.select("key", F.col("start").alias("low"), (F.col("start") + F.col("size")).alias("high")))
    spans = staging.write(spans)
    staging.drop(kept, often, regions, varied, pieces, flanks, mixed, found)
    return spans


def _spans_within(rows: DataFrame, ranges: DataFrame, length: int, staging: Staging, crowd: int) -> DataFrame:
    """``repeat_spans`` where every repeated string is known to lie in ``ranges`` (key, ranges).

    Ranges with the same bytes repeat as a whole; one of them is searched, for the sake of the others.
    """
    least = F.expr(f"filter(ranges, r -> r.high - r.low >= {length})")
    cut = rows.join(ranges, "key").select("key", F.col("text").cast("binary").alias("text"), F.explode(least).alias("r"))
    size = (F.col("r.high") - F.col("r.low")).alias("size")
    part = F.substring("text", (F.col("r.low") + 1).cast("int"), size.cast("int")).alias("text")
    cut = cut.select("key", F.col("r.low").alias("low"), size, part)
    cut = staging.write(cut.withColumn("digest", F.sha2("text", 256)))
    kinds = cut.groupBy("digest").agg(
        F.count(F.lit(1)).alias("n"), F.min("key").alias("of"), F.min_by("low", "key").alias("base"), F.first("text").alias("text")
    )
    kinds = staging.write(kinds.withColumn("key", F.monotonically_increasing_id()))
    found = repeat_spans(kinds.select("key", "text"), length, staging, crowd)
    single = found.join(kinds.where("n = 1").select("key", "of", "base"), "key").select(
        F.col("of").alias("key"), (F.col("base") + F.col("low")).alias("low"), (F.col("base") + F.col("high")).alias("high")
    )
    several = _met(cut.select("digest", "key", "low", "size"), kinds.where("n > 1").select("digest", "n"), "digest", "n")
    spans = single.unionByName(several.select("key", "low", (F.col("low") + F.col("size")).alias("high")))
    spans = staging.write(spans)
    staging.drop(cut, kinds, found)
    return spans


def _gathered(spans: DataFrame, staging: Staging) -> DataFrame:
    """(key, ranges): the ``spans`` of each text that has some."""
    # Neighbouring ranges of a document are merged before they are gathered.
    ordered = Window.partitionBy("key").orderBy("low", "high")
    reach = F.max("high").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    fresh = spans.withColumn("_new", (reach.isNull() | (F.col("low") > reach)).cast("int"))
    runs = fresh.withColumn("_run", F.sum("_new").over(ordered)).groupBy("key", "_run")
    runs = runs.agg(F.min("low").alias("low"), F.max("high").alias("high"))
    gathered = staging.write(runs.groupBy("key").agg(F.collect_list(F.struct("low", "high")).alias("ranges")))
    staging.drop(spans)
    return gathered


def _without(raw: bytes, ranges: list[dict] | None, spare_words: int) -> tuple[bytes, int, int]:
    """``raw`` without its ranges, the bytes and the ranges removed; a range under LENGTH bytes
    with at most ``spare_words`` words stays."""
    kept, done, removed, count = [], 0, 0, 0
    merged: list[list[int]] = []
    for low, high in sorted((r["low"], r["high"]) for r in ranges or []):
        if merged and low <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], high)
        else:
            merged.append([low, high])
    for low, high in merged:
        if spare_words and high - low < LENGTH and len(raw[low:high].split()) <= spare_words:
            continue
        kept.append(raw[done:low])
        done = high
        removed += high - low
        count += 1
    return b"".join([*kept, raw[done:]]), removed, count


_KEPT = "kept_text string, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
_PASSAGES = "passage_text string, n_passage_removed long, n_passages long"


def _cut(batches: Iterator[pa.RecordBatch], spare_words: int) -> Iterator[pa.RecordBatch]:
    """Texts without their ranges and, where a second list of ranges follows, without their passages."""
    kept = pa.schema([("kept_text", pa.string()), *[(c, pa.int64()) for c in ("n_bytes", "n_removed", "n_spans")], ("kept_sha256", pa.string())])
    passages = pa.schema([("passage_text", pa.string()), ("n_passage_removed", pa.int64()), ("n_passages", pa.int64())])
    for batch in batches:
        row, texts, spans, *listed = batch.columns
        raws = [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in texts]
        out = []
        for raw, ranges in zip(raws, spans):
            rest, removed, count = _without(raw, ranges.as_py(), spare_words)
            out.append((rest.decode("utf-8", "ignore"), len(raw), removed, count, hashlib.sha256(rest).hexdigest()))
        columns = {"row": row} | _columns(out, kept)
        for found in listed:
            out = []
            for raw, ranges in zip(raws, found):
                rest, removed, count = _without(raw, ranges.as_py(), PASSAGE_WORDS)
                out.append((rest.decode("utf-8", "ignore"), removed, count))
            columns |= _columns(out, passages)
        yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _columns(rows: list[tuple], schema: pa.Schema) -> dict[str, pa.Array]:
    values = zip(*rows) if rows else [[]] * len(schema)
    return {field.name: pa.array(v, field.type) for field, v in zip(schema, values)}


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    crowd: int = CROWD,
    spare_words: int = 0,
    passages: bool = False,
) -> DataFrame:
    """One row per document: ``row`` (its other columns), ``kept_text``, ``n_bytes``,
    ``n_removed``, ``n_spans`` and ``kept_sha256`` of the bytes left.

    ``kept_text`` drops the fragment where a cut splits a character. With ``spare_words``, passages
    under LENGTH bytes are removed only if they hold more words than that. With ``passages``, a second
    search follows, and further columns give the text without its repeated passages of over
    PASSAGE_WORDS words (found by strings of PASSAGE_BYTES): ``passage_text``, ``n_passage_removed``
    (bytes) and ``n_passages``.
    """
    staging = Staging(docs.sparkSession, "repeats")
    source, _ = keyed(docs, id_col, "key", staging)
    text = F.col("row").getField(text_col)
    rows = source.select("key", text.alias("text"))
    lengths = {"spans": length} | ({"passages": PASSAGE_BYTES} if passages else {})
    lists: dict[str, DataFrame] = {}
    shorter = None
    for name, size in sorted(lengths.items(), key=lambda x: x[1]):
        if shorter is None:
            spans = repeat_spans(rows, size, staging, crowd)
        else:
            spans = _spans_within(rows, shorter, size, staging, crowd)
        shorter = lists[name] = _gathered(spans, staging)
    others = [c for c in docs.columns if c != text_col]
    slim = F.struct(*[F.col("row").getField(c).alias(c) for c in others]) if others else F.struct(F.lit(0).alias("_"))
    joined = source
    for name, found in lists.items():
        joined = joined.join(found.withColumnRenamed("ranges", name), "key", "left")
    joined = joined.select(slim.alias("row"), F.encode(text, "UTF-8").alias("text"), *lengths)
    kind = joined.schema["row"].dataType.simpleString()
    returned = ", ".join([f"row {kind}", _KEPT, *([_PASSAGES] if passages else [])])
    return joined.mapInArrow(partial(_cut, spare_words=spare_words), returned)
