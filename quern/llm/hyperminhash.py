"""Near-duplicate components by HyperMinHash.

A document's set of distinct word shingles is hashed into REGISTERS buckets. A
register keeps the smallest value of its bucket in compressed form: the number of
leading zeros and the next MANTISSA bits. Bands of compressed registers give the
candidate buckets; with 40 bands of 5, two sets at the threshold of 0.8 share no
band with a probability of about one in ten million.

1. Documents with equal sets fold to one node.
2. Stars. A bucket's head is the member that shares the most with others; every node is
   paired with one head, that of most of its buckets, and the pair is checked on the full
   shingle sets (a head with many members is dealt to many tasks). Connected components
   follow; a second star starts from buckets that still hold several components.
3. Cells. In such buckets every member outside the largest component is compared with all
   members of other components, in cells of bounded size, a pair only in the first band it
   shares. A pair passes by set size, by the collision-corrected estimate (five standard
   errors below the threshold) and by an exact upper bound on the common shingles from
   hashed bit sets. Only members with such a pair get their full sets; their cell checks
   pairs that are not connected yet and emits the links that connect something.

So components equal those of all candidate pairs. A star gives one pair a node, and a cell
fewer links than it has rows; comparisons of sketches within a cell are quadratic in its
rows. Sets are sets of 64-bit hashes.

Defined results: null text counts as empty; a text with fewer words than a shingle
is one shingle of all its words; texts without words link with nothing; rows with
equal ids are documents of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from quern.llm.common import Staging, components, keyed
from quern.llm.kernels import mix, prefix_sums, range_hashes, signed, text_slices
from quern.operators.skew import join_groups

SHINGLE = 4
THRESHOLD = 80  # per cent
BANDS = 40
BAND_REGISTERS = 5
REGISTERS = BANDS * BAND_REGISTERS
MANTISSA = 10
STARS = 2
# A pair of a star shares this many bands; pairs with fewer are left to the cells.
STAR_BANDS = 3
# Members of a head that one task checks, and members of a bucket on a side of a cell.
HEAD_ROWS = 512
CELL = 1_024
_EMPTY = np.uint16(0xFFFF)
# Expected share of equal registers in disjoint sets of equal size, times 2**MANTISSA.
_COLLISION = 0.33984


def shingle_hashes(data: np.ndarray, borders: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every shingle of the texts, repeats included, in text order."""
    lower = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    blank = (lower == 32) | ((lower >= 9) & (lower <= 13))
    word = ~blank
    opens, closes = word.copy(), word.copy()
    opens[1:] &= blank[:-1]
    closes[:-1] &= blank[1:]
    inner = borders[(borders > 0) & (borders < len(data))]
    opens[inner] = word[inner]
    closes[inner - 1] = word[inner - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    words = range_hashes(prefix_sums(lower), starts, ends)
    row = np.searchsorted(borders, starts, side="right") - 1
    after = np.searchsorted(row, np.arange(len(borders) - 1), side="right")
    count = np.diff(np.concatenate([[0], after]))
    # Places from which a shingle starts: all but the last size - 1 of a row, and
    # the first word of a shorter row.
    at = np.arange(len(words))
    left = after[row] - at
    begin = (left >= size) | ((count[row] < size) & (left == count[row]))
    at, row, left = at[begin], row[begin], left[begin]
    total = np.zeros(len(at), dtype=np.uint64)
    for i in range(size):
        inside = i < left
        part = np.where(inside, words[np.minimum(at + i, len(words) - 1)], np.uint64(0))
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + part + np.uint64(i + 1)) if i else mix(part + np.uint64(1))
    return total, row


def compress(values: np.ndarray) -> np.ndarray:
    """Leading zeros and mantissa bits of non-zero 64-bit values, in 16 bits; larger values never give larger zeros."""
    values = np.maximum(values, np.uint64(1))
    _, exponent = np.frexp((values >> np.uint64(11)).astype(np.float64))
    top = np.where(values >> np.uint64(11) > 0, exponent + 10, 10).astype(np.int64)
    shift = np.maximum(top - MANTISSA, 0).astype(np.uint64)
    bits = (values >> shift) & np.uint64((1 << MANTISSA) - 1)
    return ((63 - top).astype(np.uint16) << np.uint16(MANTISSA)) | bits.astype(np.uint16)


def _sketches(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = batch.column(0).to_numpy()
        for first, after, data, borders in text_slices(batch.column(1)):
            rows = after - first
            hashes, row = shingle_hashes(data, borders, shingle)
            values = mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5))
            lowest = np.full(rows * REGISTERS, np.iinfo(np.uint64).max, dtype=np.uint64)
            np.minimum.at(lowest, row * REGISTERS + (hashes % np.uint64(REGISTERS)).astype(np.int64), values)
            used = lowest != np.iinfo(np.uint64).max
            registers = np.where(used, compress(lowest), _EMPTY).reshape(rows, REGISTERS)
            edges = np.searchsorted(row, np.arange(rows + 1))
            counts, digests, digests2 = (np.zeros(rows, dtype=np.uint64) for _ in range(3))
            for i in range(rows):
                own = np.unique(hashes[edges[i] : edges[i + 1]])
                counts[i] = len(own)
                digests[i] = own.sum(dtype=np.uint64)
                digests2[i] = mix(own + np.uint64(7)).sum(dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys[first:after]),
                    pa.array(counts.astype(np.int64)),
                    pa.array(signed(digests)),
                    pa.array(signed(digests2)),
                    pa.array([r.tobytes() for r in registers], pa.binary()),
                ],
                names=["key", "n", "digest", "digest2", "registers"],
            )


def _sets(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = batch.column(0).to_numpy()
        for first, after, data, borders in text_slices(batch.column(1)):
            hashes, row = shingle_hashes(data, borders, shingle)
            edges = np.searchsorted(row, np.arange(after - first + 1))
            sets = [np.unique(hashes[edges[i] : edges[i + 1]]) for i in range(after - first)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys[first:after]),
                    pa.array([own.tobytes() for own in sets], pa.binary()),
                    pa.array([bit_set(own).tobytes() for own in sets], pa.binary()),
                ],
                names=["node", "hashes", "bits"],
            )


def bit_set(hashes: np.ndarray) -> np.ndarray:
    """Bytes of a bit set with 8 to 16 bits per hash; halving it means joining its halves."""
    places = max(256, 8 << max(len(hashes) - 1, 0).bit_length())
    bits = np.zeros(places, dtype=np.uint8)
    bits[(hashes >> np.uint64(3)) % np.uint64(places)] = 1
    return np.packbits(bits)


def common_bound(bits: np.ndarray, sizes: np.ndarray, other: np.ndarray, other_size: int) -> np.ndarray:
    """Upper bounds on the number of common hashes of many sets with one.

    A bit set on one side only stands for at least one hash the other side lacks.
    """
    alone = np.bitwise_count(bits & ~other).sum(axis=1, dtype=np.int64)
    other_alone = np.bitwise_count(other & ~bits).sum(axis=1, dtype=np.int64)
    return np.minimum(sizes - alone, other_size - other_alone)


def estimate(registers: np.ndarray, sizes: np.ndarray, other: np.ndarray, other_size: int) -> tuple[np.ndarray, np.ndarray]:
    """Collision-corrected Jaccard estimates of many sketches against one, and their standard errors at the threshold."""
    either = (registers != _EMPTY) | (other != _EMPTY)
    used = np.maximum(either.sum(axis=1), 1)
    equal = ((registers == other) & either).sum(axis=1)
    ratio = sizes / other_size
    expected = used * _COLLISION * 2.0**-MANTISSA * 4 * ratio / (1 + ratio) ** 2
    limit = THRESHOLD / 100
    return np.maximum(equal - expected, 0) / used, np.sqrt(limit * (1 - limit) / used)


def linked(one: np.ndarray, other: np.ndarray) -> bool:
    """Whether two sorted sets reach the threshold."""
    small, large = sorted((len(one), len(other)))
    if small * 100 < large * THRESHOLD:
        return False
    common = len(np.intersect1d(one, other, assume_unique=True))
    return common * 100 >= (small + large - common) * THRESHOLD


def _star_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (a, salt, b, hashes) sorted by head, the head's own row (b is null) first: its links."""
    own = np.zeros(0, np.uint64)
    for batch in batches:
        left, right = [], []
        for a, _, b, hashes in zip(*(c.to_pylist() for c in batch.columns)):
            found = np.frombuffer(hashes, dtype=np.uint64)
            if b is None:
                own = found
            elif linked(own, found):
                left.append(a)
                right.append(b)
        yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])


def _likely(held: list[tuple]) -> Iterator[tuple[int, np.ndarray]]:
    """(row, rows it may link with) of a cell whose rows (see _CELL) are sorted by set size."""
    nodes, parts, sizes, place = (np.array([r[i] for r in held], dtype=np.int64) for i in (2, 3, 4, 9))
    left, right, small = (np.array([r[i] for r in held], dtype=bool) for i in (6, 7, 8))
    sketches = np.frombuffer(b"".join(r[5] for r in held), dtype=np.uint16).reshape(len(held), REGISTERS)
    bands = sketches.reshape(len(held), BANDS, BAND_REGISTERS)
    widths = np.array([len(r[10]) for r in held])
    # Bit sets by width; each also at half its width, for partners of the lower width.
    levels: dict[int, tuple[int, np.ndarray]] = {}
    for width in np.unique(widths).tolist():
        low, high = np.searchsorted(widths, width, side="left"), np.searchsorted(widths, 2 * width, side="right")
        rows = []
        for r in held[low:high]:
            own = np.frombuffer(r[10], dtype=np.uint64)
            rows.append(own if len(r[10]) == width else own[: width // 8] | own[width // 8 :])
        levels[width] = low, np.array(rows)
    for i in np.flatnonzero(left).tolist():
        least = int(np.searchsorted(sizes, sizes[i] * THRESHOLD / 100, side="left"))
        upto = int(np.searchsorted(sizes, sizes[i] * 100 / THRESHOLD, side="right"))
        span = slice(least, upto)
        # A pair outside the largest component has a cell for either order.
        at = np.flatnonzero(right[span] & (parts[span] != parts[i]) & (~small[span] | (nodes[span] > nodes[i]))) + least
        if not len(at):
            continue
        near, error = estimate(sketches[at], sizes[at], sketches[i], sizes[i])
        at = at[near >= THRESHOLD / 100 - 5 * error]
        if not len(at):
            continue
        same = (bands[at] == bands[i]).all(axis=2) & (bands[i] != _EMPTY).any(axis=1)
        at = at[same.any(axis=1) & (same.argmax(axis=1) == place[i])]
        passed = []
        for width in np.unique(np.minimum(widths[at], widths[i])).tolist():
            low, bits = levels[width]
            part = at[np.minimum(widths[at], widths[i]) == width]
            most = common_bound(bits[part - low], sizes[part], bits[i - low], sizes[i])
            passed.append(part[most * 100 >= (sizes[part] + sizes[i] - most) * THRESHOLD])
        if passed and len(found := np.concatenate(passed)):
            yield i, found


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The rows of each cell, by set size; input sorted by cell."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and row[:2] != held[0][:2]:
                yield sorted(held, key=lambda r: (r[4], r[2]))
                held = []
            held.append(row)
    if held:
        yield sorted(held, key=lambda r: (r[4], r[2]))


_CELL = "band long, cell long, node long, part long, n long, registers binary, left boolean, right boolean, small boolean, place int"


def _flagged(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The rows of each cell that may link with another one."""
    for held in _cells(batches):
        some: set[int] = set()
        for i, at in _likely(held):
            some.add(i)
            some.update(at.tolist())
        cols = list(zip(*(held[i][:10] for i in sorted(some)))) or [[]] * 10
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


def _connecting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of _CELL, bits and full sets: the links of each cell that connect two of its components."""
    for held in _cells(batches):
        sets = [np.frombuffer(r[11], dtype=np.uint64) for r in held]
        root: dict[int, int] = {}

        def find(part: int) -> int:
            while root.get(part, part) != part:
                root[part] = part = root.get(root[part], root[part])
            return part

        out = []
        for i, at in _likely(held):
            for j in at.tolist():
                p, q = find(held[i][3]), find(held[j][3])
                if p != q and linked(sets[i], sets[j]):
                    root[p] = q
                    out.append((min(held[i][2], held[j][2]), max(held[i][2], held[j][2])))
        a, b = zip(*out) if out else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _star_pairs(placed: DataFrame, tried: DataFrame | None) -> DataFrame:
    """(a, b): every node b with the head a that most of its buckets have, of another component."""
    by_part = placed.groupBy("band", "part").agg(F.max(F.struct("weight", (-F.col("node")).alias("minus"), "n")).alias("h"))
    heads = by_part.groupBy("band").agg(F.count(F.lit(1)).alias("_parts"), F.max(F.struct("h", "part")).alias("h")).where("_parts > 1")
    heads = heads.select("band", F.col("h.h.weight").alias("_w"), (-F.col("h.h.minus")).alias("a"), F.col("h.h.n").alias("_n"), F.col("h.part").alias("_p"))
    near = (F.col("n") * 100 >= F.col("_n") * THRESHOLD) & (F.col("_n") * 100 >= F.col("n") * THRESHOLD)
    met = placed.join(heads, "band").where((F.col("part") != F.col("_p")) & near)
    met = met.groupBy("a", F.col("node").alias("b")).agg(F.count(F.lit(1)).alias("_c"), F.any_value("_w").alias("_w"))
    met = met.where(F.col("_c") >= STAR_BANDS)
    if tried is not None:
        met = met.join(tried, ["a", "b"], "left_anti")
    best = met.groupBy("b").agg(F.max(F.struct("_c", "_w", (-F.col("a")).alias("minus"))).alias("h"))
    return best.select((-F.col("h.minus")).alias("a"), "b")


def _star_checked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The written ``pairs`` (a, b) that link on full sets. A head's members are dealt HEAD_ROWS to a task."""
    shares = F.ceil(F.col("size") / HEAD_ROWS)
    heads = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("size"))
    placed = join_groups(pairs, heads, "a", "size").select("a", "b", F.pmod(F.xxhash64("b"), shares).alias("salt"))
    members = placed.join(sets.select(F.col("node").alias("b"), "hashes").hint("merge"), "b").select("a", "salt", "b", "hashes")
    own = heads.join(sets.select(F.col("node").alias("a"), "hashes").hint("merge"), "a")
    own = own.select("a", F.explode(F.sequence(F.lit(0).cast("long"), shares - 1)).alias("salt"), F.lit(None).cast("long").alias("b"), "hashes")
    dealt = members.unionByName(own).repartition("a", "salt").sortWithinPartitions("a", "salt", "b")
    return dealt.mapInArrow(_star_links, "a long, b long")


def _dealt(placed: DataFrame) -> DataFrame:
    """Members of buckets with several components, in cells: (band, cell, node, part, n, left, right, small, place).

    ``small`` members stand outside the bucket's largest component. In a cell a part of
    those (left) meets a part of all members (right).
    """
    by_part = placed.groupBy("band", "part").agg(F.count(F.lit(1)).alias("c"))
    sizes = by_part.groupBy("band").agg(F.sum("c").alias("size"), F.count(F.lit(1)).alias("_parts"), F.max(F.struct("c", "part")).alias("major"))
    sizes = sizes.where("_parts > 1").select(
        "band",
        F.col("major.part").alias("major"),
        F.ceil((F.col("size") - F.col("major.c")) / CELL).alias("ci"),
        F.ceil(F.col("size") / CELL).alias("cj"),
    )
    met = placed.join(sizes, "band").withColumn("small", F.col("part") != F.col("major"))
    met = met.withColumns({"i": F.pmod(F.xxhash64("node", F.lit(1)), "ci"), "j": F.pmod(F.xxhash64("node"), "cj")})
    sides = F.expr(
        "CASE WHEN cj = 1 THEN array(struct(0L AS cell, small AS left, true AS right)) ELSE concat("
        "transform(sequence(0L, ci - 1), x -> struct(x * cj + j AS cell, false AS left, true AS right)), "
        "CASE WHEN small THEN transform(sequence(0L, cj - 1), x -> struct(i * cj + x AS cell, true AS left, false AS right)) "
        "ELSE array() END) END"
    )
    return met.select("band", F.explode(sides).alias("s"), "node", "part", "n", "small", "place").select(
        "band", "s.cell", "node", "part", "n", "s.left", "s.right", "small", "place"
    )


def near_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE
) -> tuple[DataFrame, DataFrame]:
    """(rows, source): key, id, n_shingles, component_id and kept per document; key and input row."""
    staging = Staging(docs.sparkSession, "hyperminhash")
    source, by_id = keyed(docs, id_col, "key", staging)
    texts = source.select("key", F.coalesce(F.col("row").getField(text_col), F.lit("")).alias("text"))
    sketches = staging.write(
        texts.mapInArrow(partial(_sketches, shingle=shingle), "key long, n long, digest long, digest2 long, registers binary")
    )
    nodes = staging.write(
        sketches.where("n > 0").groupBy("n", "digest", "digest2").agg(F.min("key").alias("node"), F.first("registers").alias("registers"))
    )
    band = F.expr(
        f"transform(sequence(0, {BANDS - 1}), i -> substring(registers, i * {2 * BAND_REGISTERS} + 1, {2 * BAND_REGISTERS}))"
    )
    unused = F.lit(b"\xff" * (2 * BAND_REGISTERS))
    banded = nodes.select("node", "n", F.posexplode(band).alias("_i", "_part")).where(F.col("_part") != unused)
    banded = banded.select("node", "n", F.col("_i").alias("place"), F.xxhash64("_i", "_part").alias("band"))
    shared = banded.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = staging.write(banded.join(shared, "band"))
    weights = members.groupBy("node").agg(F.sum(F.round(F.log2("size") * 1024).cast("long")).alias("weight"))
    sets = texts.join(weights.select(F.col("node").alias("key")).hint("merge"), "key", "left_semi").select("key", "text")
    sets = staging.write(sets.mapInArrow(partial(_sets, shingle=shingle), "node long, hashes binary, bits binary"))
    members = staging.write(members.drop("size").join(weights, "node"))
    placed, tried = members.withColumn("part", F.col("node")), None
    links = docs.sparkSession.createDataFrame([], "a long, b long")
    for _ in range(STARS):
        pairs = staging.write(_star_pairs(placed, tried))
        links = links.unionByName(staging.write(_star_checked(pairs, sets)))
        tried = pairs if tried is None else tried.unionByName(pairs)
        parts = components(links, staging)
        placed = members.join(parts.withColumnRenamed("component", "part"), "node", "left")
        placed = placed.withColumn("part", F.coalesce("part", "node"))
    known = sets.select("node", "bits").join(nodes.select("node", "registers").hint("merge"), "node")
    cells = _dealt(placed).join(known.hint("merge"), "node").select(*(c.split()[0] for c in _CELL.split(", ")), "bits")
    cells = cells.repartition("band", "cell").sortWithinPartitions("band", "cell")
    schema = to_arrow_schema(StructType.fromDDL(_CELL))
    flagged = staging.write(cells.mapInArrow(partial(_flagged, schema=schema), _CELL))
    whole = flagged.join(sets.select("node", "bits", "hashes").hint("merge"), "node").select(*flagged.columns, "bits", "hashes")
    whole = whole.repartition("band", "cell").sortWithinPartitions("band", "cell")
    links = links.unionByName(staging.write(whole.mapInArrow(_connecting, "a long, b long")))
    parts = components(links, staging)
    # Node, then every row of its set.
    of_node = nodes.select("n", "digest", "digest2", "node").join(parts, "node", "left")
    of_node = of_node.select("n", "digest", "digest2", F.coalesce("component", "node").alias("component"))
    rows = sketches.select("key", "n", "digest", "digest2").join(of_node, ["n", "digest", "digest2"], "left")
    rows = rows.select("key", F.col("n").alias("n_shingles"), F.coalesce("component", "key").alias("component"))
    if by_id:
        rows = rows.select("key", F.col("key").alias("id"), "n_shingles", F.col("component").alias("component_id"), (F.col("key") == F.col("component")).alias("kept"))
        return rows, source
    ids = source.select("key", F.col("row").getField(id_col).alias("id"))
    rows = staging.write(rows.join(ids, "key"))
    least = rows.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("head"))
    rows = rows.join(least, "component").select(
        "key", "id", "n_shingles", F.col("head.id").alias("component_id"), (F.col("key") == F.col("head.key")).alias("kept")
    )
    return rows, source


def drop_near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """One row of ``docs`` per component (that with the smallest id), with all its columns."""
    rows, source = near_components(docs, id_col, text_col, shingle)
    return source.join(rows.where("kept").select("key"), "key").select("row.*")
