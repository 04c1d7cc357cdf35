"""SimHash as a Spark aggregation: shingles exploded, votes summed per bit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions.hashing import md5_hash64
from quern.functions.text import shingles, tokenize

_LANES = 32
_LOW = 0xFFFFFFFF


def _bit_totals(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, n, ones): shingle count and, per bit, how many hashes set it.

    Two bits share one 64-bit sum (bit k in the low half, bit k+32 in the high
    half), so 32 sums count all 64 bits. A text's shingles come from one row,
    so partial aggregation leaves one row per text for the shuffle. A text
    without tokens keeps its key, with ``n`` 0.
    """
    hashes = docs.select(key, F.explode_outer(shingles(tokenize(F.col(text)))).alias("_shingle")).select(
        key, md5_hash64(F.col("_shingle")).alias("_h")
    )
    pair = F.lit((1 << 32) | 1).cast("long")
    sums = [
        F.sum(F.shiftrightunsigned("_h", k).bitwiseAND(pair)).alias(f"_l{k}") for k in range(_LANES)
    ]
    packed = hashes.groupBy(key).agg(F.count("_h").alias("n"), *sums)
    low = [F.col(f"_l{k}").bitwiseAND(F.lit(_LOW).cast("long")) for k in range(_LANES)]
    high = [F.shiftrightunsigned(f"_l{k}", 32) for k in range(_LANES)]
    return packed.select(key, "n", F.array(*low, *high).alias("ones"))


def simhash_votes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, bit, votes): +1 per set bit and -1 per clear bit over all shingles."""
    totals = _bit_totals(docs, key, text).where("n > 0")
    return totals.select(key, "n", F.posexplode("ones").alias("bit", "set")).select(
        key, "bit", (2 * F.col("set") - F.col("n")).alias("votes")
    )


def simhash64_md5(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint) from built-ins only, one row per key; texts without tokens get 0."""
    totals = _bit_totals(docs, key, text)
    bits = [
        F.when(2 * F.col("ones")[b] >= F.col("n"), F.shiftleft(F.lit(1).cast("long"), b)).otherwise(
            F.lit(0).cast("long")
        )
        for b in range(64)
    ]
    packed = bits[0]
    for bit in bits[1:]:
        packed = packed.bitwiseOR(bit)
    return totals.select(key, F.when(F.col("n") > 0, packed).otherwise(F.lit(0)).alias("fingerprint"))
