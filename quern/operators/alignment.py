"""Ordered alignment of answers: longest common subsequences, ROUGE-L, best context of each sentence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.text import tokenize

from .evals import f1

# Tokens of the second text per 64-bit word: one bit holds the carry, one the sign.
BITS = 62
FULL = (1 << BITS) - 1


def lcs_length(left: Column, right: Column) -> Column:
    """Length of the longest common subsequence of two token arrays; 0 where one is empty.

    A bit-parallel fold: every BITS tokens of ``right`` are a word of bits, and each token of
    ``left`` updates the words by an addition with carry. A row holds one word per BITS tokens
    beside its arrays, so memory is linear.
    """
    parts = F.ceil(F.size(right) / F.lit(BITS)).cast("int")
    chunks = F.transform(
        F.sequence(F.lit(0), F.greatest(parts, F.lit(1)) - 1), lambda w: F.slice(right, w * BITS + 1, F.lit(BITS))
    )
    full, zero = F.lit(FULL), F.lit(0).cast("long")

    def places(chunk: Column, token: Column) -> Column:
        """Bits of the places of ``token``, the first one lowest."""
        return F.aggregate(F.reverse(chunk), zero, lambda bits, t: bits * 2 + F.when(t == token, 1).otherwise(0))

    def step(words: Column, token: Column) -> Column:
        def word(state: Column, cell: Column) -> Column:
            held = cell["word"]
            met = F.when(F.array_contains(cell["chunk"], token), places(cell["chunk"], token)).otherwise(zero)
            added = held + held.bitwiseAND(met) + state["carry"]
            after = added.bitwiseAND(full).bitwiseOR(held.bitwiseAND(full - met))
            return F.struct(
                F.shiftright(added, BITS).alias("carry"), F.concat(state["words"], F.array(after)).alias("words")
            )

        start = F.struct(zero.alias("carry"), F.lit([]).cast("array<bigint>").alias("words"))
        cells = F.zip_with(words, chunks, lambda w, c: F.struct(w.alias("word"), c.alias("chunk")))
        return F.aggregate(cells, start, word)["words"]

    words = F.aggregate(left, F.transform(chunks, lambda c: full), step)
    return F.aggregate(words, zero, lambda n, w: n + BITS - F.bit_count(w))


def rouge_l(rows: DataFrame, key: str, wanted: str, answer: str) -> DataFrame:
    """(key, n_common, precision, recall, rouge_l) of an answer against the wanted text, by tokens in order.

    Null texts count as empty; shares of a text without tokens are 0.
    """
    tokens = rows.select(
        key, *[tokenize(F.coalesce(F.col(c), F.lit(""))).alias(n) for c, n in ((answer, "_a"), (wanted, "_w"))]
    )
    counted = tokens.select(key, lcs_length(F.col("_a"), F.col("_w")).alias("n_common"), F.size("_a").alias("_n"), F.size("_w").alias("_m"))

    def share(n: str) -> Column:
        return F.coalesce(F.try_divide("n_common", n), F.lit(0.0))

    score = f1(F.col("n_common"), F.col("_n"), F.col("_m"))
    return counted.select(key, "n_common", share("_n").alias("precision"), share("_m").alias("recall"), score.alias("rouge_l"))


def best_contexts(rows: DataFrame, key: str, contexts: str, answer: str) -> DataFrame:
    """(key, sentence, n_tokens, context, n_common): for each sentence of the answer the context that holds most of it in order.

    ``contexts`` is an array of texts. Sentences end at ``.``, ``!``, ``?`` or a line end; those
    without tokens are left out and not numbered. Ties go to the first context; context is null,
    n_common 0, where none holds a token of the sentence. Null texts count as empty.
    """
    sentences = F.transform(F.split(F.coalesce(F.col(answer), F.lit("")), r"[.!?\n]+"), tokenize)
    held = F.transform(
        F.coalesce(F.col(contexts), F.lit([]).cast("array<string>")), lambda c: tokenize(F.coalesce(c, F.lit("")))
    )
    parts = rows.select(key, held.alias("_c"), F.posexplode(F.filter(sentences, lambda s: F.size(s) > 0)).alias("sentence", "_s"))
    # One row per sentence and context: the folds are dealt, not nested.
    pairs = parts.select(key, "sentence", "_s", F.posexplode_outer("_c").alias("context", "_t"))
    common = F.when(F.col("_t").isNull(), F.lit(0).cast("long")).otherwise(lcs_length(F.col("_s"), F.col("_t")))
    scored = pairs.select(key, "sentence", F.size("_s").alias("n_tokens"), "context", common.alias("n_common"))
    best = scored.groupBy(key, "sentence", "n_tokens").agg(F.max(F.struct("n_common", (-F.col("context")).alias("c"))).alias("b"))
    found = F.when(F.col("b.n_common") > 0, -F.col("b.c"))
    return best.select(key, "sentence", "n_tokens", found.alias("context"), "b.n_common")
