"""Answer evaluation: token overlap, F1, exact match, preferences, regressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.text import strip_text, tokenize

from .filters import preference_filter


def exact_match(candidate: Column, expected: Column) -> Column:
    """Equal without outer whitespace and case; two empty texts match."""
    return F.lower(strip_text(candidate)) == F.lower(strip_text(expected))


def f1(overlap: Column, predicted: Column, wanted: Column) -> Column:
    """Harmonic mean of precision and recall; 0 without any overlap."""
    precision = overlap / predicted
    recall = overlap / wanted
    return F.when(overlap > 0, 2 * precision * recall / (precision + recall)).otherwise(F.lit(0.0))


def token_overlaps(rows: DataFrame, key: str, wanted: str, answers: list[str]) -> DataFrame:
    """(key, n_<wanted>, and per answer n_<answer>, overlap_<answer>).

    The overlap is the size of the multiset intersection of an answer's tokens
    with the wanted ones. Tokens are counted per (key, token), which spreads a
    long text over tasks; a row without any token keeps its key.
    """
    sides = [wanted, *answers]

    def tag(number: int, side: str) -> Column:
        words = tokenize(F.coalesce(F.col(side), F.lit("")))
        return F.transform(
            words, lambda t: F.struct(F.lit(number).alias("side"), t.alias("token"))
        )

    tagged = F.concat(*[tag(i, side) for i, side in enumerate(sides)])
    words = rows.select(key, F.explode_outer(tagged).alias("w")).select(key, "w.side", "w.token")
    bags = words.groupBy(key, "token").agg(
        *[F.count_if(F.col("side") == i).alias(side) for i, side in enumerate(sides)]
    )
    sums = [F.sum(side).alias(f"n_{side}") for side in sides]
    common = [F.sum(F.least(answer, wanted)).alias(f"overlap_{answer}") for answer in answers]
    return bags.groupBy(key).agg(*sums, *common)


def token_f1(rows: DataFrame, key: str, wanted: str, answer: str) -> DataFrame:
    """(key, token_f1) of one answer column against one wanted column."""
    counted = token_overlaps(rows, key, wanted, [answer])
    score = f1(F.col(f"overlap_{answer}"), F.col(f"n_{answer}"), F.col(f"n_{wanted}"))
    return counted.select(key, score.alias("token_f1"))


def eval_case_scores(cases: DataFrame, order: str = "seq") -> DataFrame:
    """Per case: id, both F1 scores, exact and regression flags, preference.

    ``order`` is a unique column. Null fields count as empty texts, a null id as
    'unknown'.
    """
    narrow = cases.select(
        order,
        F.coalesce(F.col("id").cast("string"), F.lit("unknown")).alias("id"),
        exact_match(
            F.coalesce("candidate", F.lit("")), F.coalesce("expected", F.lit(""))
        ).alias("exact_match"),
        "human_preference",
    )
    counted = token_overlaps(cases, order, "expected", ["candidate", "baseline"])
    scores = counted.select(
        order,
        f1(F.col("overlap_candidate"), F.col("n_candidate"), F.col("n_expected")).alias("candidate_f1"),
        f1(F.col("overlap_baseline"), F.col("n_baseline"), F.col("n_expected")).alias("baseline_f1"),
    )
    return narrow.join(scores, order).withColumn("regressed", is_regression())


def is_regression() -> Column:
    return F.col("candidate_f1") < F.col("baseline_f1")


def eval_report(scores: DataFrame) -> DataFrame:
    """One row of rates over all cases; 0.0 when there are none."""

    def mean(value: Column) -> Column:
        return F.coalesce(F.avg(value), F.lit(0.0))

    return scores.agg(
        F.count(F.lit(1)).alias("cases"),
        mean(F.col("exact_match").cast("double")).alias("candidate_exact_match"),
        mean(F.col("candidate_f1")).alias("candidate_token_f1"),
        mean(F.col("baseline_f1")).alias("baseline_token_f1"),
    )


def preference_counts(cases: DataFrame, label: str = "human_preference") -> DataFrame:
    """(preference, n) over the labels that count; others are ignored."""
    return (
        cases.where(preference_filter(F.col(label)))
        .groupBy(F.col(label).alias("preference"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def regressions(scores: DataFrame, order: str = "seq") -> DataFrame:
    """(order, id) of the cases whose candidate scores below the baseline."""
    return scores.where(is_regression()).select(order, "id")


def scored_cases(
    cases: DataFrame,
    key: str = "id",
    scorer: Callable[[Column, Column], Column] | None = None,
    response: str = "response",
    reference: str = "reference",
) -> DataFrame:
    """(key, score). ``scorer(response, reference) -> Column``; default token F1."""
    if scorer is None:
        return token_f1(cases, key, reference, response).withColumnRenamed("token_f1", "score")
    return cases.select(key, scorer(F.col(response), F.col(reference)).alias("score"))


def score_report(scored: DataFrame, model: str) -> DataFrame:
    """One row: model, number of cases and mean score to four places."""
    return scored.agg(
        F.count(F.lit(1)).alias("n_cases"),
        F.coalesce(F.round(F.avg("score"), 4), F.lit(0.0)).alias("average_score"),
    ).select(F.lit(model).alias("model"), "average_score", "n_cases")


def preference_pairs(cases: DataFrame) -> DataFrame:
    """(order column ``seq``, prompt, chosen, rejected) where a candidate or baseline was preferred over another text."""
    won = F.col("human_preference") == "candidate"
    decided = cases.where(
        F.col("human_preference").isin("candidate", "baseline")
        & F.col("candidate").isNotNull()
        & F.col("baseline").isNotNull()
        & (F.col("candidate") != F.col("baseline"))
    )
    return decided.select(
        "seq",
        "prompt",
        F.when(won, F.col("candidate")).otherwise(F.col("baseline")).alias("chosen"),
        F.when(won, F.col("baseline")).otherwise(F.col("candidate")).alias("rejected"),
    )


def context_scores(rows: DataFrame, key: str, context: str, answer: str, wanted: str) -> DataFrame:
    """(key, faithfulness, context_recall): shares of an answer's and of the wanted tokens that the context holds.

    Token-overlap proxies; a text without tokens scores 0.
    """
    counted = token_overlaps(rows, key, context, [answer, wanted])

    def share(side: str) -> Column:
        return F.coalesce(F.try_divide(f"overlap_{side}", f"n_{side}"), F.lit(0.0))

    return counted.select(key, share(answer).alias("faithfulness"), share(wanted).alias("context_recall"))
