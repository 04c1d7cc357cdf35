"""Evaluation, feedback and preference queries over ``conversations``."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.catalog import query, sql, table
from quern.operators import alignment, evals, feedback, filters

STAMP = "2026-01-01T00:00:00+00:00"
PLACES = 9
# A case's number is its conversation's times this, plus its block.
BLOCKS = 1_000_003


def conversation_cases(spark, sf):
    """One case per block of four turns of a conversation; the last is padded with nulls."""
    turns = table(spark, sf, "conversations")
    block = F.floor(F.col("turn") / 4).cast("bigint")

    def said(place):
        return F.max(F.when(F.col("turn") % 4 == place, F.col("text")))

    label = F.array(*[F.lit(x) for x in ("candidate", "baseline", "tie", "unsure", None)])
    return (
        turns.groupBy((F.col("conv_id") * BLOCKS + block).alias("seq"))
        .agg(
            said(0).alias("prompt"),
            said(1).alias("expected"),
            said(2).alias("candidate"),
            said(3).alias("baseline"),
        )
        .withColumn("human_preference", label[(F.col("seq") % 5).cast("int")])
        .withColumn("id", F.when(F.col("seq") % 11 != 0, F.concat(F.lit("c"), F.col("seq"))))
    )


CASES = f"""cases AS (
      SELECT conv_id * {BLOCKS} + turn // 4 AS seq,
        max(text) FILTER (turn % 4 = 0) AS prompt, max(text) FILTER (turn % 4 = 1) AS expected,
        max(text) FILTER (turn % 4 = 2) AS candidate, max(text) FILTER (turn % 4 = 3) AS baseline,
        CASE seq % 5 WHEN 0 THEN 'candidate' WHEN 1 THEN 'baseline' WHEN 2 THEN 'tie'
          WHEN 3 THEN 'unsure' END AS human_preference,
        CASE WHEN seq % 11 <> 0 THEN 'c' || seq END AS id
      FROM conversations GROUP BY seq)"""


def _bags(side):
    return f"""{side}_bag AS (
      SELECT seq, token, count(*) AS n
      FROM (SELECT seq, unnest({sql.tokens(f"coalesce({side}, '')")}) AS token FROM cases) GROUP BY ALL),
    {side}_size AS (SELECT seq, sum(n) AS n FROM {side}_bag GROUP BY seq)"""


def _overlap(side):
    return f"""{side}_hits AS (
      SELECT seq, sum(least(a.n, e.n)) AS n FROM {side}_bag a JOIN expected_bag e USING (seq, token)
      GROUP BY seq),
    {side}_f1 AS (
      SELECT c.seq, coalesce(h.n, 0)::BIGINT AS overlap, coalesce(p.n, 0)::BIGINT AS n_answer,
        coalesce(e.n, 0)::BIGINT AS n_expected,
        CASE WHEN h.n > 0
          THEN 2 * (h.n::DOUBLE / p.n) * (h.n::DOUBLE / e.n) / (h.n::DOUBLE / p.n + h.n::DOUBLE / e.n)
          ELSE 0.0::DOUBLE END AS f1
      FROM cases c LEFT JOIN {side}_hits h USING (seq) LEFT JOIN {side}_size p USING (seq)
        LEFT JOIN expected_size e USING (seq))"""


SCORES = f"""WITH {CASES}, {_bags('expected')}, {_bags('candidate')}, {_bags('baseline')},
    {_overlap('candidate')}, {_overlap('baseline')},
    scores AS (
      SELECT c.seq, coalesce(c.id, 'unknown') AS id,
        lower({sql.strip("coalesce(c.candidate, '')")}) = lower({sql.strip("coalesce(c.expected, '')")})
          AS exact_match,
        c.human_preference, a.f1 AS candidate_f1, b.f1 AS baseline_f1, a.f1 < b.f1 AS regressed
      FROM cases c JOIN candidate_f1 a USING (seq) JOIN baseline_f1 b USING (seq))"""


def _scores(spark, sf):
    return evals.eval_case_scores(conversation_cases(spark, sf))


def _rounded(df, *names):
    return df.withColumns({name: F.round(name, PLACES) for name in names})


@query(
    "eval_case_scores",
    f"""{SCORES} SELECT seq, id, exact_match, human_preference,
    round(candidate_f1, {PLACES}) AS candidate_f1, round(baseline_f1, {PLACES}) AS baseline_f1, regressed
    FROM scores""",
)
def eval_case_scores(spark, sf):
    return _rounded(_scores(spark, sf), "candidate_f1", "baseline_f1")


@query("token_f1", f"{SCORES} SELECT seq, round(f1, {PLACES}) AS token_f1 FROM candidate_f1")
def token_f1(spark, sf):
    cases = conversation_cases(spark, sf)
    return _rounded(evals.token_f1(cases, "seq", "expected", "candidate"), "token_f1")


@query(
    "token_overlap",
    f"{SCORES} SELECT seq, n_expected, n_answer AS n_candidate, overlap AS overlap_candidate FROM candidate_f1",
)
def token_overlap(spark, sf):
    return evals.token_overlaps(conversation_cases(spark, sf), "seq", "expected", ["candidate"])


@query(
    "exact_match",
    f"""SELECT conv_id, turn, lower({sql.strip('text')}) =
      lower({sql.strip("CASE WHEN turn % 2 = 0 THEN '  ' || lower(text) || chr(10) ELSE text || '.' END")})
      AS exact_match FROM conversations""",
)
def exact_match(spark, sf):
    """Each turn against itself in lower case and padded, or with a full stop added."""
    other = F.when(F.col("turn") % 2 == 0, F.concat(F.lit("  "), F.lower("text"), F.lit("\n"))).otherwise(
        F.concat("text", F.lit("."))
    )
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", evals.exact_match(F.col("text"), other).alias("exact_match")
    )


@query("preference_filter", f"WITH {CASES} SELECT seq FROM cases WHERE human_preference IN ('candidate', 'baseline', 'tie')")
def preference_filter(spark, sf):
    cases = conversation_cases(spark, sf)
    return cases.where(filters.preference_filter(F.col("human_preference"))).select("seq")


@query(
    "preference_counts",
    f"""WITH {CASES} SELECT human_preference AS preference, count(*) AS n FROM cases
    WHERE human_preference IN ('candidate', 'baseline', 'tie') GROUP BY 1""",
)
def preference_counts(spark, sf):
    return evals.preference_counts(conversation_cases(spark, sf))


@query("regression_filter", f"{SCORES} SELECT seq FROM scores WHERE candidate_f1 < baseline_f1")
def regression_filter(spark, sf):
    return _scores(spark, sf).where(evals.is_regression()).select("seq")


@query("regressions", f"{SCORES} SELECT seq, id FROM scores WHERE candidate_f1 < baseline_f1 ORDER BY seq")
def regressions(spark, sf):
    return evals.regressions(_scores(spark, sf)).orderBy("seq")


@query(
    "eval_report",
    f"""{SCORES} SELECT count(*) AS cases,
    round(coalesce(avg(exact_match::INT), 0.0), {PLACES}) AS candidate_exact_match,
    round(coalesce(avg(candidate_f1), 0.0), {PLACES}) AS candidate_token_f1,
    round(coalesce(avg(baseline_f1), 0.0), {PLACES}) AS baseline_token_f1 FROM scores""",
)
def eval_report(spark, sf):
    return _rounded(
        evals.eval_report(_scores(spark, sf)),
        "candidate_exact_match",
        "candidate_token_f1",
        "baseline_token_f1",
    )


@query(
    "score_report",
    f"""{SCORES} SELECT 'token-overlap' AS model,
    coalesce(round(avg(f1), 4), 0.0) AS average_score, count(*) AS n_cases FROM candidate_f1""",
)
def score_report(spark, sf):
    scored = evals.scored_cases(
        conversation_cases(spark, sf), "seq", response="candidate", reference="expected"
    )
    return evals.score_report(scored, "token-overlap")


@query(
    "pluggable_scorer",
    f"""WITH {CASES} SELECT seq,
      round(least(length(coalesce(candidate, '')), length(coalesce(expected, '')))::DOUBLE
        / greatest(length(coalesce(candidate, '')), length(coalesce(expected, '')), 1), {PLACES}) AS score
    FROM cases""",
)
def pluggable_scorer(spark, sf):
    """A user-supplied scorer: the ratio of the shorter to the longer text."""

    def length_ratio(response, reference):
        a, b = (F.length(F.coalesce(c, F.lit(""))) for c in (response, reference))
        return F.round(F.least(a, b) / F.greatest(a, b, F.lit(1)), PLACES)

    return evals.scored_cases(
        conversation_cases(spark, sf), "seq", length_ratio, "candidate", "expected"
    )


@query(
    "preference_tasks",
    f"""WITH {CASES} SELECT prompt, expected AS response_a, candidate AS response_b,
    NULL::VARCHAR AS preference, NULL::INTEGER AS score, NULL::VARCHAR AS reason
    FROM cases WHERE expected IS NOT NULL AND candidate IS NOT NULL""",
)
def preference_tasks(spark, sf):
    records = conversation_cases(spark, sf).where("expected IS NOT NULL AND candidate IS NOT NULL")
    return feedback.preference_tasks(
        records.select("prompt", F.col("expected").alias("response_a"), F.col("candidate").alias("response_b"))
    )


def feedback_entries(spark, sf):
    """Each turn with the next one as response; ratings 0 to 6, some out of range."""
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    following = turns.select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("response")
    )
    return turns.join(following, ["conv_id", "turn"], "left").select(
        "conv_id",
        "turn",
        F.col("text").alias("prompt"),
        "response",
        ((F.col("conv_id") * 7 + F.col("turn")) % 7).cast("int").alias("rating"),
    )


ENTRIES = """entries AS (
      SELECT a.conv_id, a.turn, a.text AS prompt, b.text AS response,
        ((a.conv_id * 7 + a.turn) % 7)::INTEGER AS rating
      FROM conversations a LEFT JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1)"""


@query(
    "feedback_checks",
    f"""WITH {ENTRIES} SELECT conv_id, turn,
    CASE WHEN prompt IS NULL THEN 'prompt is null' WHEN response IS NULL THEN 'response is null'
      WHEN rating IS NULL THEN 'rating is null' WHEN rating NOT BETWEEN 1 AND 5 THEN 'rating out of range'
    END AS reason FROM entries""",
)
def feedback_checks(spark, sf):
    return feedback.feedback_checks(feedback_entries(spark, sf)).select("conv_id", "turn", "reason")


STORED = f"""WITH {ENTRIES}, stored AS (
      SELECT row_number() OVER (ORDER BY conv_id, turn) AS id, prompt, response, rating,
        '' AS tags, '' AS notes, '{STAMP}' AS created_at
      FROM entries WHERE prompt IS NOT NULL AND response IS NOT NULL AND rating BETWEEN 1 AND 5)"""


@query(
    "preference_pairs",
    f"""WITH {CASES} SELECT seq, prompt,
      CASE human_preference WHEN 'candidate' THEN candidate ELSE baseline END AS chosen,
      CASE human_preference WHEN 'candidate' THEN baseline ELSE candidate END AS rejected
    FROM cases WHERE human_preference IN ('candidate', 'baseline') AND candidate <> baseline""",
)
def preference_pairs(spark, sf):
    return evals.preference_pairs(conversation_cases(spark, sf))


@query(
    "context_scores",
    f"""WITH {CASES}, {_bags('prompt')}, {_bags('expected')}, {_bags('candidate')},
    hits AS (SELECT c.seq,
        (SELECT sum(least(a.n, p.n)) FROM candidate_bag a JOIN prompt_bag p USING (seq, token) WHERE seq = c.seq) AS a,
        (SELECT sum(least(e.n, p.n)) FROM expected_bag e JOIN prompt_bag p USING (seq, token) WHERE seq = c.seq) AS e
      FROM cases c)
    SELECT h.seq, round(coalesce(h.a / nullif(a.n, 0)::DOUBLE, 0.0), {PLACES}) AS faithfulness,
      round(coalesce(h.e / nullif(e.n, 0)::DOUBLE, 0.0), {PLACES}) AS context_recall
    FROM hits h LEFT JOIN candidate_size a USING (seq) LEFT JOIN expected_size e USING (seq)""",
)
def context_scores(spark, sf):
    """The prompt stands for the retrieved context."""
    scored = evals.context_scores(conversation_cases(spark, sf), "seq", "prompt", "candidate", "expected")
    return _rounded(scored, "faithfulness", "context_recall")


@query(
    "low_ratings",
    f"WITH {ENTRIES} SELECT conv_id, turn, prompt, response, rating FROM entries WHERE rating < 3 "
    "AND rating >= 1 AND prompt IS NOT NULL AND response IS NOT NULL",
)
def low_ratings(spark, sf):
    """Valid feedback with a rating below 3, for review."""
    return feedback.low_ratings(feedback_entries(spark, sf))


def _lcs(left, right):
    """CTEs: rows of the alignment table of ``pairs`` (k, a, b), one token of a at a time; a row is kept as a list."""
    best = "greatest(prev[j + 1], CASE WHEN p.b[j] = p.a[l.i + 1] THEN prev[j] + 1 ELSE 0 END)"
    cells = f"list_transform(range(1, len(p.b) + 1), lambda j: {best.replace('prev', 'l.r')})"
    return f"""pairs AS ({left}), l AS (
      SELECT k, 0 AS i, list_transform(range(0, len(b) + 1), lambda j: 0::BIGINT) AS r FROM pairs
      UNION ALL
      SELECT l.k, l.i + 1, [0::BIGINT] || list_transform(range(1, len(p.b) + 1), lambda j: list_max(({cells})[1:j]))
      FROM l JOIN pairs p ON l.k = p.k WHERE l.i < len(p.a)),
    {right} AS (SELECT p.k, coalesce(list_last(l.r), 0) AS n FROM pairs p JOIN l ON l.k = p.k AND l.i = len(p.a))"""


@query(
    "rouge_l",
    f"""WITH RECURSIVE {CASES}, {_lcs("SELECT seq AS k, " + sql.tokens("coalesce(candidate, '')") + " AS a, "
        + sql.tokens("coalesce(expected, '')") + " AS b FROM cases", "common")}
    SELECT k AS seq, n AS n_common, round(coalesce(n / nullif(len(a), 0)::DOUBLE, 0.0), {PLACES}) AS precision,
      round(coalesce(n / nullif(len(b), 0)::DOUBLE, 0.0), {PLACES}) AS recall,
      round(CASE WHEN n > 0 THEN 2.0 * n / (len(a) + len(b)) ELSE 0.0 END, {PLACES}) AS rouge_l
    FROM pairs JOIN common USING (k)""",
)
def rouge_l(spark, sf):
    scored = alignment.rouge_l(conversation_cases(spark, sf), "seq", "expected", "candidate")
    return _rounded(scored, "precision", "recall", "rouge_l")


@query(
    "best_contexts",
    f"""WITH RECURSIVE {CASES}, t AS (SELECT seq, list_filter(list_transform(
        regexp_split_to_array(coalesce(candidate, ''), '[.!?\n]+'), lambda s: {sql.tokens('s')}), lambda s: len(s) > 0) AS s,
        list_transform([prompt, expected, baseline], lambda c: {sql.tokens("coalesce(c, '')")}) AS c FROM cases),
    parts AS (SELECT seq, i::INTEGER AS sentence, j::INTEGER AS context, s[i + 1] AS a, c[j + 1] AS b
      FROM t, (SELECT unnest(range(0, 3)) AS j), unnest(range(0, len(s))) AS u(i)),
    {_lcs("SELECT {'seq': seq, 'sentence': sentence, 'context': context} AS k, a, b FROM parts", "common")}
    SELECT k.seq AS seq, k.sentence AS sentence, len(any_value(a))::INTEGER AS n_tokens,
      CASE WHEN max(n) > 0 THEN arg_max(k.context, n * 10 - k.context) END AS context, max(n) AS n_common
    FROM pairs JOIN common USING (k) GROUP BY 1, 2""",
)
def best_contexts(spark, sf):
    """Prompt, wanted answer and baseline stand for the retrieved contexts."""
    contexts = F.array("prompt", "expected", "baseline")
    cases = conversation_cases(spark, sf).withColumn("contexts", contexts)
    return alignment.best_contexts(cases, "seq", "contexts", "candidate")
