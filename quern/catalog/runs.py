"""Evaluation runs over time and many annotators, over ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.catalog import query, table
from quern.operators import agreement, runs, sketches
from quern.session import scratch_path

PLACES = 9


@query(
    "scores_as_of",
    """WITH scores AS (SELECT user_id, ts, arg_max(value, event_id) AS score FROM events
      WHERE event_type <> 'error' AND user_id IS NOT NULL AND ts IS NOT NULL GROUP BY ALL)
    SELECT a.event_id, a.user_id, s.score AS valid_score
    FROM (SELECT * FROM events WHERE event_type = 'error') a ASOF LEFT JOIN scores s
      ON a.user_id = s.user_id AND a.ts >= s.ts""",
)
def scores_as_of(spark, sf):
    """For every error event, the last value that its user had of any other kind."""
    events = table(spark, sf, "events")
    asked = events.where("event_type = 'error'").select("event_id", "user_id", "ts")
    scores = events.where("event_type <> 'error'")
    return runs.scores_as_of(scores, asked, "user_id", "ts", "value", "event_id").drop("ts")


_RUNS = """r AS (SELECT user_id, strftime(ts, '%Y-%m-%d') AS run, max(value) AS score FROM events GROUP BY ALL),
    ends AS (SELECT min(run) AS a, max(run) AS b FROM r)"""


@query(
    "run_changes",
    f"""WITH {_RUNS}, old AS (SELECT user_id, score AS before FROM r, ends WHERE run = a),
    new AS (SELECT user_id, score AS after FROM r, ends WHERE run = b)
    SELECT user_id, before, after, CASE WHEN before IS NULL THEN 'added' WHEN after IS NULL THEN 'removed'
      WHEN after < before THEN 'regressed' WHEN after > before THEN 'improved' ELSE 'same' END AS status
    FROM old FULL JOIN new USING (user_id)""",
)
def run_changes(spark, sf):
    """Every day is a run, every user a case; all days are stored, the last one is sent twice."""
    events = table(spark, sf, "events")
    day = F.date_format("ts", "yyyy-MM-dd")
    daily = events.groupBy("user_id", day.alias("run")).agg(F.max("value").alias("score"))
    first, last = events.agg(F.min(day), F.max(day)).first()
    path = scratch_path(spark, "runs")
    daily.write.partitionBy("run").parquet(path)
    runs.append_run(daily.where(F.col("run") == last).drop("run"), path, last)
    stored = spark.read.schema("user_id long, score double, run string").parquet(path)
    return runs.run_changes(stored, first, last, "user_id")


# Five events make an item; errors are missing marks.
_MARKS = "m AS (SELECT event_id // 5 AS item, event_type AS label, value FROM events WHERE event_type <> 'error')"


def _marks(spark, sf):
    events = table(spark, sf, "events")
    seen = F.col("event_type") != "error"
    return events.select(
        F.floor(F.col("event_id") / 5).alias("item"),
        (F.col("user_id") % 20).alias("who"),
        F.when(seen, F.col("event_type")).alias("label"),
        F.when(seen, F.col("value")).alias("value"),
    )


_PAIRED = f"""WITH {_MARKS}, u AS (SELECT item, count(*) AS m FROM m GROUP BY item HAVING count(*) > 1),
    p AS (SELECT m.*, u.m, row_number() OVER () AS mark FROM m JOIN u USING (item)),
    pairs AS (SELECT a.label AS value, b.label AS other, a.value AS x, b.value AS y, 1.0 / (a.m - 1) AS w
      FROM p a JOIN p b ON a.item = b.item AND a.mark <> b.mark)"""


@query(
    "annotator_coincidences",
    f"{_PAIRED} SELECT value, other, round(sum(w::DOUBLE), {PLACES}) AS weight FROM pairs GROUP BY ALL",
)
def annotator_coincidences(spark, sf):
    found = agreement.coincidences(_marks(spark, sf), "item", "label")
    return found.withColumn("weight", F.round("weight", PLACES))


def _alpha_sql(gap: str, between: str) -> str:
    return f"""{_PAIRED}, n AS (SELECT (SELECT count(*) FROM u) AS items, count(*) AS marks FROM p),
    o AS (SELECT sum(w::DOUBLE * {gap}) AS within FROM pairs), e AS ({between})
    SELECT items, marks, round(within / marks, 6) AS observed, round(total / (marks * (marks - 1.0)), 6) AS expected,
      round(1 - (within / marks) / (total / (marks * (marks - 1.0))), 6) AS alpha FROM n, o, e"""


@query(
    "annotator_alpha",
    _alpha_sql(
        "(value <> other)::INT",
        """SELECT (sum(c) * sum(c) - sum(c * c))::DOUBLE AS total
        FROM (SELECT label, count(*)::DOUBLE AS c FROM p GROUP BY label)""",
    ),
)
def annotator_alpha(spark, sf):
    return _alpha(agreement.krippendorff_alpha(_marks(spark, sf), "item", "label"))


@query(
    "annotator_alpha_interval",
    _alpha_sql("((x - y) * (x - y))", "SELECT 2 * (count(*) * sum(value * value) - sum(value) * sum(value)) AS total FROM p"),
)
def annotator_alpha_interval(spark, sf):
    return _alpha(agreement.krippendorff_alpha(_marks(spark, sf), "item", "value", "interval"))


def _alpha(found):
    return found.withColumns({c: F.round(c, 6) for c in ("observed", "expected", "alpha")})


# Every five events are an item, marked by the user of each event.
@query(
    "annotator_pair_kappas",
    f"""WITH m AS (SELECT event_id // 5 AS item, user_id % 20 AS who, max(event_type) AS mark FROM events
      WHERE event_type <> 'error' AND user_id IS NOT NULL GROUP BY ALL),
    p AS (SELECT a.who AS first, b.who AS second, a.mark AS x, b.mark AS y
      FROM m a JOIN m b ON a.item = b.item AND a.who < b.who),
    s AS (SELECT first, second, count(*) AS items, avg((x = y)::INT) AS agreement FROM p GROUP BY ALL),
    l AS (SELECT first, second, x AS mark, count(*) AS n FROM p GROUP BY ALL),
    r AS (SELECT first, second, y AS mark, count(*) AS n FROM p GROUP BY ALL),
    c AS (SELECT first, second, sum(l.n * r.n) AS chance FROM l JOIN r USING (first, second, mark) GROUP BY ALL)
    SELECT first, second, items, round(agreement, {PLACES}) AS agreement,
      round((agreement - coalesce(chance, 0) / (items::DOUBLE * items))
        / nullif(1 - coalesce(chance, 0) / (items::DOUBLE * items), 0), {PLACES}) AS kappa
    FROM s LEFT JOIN c USING (first, second)""",
)
def annotator_pair_kappas(spark, sf):
    marks = _marks(spark, sf).select("item", "label", "who")
    found = agreement.pair_kappas(marks, "item", "who", "label")
    return found.withColumns({c: F.round(c, PLACES) for c in ("agreement", "kappa")})


_QUANTILES = [0.1, 0.5, 0.9, 0.99]


@query(
    "merged_latency_quantiles",
    " UNION ALL ".join(
        f"SELECT event_type AS model, {q}::DOUBLE AS quantile, count(value) AS n, true AS within FROM events GROUP BY event_type"
        for q in _QUANTILES
    ),
)
def merged_latency_quantiles(spark, sf):
    """Days are batches, kinds of event are models. Each estimate is checked against its exact rank in the table."""
    events = table(spark, sf, "events").select(F.col("event_type").alias("model"), F.col("value").alias("latency"), "ts")
    path = scratch_path(spark, "sketches")
    half = events.agg(F.timestamp_seconds(F.avg(F.unix_timestamp("ts")))).first()[0]
    first = F.coalesce(F.col("ts") < F.lit(half), F.lit(False))
    for batch, rows in (("1", events.where(first)), ("2", events.where(~first)), ("2", events.where(~first))):
        sketches.sketch_batch(rows, path, batch, ["model"], ["latency"])
    stored = spark.read.schema("model string, latency binary, batch string").parquet(path)
    found = sketches.merged_quantiles(stored, ["model"], ["latency"], _QUANTILES)
    # Models times quantiles: a few rows per model, whatever the number of events.
    ranked = events.join(found.hint("broadcast"), "model").where("latency IS NOT NULL").groupBy("model", "quantile", "n")
    below, upto = F.avg((F.col("latency") < F.col("estimate")).cast("double")), F.avg((F.col("latency") <= F.col("estimate")).cast("double"))
    ranks = ranked.agg(below.alias("low"), upto.alias("high"))
    gap = sketches.RANK_ERROR
    return ranks.select("model", "quantile", "n", ((F.col("low") - gap <= F.col("quantile")) & (F.col("high") + gap >= F.col("quantile"))).alias("within"))
