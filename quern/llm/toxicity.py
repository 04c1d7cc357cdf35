"""Toxicity by a weighted finite-state grammar over clauses.

Words are mapped to symbols: insult, threat, target, negation, report, other. Four
small transducers read the symbols of a clause: the first writes a match for every
insult or threat, the others say whether it is aimed at a target, negated or
reported speech. Composed, they are one machine that writes, for each match of a
clause, its kind. A second machine reads the clause from its end, so a target may
also follow the match. A colon does not end a clause: what it introduces is still
reported. A document's score is logistic in what its clauses matched.

Insults are a fixed list of common ones and what the labelled texts teach: words
and word beginnings that toxic documents hold far more often than chance allows
(a likelihood ratio, corrected for the number of candidates). The weights of the
kinds of match are a logistic regression on the same labelled rows. The fit uses at
most about SAMPLE_ROWS labelled rows, picked by hash, and one of each group of equal texts
with equal labels; texts that differ in anything are rows of their own.
The lexicon is a bounded model: the 20 * LEXICON_TERMS candidates that most toxic documents hold
are weighed, and the LEXICON_TERMS with the highest ratio are kept; scoring reads all texts.

Defined results: null or empty texts get the score of a text without matches; rows
with a null id are scored but never learned from; without labelled rows of both
kinds the regression keeps its prior weights.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import Staging

FOLDS, HELD_OUT = 5, 0
SAMPLE_ROWS = 20_000
LEXICON_TERMS = 5_000
PREFIXES = range(4, 9)
# A term is learned where chance would give less than this many such terms.
CHANCE = 0.05

# Base words of the grammar.
INSULTS = "idiot idiots moron morons stupid pathetic scum worthless trash disgusting loser losers clown clowns imbecile dumb idiota estúpido basura asqueroso dummkopf abschaum wertlos abfall ekelhaft imbécile crétin débile ordure".split()
THREATS = "kill hurt destroy burn beat töten verletzen matar golpear destruir tuer frapper détruire".split()
TARGETS = "you your yours he she they him them du dich ihr euch tú te usted ustedes tu vous toi".split()
NEGATIONS = "not no never without nicht kein keine nie sin nunca jamás pas jamais sans".split()
REPORTS = "said says wrote quoted claimed reported sagte schrieb zitierte dijo escribió dit écrit".split()

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
SYMBOLS = range(6)
# Words after a negation, a report or a target that it reaches.
REACH = {NEGATION: 3, REPORT: 6, TARGET: 4}

_WORD = re.compile(r"[^\W\d_]+")
_PART = re.compile(r"[^\W\d_]+|[.!?;\n]")


@dataclass(frozen=True)
class Machine:
    """Deterministic transducer: (state, symbol) -> (state, output); state 0 starts, output is a tuple."""

    arcs: dict[tuple[int, int], tuple[int, tuple]]
    states: int


def matcher() -> Machine:
    """Writes the symbol itself for insults and threats."""
    return Machine({(0, s): (0, (s,) if s in (INSULT, THREAT) else ()) for s in SYMBOLS}, 1)


def scope(trigger: int, reach: int) -> Machine:
    """Writes (True,) while within ``reach`` words after ``trigger``, else (False,)."""
    arcs = {}
    for state in range(reach + 1):
        for symbol in SYMBOLS:
            after = reach if symbol == trigger else max(state - 1, 0)
            arcs[state, symbol] = after, (state > 0,)
    return Machine(arcs, reach + 1)


def compose(left: Machine, right: Machine) -> Machine:
    """Both machines over the same input; outputs are joined, and stay empty where the first writes nothing."""
    arcs = {}
    for (a, symbol), (to_a, out_a) in left.arcs.items():
        for b in range(right.states):
            to_b, out_b = right.arcs[b, symbol]
            arcs[a * right.states + b, symbol] = to_a * right.states + to_b, out_a + out_b if out_a else ()
    return Machine(arcs, left.states * right.states)


def grammar() -> Machine:
    """Writes (insult or threat, negated, reported, targeted) for each match."""
    machine = matcher()
    for trigger in (NEGATION, REPORT, TARGET):
        machine = compose(machine, scope(trigger, REACH[trigger]))
    return machine


def targets_ahead() -> Machine:
    """Reads a clause from its end; writes (symbol, target follows) for each match."""
    return compose(matcher(), scope(TARGET, REACH[TARGET]))


# Kinds of clause match: threat or insult, each plain, targeted, negated or reported.
KINDS = 8
FEATURES = KINDS + 2
PRIOR = np.array([-4.0, *([4.0, 5.0, 2.0, 2.0] * 2), 1.0, 1.0])


def _kind(match: tuple) -> int:
    symbol, negated, reported, targeted = match
    return 4 * (symbol == THREAT) + (2 if negated else 3 if reported else 1 if targeted else 0)


class Scorer:
    """Clause features of a text under a lexicon {word or beginning + '*': weight}."""

    def __init__(self, lexicon: dict[str, float]):
        self.words = {w: v for w, v in lexicon.items() if not w.endswith("*")}
        self.beginnings = {w[:-1]: v for w, v in lexicon.items() if w.endswith("*")}
        self.machine = grammar()
        self.ahead = targets_ahead()
        self.known: dict[str, tuple[int, float]] = {}
        self.fixed = {}
        for symbol, words in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS), (THREAT, THREATS), (INSULT, INSULTS)):
            self.fixed.update(dict.fromkeys(words, symbol))

    def symbol(self, word: str) -> tuple[int, float]:
        found = self.known.get(word)
        if found is None:
            found = OTHER, 0.0
            if word in self.words:
                found = INSULT, self.words[word]
            elif word in self.fixed:
                found = self.fixed[word], 3.0
            else:
                for size in reversed(PREFIXES):
                    if len(word) >= size and word[:size] in self.beginnings:
                        found = INSULT, self.beginnings[word[:size]]
                        break
            if len(self.known) > 500_000:
                self.known.clear()
            self.known[word] = found
        return found

    def matches(self, clause: list[int]) -> list[tuple]:
        """(insult or threat, negated, reported, targeted) for each match, from both directions."""
        if INSULT not in clause and THREAT not in clause:
            return []
        state, before = 0, []
        for found in clause:
            state, written = self.machine.arcs[state, found]
            if written:
                before.append(written)
        state, after = 0, []
        for found in reversed(clause):
            state, written = self.ahead.arcs[state, found]
            if written:
                after.append(written[1])
        return [(*match[:3], match[3] or ahead) for match, ahead in zip(before, reversed(after))]

    def features(self, text: str) -> np.ndarray | None:
        """None where nothing matches."""
        text = text.lower()
        symbol = self.symbol
        if not any(symbol(w)[0] in (INSULT, THREAT) for w in set(_WORD.findall(text))):
            return None
        kinds = np.zeros(KINDS)
        heaviest = total = 0.0
        words = 0
        clause: list[int] = []
        for part in [*_PART.findall(text), "."]:
            if part in ".!?;\n":
                for match in self.matches(clause):
                    kinds[_kind(match)] += 1
                clause.clear()
                continue
            words += 1
            found, weight = symbol(part)
            clause.append(found)
            if found == INSULT:
                heaviest = max(heaviest, weight)
                total += weight
        return np.concatenate([np.log1p(kinds), [heaviest / 4, math.log1p(100 * total / (words + 20))]])


def _terms(text: str) -> set[str]:
    words = set(_WORD.findall(text.lower()))
    return words | {w[:n] + "*" for w in words for n in PREFIXES if len(w) >= n}


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with each term, by label; summed within a batch."""
    for batch in batches:
        counts = Counter(), Counter()
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts[toxic].update(_terms(text))
        # Terms of clean documents alone can't be learned and are not passed on.
        terms = list(counts[1])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(terms, pa.string()),
                pa.array([counts[1][t] for t in terms], pa.int64()),
                pa.array([0] * len(terms), pa.int64()),
            ],
            names=["term", "toxic", "clean"],
        )


def _count_known(terms: frozenset[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = Counter()
            for text in batch.column(0).to_pylist():
                counts.update(_terms(text) & terms)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["term", "clean"]
            )

    return run


def _features(lexicon: dict[str, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(lexicon)
        for batch in batches:
            found = [scorer.features(t) for t in batch.column(0).to_pylist()]
            rows = [(np.zeros(FEATURES) if f is None else f).tolist() for f in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(rows, pa.list_(pa.float64()))], names=["toxic", "features"]
            )

    return run


def _regression(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression towards PRIOR, by Newton steps; weights of matches are not negative."""
    x = np.column_stack([np.ones(len(x)), x])
    weights = PRIOR.copy()
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (p - y) + (weights - PRIOR)
        curve = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.eye(len(weights))
        step = np.linalg.solve(curve, slope)
        weights = weights - step
        weights[1:] = np.maximum(weights[1:], 0)
        if np.abs(step).max() < 1e-6:
            break
    return weights


@dataclass(frozen=True)
class Model:
    lexicon: dict[str, float]
    weights: np.ndarray

    def score(self, features: np.ndarray | None) -> float:
        z = self.weights[0] + (0.0 if features is None else float(self.weights[1:] @ features))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def held_out(id_column: Column) -> Column:
    """Rows that are never learned from: remainder 0 of the id's checksum, and null ids."""
    return F.coalesce(F.pmod(F.crc32(id_column.cast("string")), F.lit(FOLDS)) == HELD_OUT, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    staging = Staging(docs.sparkSession, "toxicity")
    marks = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    marks = marks.groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    marks = marks.where(~held_out(F.col("_id")))
    share = min(1.0, SAMPLE_ROWS / max(marks.count(), 1))
    marks = marks.where(F.pmod(F.xxhash64("_id"), F.lit(1_000_000)) < F.lit(int(share * 1_000_000)))
    texts = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    rows = texts.join(marks, "_id").select(F.col("_text").alias("text"), "toxic")
    rows = rows.distinct()
    sample = staging.write(rows.repartition(F.xxhash64("text")))
    n = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = n.get(1, 0), n.get(0, 0)
    lexicon: dict[str, float] = {}
    if n_toxic and n_clean:
        base = n_toxic / (n_toxic + n_clean)
        seen = sample.mapInArrow(_count_terms, "term string, toxic long, clean long").groupBy("term").agg(F.sum("toxic").alias("toxic"))
        seen = staging.write(seen)
        bound = math.log(max(seen.count(), 1) / CHANCE)
        # Enough toxic documents to be learned even without any clean one.
        enough = seen.where(F.col("toxic") * F.lit(-math.log(base)) >= bound)
        top = {r.term: r.toxic for r in enough.orderBy(F.desc("toxic"), "term").limit(20 * LEXICON_TERMS).collect()}
        known = sample.where("toxic = 0").select("text").mapInArrow(_count_known(frozenset(top)), "term string, clean long")
        clean = {r.term: r.n for r in known.groupBy("term").agg(F.sum("clean").alias("n")).collect()}
        scored = []
        for term, a in top.items():
            b = clean.get(term, 0)
            p = a / (a + b)
            ratio = a * math.log(p / base) + (b * math.log((1 - p) / (1 - base)) if b else 0.0)
            if p > 0.9 and ratio >= bound:
                scored.append((ratio, term, math.log((a + 0.5) / (n_toxic + 1)) - math.log((b + 0.5) / (n_clean + 1))))
        lexicon = {term: weight for _, term, weight in sorted(scored, reverse=True)[:LEXICON_TERMS]}
    weights = PRIOR
    if n_toxic and n_clean:
        rows = sample.select("text", "toxic").mapInArrow(_features(lexicon), "toxic int, features array<double>").collect()
        weights = _regression(np.array([r.features for r in rows]), np.array([float(r.toxic) for r in rows]))
    staging.drop(sample)
    return Model(lexicon, weights)


def score_documents(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` as ``row`` (its columns), ``score`` and ``predicted``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.lexicon)
        empty = model.score(None)
        for batch in batches:
            scores = []
            for text in batch.column(1).to_pylist():
                found = scorer.features(text) if text else None
                scores.append(empty if found is None else model.score(found))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["row", "score"])

    packed = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), F.col(text_col).alias("text"))
    kind = packed.schema["row"].dataType.simpleString()
    scored = packed.mapInArrow(run, f"row {kind}, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns."""
    scored = score_documents(docs, fit(docs, labels, id_col, text_col), text_col)
    return scored.where("predicted = 0").select("row.*")
