"""Toxicity: the composed grammar, held-out accuracy and defined cases."""

import random
import zlib

import numpy as np

from quern.llm import toxicity as tox
from quern.llm.queries import QUERIES


def kinds(text):
    found = tox.Scorer({}).features(text)
    return [] if found is None else np.round(np.expm1(found[: tox.KINDS])).astype(int).tolist()


def test_grammar():
    assert kinds("a quiet day") == []
    assert kinds("what an idiot") == [1, 0, 0, 0, 0, 0, 0, 0]
    assert kinds("you are an idiot") == [0, 1, 0, 0, 0, 0, 0, 0]
    assert kinds("that was not stupid") == [0, 0, 1, 0, 0, 0, 0, 0]
    assert kinds("she wrote idiot") == [0, 0, 0, 1, 0, 0, 0, 0]
    assert kinds("not here. idiot") == [1, 0, 0, 0, 0, 0, 0, 0]
    assert kinds("you die, we kill") == [0, 0, 0, 0, 0, 1, 0, 0]
    # Reported speech after a colon, and targets that follow.
    assert kinds("He said: you are an idiot") == [0, 0, 0, 1, 0, 0, 0, 0]
    assert kinds("Sagte er: dummkopf") == [0, 0, 0, 1, 0, 0, 0, 0]
    assert kinds("idiot, get lost you") == [0, 1, 0, 0, 0, 0, 0, 0]
    assert kinds("idiot. you left") == [1, 0, 0, 0, 0, 0, 0, 0]
    assert kinds("idiot one two three four you") == [1, 0, 0, 0, 0, 0, 0, 0]


def test_composed_machine_equals_a_plain_matcher():
    """Random clauses against the rule written out over positions."""
    rng = random.Random(5)
    words = {tox.OTHER: "day", tox.INSULT: "idiot", tox.THREAT: "kill", tox.TARGET: "you", tox.NEGATION: "not", tox.REPORT: "said"}
    for _ in range(500):
        clauses = [[rng.choice([0, 0, 0, 1, 2, 3, 4, 5]) for _ in range(rng.randint(0, 14))] for _ in range(rng.randint(1, 3))]
        want = [0] * tox.KINDS
        for clause in clauses:
            for i, symbol in enumerate(clause):
                if symbol not in (tox.INSULT, tox.THREAT):
                    continue
                near = {t: t in clause[max(0, i - reach) : i] for t, reach in tox.REACH.items()}
                aimed = near[tox.TARGET] or tox.TARGET in clause[i + 1 : i + 1 + tox.REACH[tox.TARGET]]
                kind = 2 if near[tox.NEGATION] else 3 if near[tox.REPORT] else 1 if aimed else 0
                want[4 * (symbol == tox.THREAT) + kind] += 1
        text = rng.choice([". ", "!", "\n"]).join(" ".join(words[s] for s in c) for c in clauses)
        assert kinds(text) == (want if any(want) else []), text


def test_very_long_text():
    found = tox.Scorer({}).features("a calm word " * 400_000 + ". you are an idiot")
    assert round(np.expm1(found[1])) == 1 and found[: tox.KINDS].sum() == found[1]


def test_learned_beginnings():
    scorer = tox.Scorer({"zork*": 2.0} | {"zorkel*": 3.0})
    assert scorer.symbol("zorken") == (tox.INSULT, 2.0)
    assert scorer.symbol("zorkeling") == (tox.INSULT, 3.0)
    assert scorer.symbol("zor") == (tox.OTHER, 0.0)


def test_cases(spark):
    rows = [(1, "you idiot", 1, "x"), (2, None, 2, "y"), (3, "", 3, "z"), (None, "you idiot", 4, "w"), (1, "you idiot", 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int, row string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = tox.fit(docs, none)
    scored = tox.score_documents(docs, model).collect()
    assert sorted(r.predicted for r in scored) == [0, 0, 1, 1, 1]
    assert tox.drop_toxic(docs, none).columns == docs.columns
    assert tox.score_documents(docs.limit(0), model).count() == 0
    odd = spark.createDataFrame([(1, None), (None, 1), (2, 1), (2, 0)], "doc_id long, toxic int")
    assert tox.fit(docs, odd).weights.shape == (tox.FEATURES + 1,)


def test_held_out(spark):
    sf = "/root/testdata/sf0.1"
    scored = {r.doc_id: r for r in QUERIES["op8_toxicity"](spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in scored.items())
    right = [scored[r.doc_id].predicted == r.toxic for r in labels if scored[r.doc_id].held_out]
    found = [scored[r.doc_id].predicted for r in labels if scored[r.doc_id].held_out and r.toxic]
    assert len(right) > 100 and np.mean(right) > 0.95
    print(np.mean(right), np.mean(found), len(found))


def test_learns_from_every_distinct_text(spark):
    # All texts share a frame of words; only equal texts may fold.
    frame = " ".join(f"frame{a}{b}" for a in "abcdefgh" for b in "abcdefgh")
    rows = [(i, f"{frame} zorkel {'abcdefghij'[i % 10] * (i // 10 + 1)}", 1) for i in range(100)]
    rows += [(100 + i, f"{frame} quiet {'abcdefghij'[i % 10] * (i // 10 + 1)}", 0) for i in range(300)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    assert "zorkel" in tox.fit(docs, labels).lexicon


def test_held_out_toxic_rows_are_found(spark):
    sf = "/root/testdata/sf0.1"
    scored = {r.doc_id: r for r in QUERIES["op8_toxicity"](spark, sf).collect()}
    toxic = [scored[r.doc_id] for r in spark.read.parquet(f"{sf}/labels.parquet").where("toxic = 1").collect()]
    found = [r.predicted for r in toxic if r.held_out]
    print(np.mean(found), len(found))
    assert len(found) > 50 and np.mean(found) > 0.85
