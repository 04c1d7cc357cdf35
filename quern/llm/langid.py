"""Language of words and documents by a linear-chain conditional random field.

A word's features are its beginnings and endings, its character n-grams, the word
itself and the languages whose lexicon holds it, hashed into WEIGHTS rows of one
weight per language. Transitions between the languages of neighbouring words are
learned with them. Forward-backward gives every word's probabilities; a document
gets the language with the largest mean, and runs of words keep their own, so
code-switched text is labelled part by part.

The words of a document are chains of CHAIN words. The model is fitted on a bounded
sample of labelled documents: at most about SAMPLE_DOCS for each language, one of
each group of copies, CHAINS chains of each; half of the chains are spliced from two
documents, which teaches the transitions what a switch looks like.

Defined results: null text or text without letters is ``und`` with a score of 0;
rows with a null id or language are never learned from; with nothing to learn from
every text is ``und``.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS, HELD_OUT = 4, 2
SAMPLE_DOCS = 1_000
CHAINS = 2
CHAIN = 64
WEIGHTS = 1 << 17
EPOCHS = 4
LEXICON_COUNT, LEXICON_SHARE = 5, 0.8
UNKNOWN = "und"

# A longer run of letters, as in text without spaces, is cut into words of this length.
LONGEST = 40
_WORD = re.compile(rf"[^\W\d_]{{1,{LONGEST}}}")
# Chains solved at once, and words whose emissions a worker remembers.
BLOCK_CHAINS = 4_096
REMEMBERED = 400_000


def words_of(text: str | None) -> list[str]:
    return [w for w in _WORD.findall((text or "").lower())]


def _has_letter(text: str | None) -> bool:
    return any(c.isalpha() for c in text or "")


def features(word: str, lexicon: dict[str, tuple[str, ...]]) -> list[int]:
    """Rows of the weight table for a word."""
    marked = f"^{word}$"
    found = [f"w{word}", *("l" + lang for lang in lexicon.get(word, ()))]
    found += [f"p{marked[: n + 1]}" for n in (1, 2, 3)] + [f"s{marked[-n - 1 :]}" for n in (1, 2, 3)]
    found += [marked[i : i + n] for n in (2, 3) for i in range(len(marked) - n + 1)]
    return [zlib.crc32(f.encode("utf-8", "surrogatepass")) % WEIGHTS for f in found]


def forward_backward(emissions: np.ndarray, mask: np.ndarray, transitions: np.ndarray, start: np.ndarray):
    """(marginals, scaled forward, scaled backward, local evidence) of chains (chain, place, language)."""
    n, length, langs = emissions.shape
    local = np.exp(emissions - emissions.max(axis=2, keepdims=True))
    step = np.exp(transitions)
    forward = np.empty_like(local)
    backward = np.ones_like(local)
    forward[:, 0] = local[:, 0] * np.exp(start)
    forward[:, 0] /= forward[:, 0].sum(axis=1, keepdims=True)
    for t in range(1, length):
        forward[:, t] = (forward[:, t - 1] @ step) * local[:, t]
        forward[:, t] /= forward[:, t].sum(axis=1, keepdims=True)
    for t in range(length - 2, -1, -1):
        ahead = (backward[:, t + 1] * local[:, t + 1]) @ step.T
        ahead /= ahead.sum(axis=1, keepdims=True)
        backward[:, t] = np.where(mask[:, t + 1, None], ahead, 1.0)
    marginals = forward * backward
    marginals /= marginals.sum(axis=2, keepdims=True)
    return marginals, forward, backward, local


@dataclass(frozen=True)
class Model:
    langs: list[str]
    weights: np.ndarray
    transitions: np.ndarray
    start: np.ndarray
    lexicon: dict[str, tuple[str, ...]]


def train(texts: list[tuple[str, str]], seed: int = 5) -> Model | None:
    """Fit by Adam on the conditional likelihood of (text, language) rows."""
    rng = np.random.default_rng(seed)
    langs = sorted({lang for _, lang in texts})
    tokens = [(words_of(text), langs.index(lang)) for text, lang in texts]
    tokens = [(w, y) for w, y in tokens if w]
    if not tokens:
        return None
    seen = Counter((w, y) for ws, y in tokens for w in set(ws))
    total: Counter = Counter()
    for (w, _), c in seen.items():
        total[w] += c
    lexicon: dict[str, tuple[str, ...]] = {}
    for (w, y), c in seen.items():
        if c >= LEXICON_COUNT and c >= LEXICON_SHARE * total[w]:
            lexicon[w] = (langs[y],)
    chains: list[list[tuple[str, int]]] = []
    for ws, y in tokens:
        for _ in range(CHAINS):
            at = int(rng.integers(0, max(1, len(ws) - CHAIN + 1)))
            chains.append([(w, y) for w in ws[at : at + CHAIN]])
    # Splice every other chain from two documents.
    order = rng.permutation(len(chains))
    for a, b in zip(order[0::4], order[1::4]):
        i, j = (int(rng.integers(0, len(chains[c]) + 1)) for c in (a, b))
        chains[a], chains[b] = (chains[a][:i] + chains[b][j:])[:CHAIN] or chains[a], (chains[b][:j] + chains[a][i:])[:CHAIN] or chains[b]
    known: dict[str, np.ndarray] = {}
    for chain in chains:
        for w, _ in chain:
            if w not in known:
                known[w] = np.array(features(w, lexicon))
    n = len(langs)
    theta = [np.zeros((WEIGHTS, n)), np.zeros((n, n)), np.zeros(n)]
    moments = [[np.zeros_like(x), np.zeros_like(x)] for x in theta]
    steps = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(chains))
        for at in range(0, len(order), 128):
            batch = [chains[i] for i in order[at : at + 128]]
            length = max(map(len, batch))
            mask = np.array([[t < len(c) for t in range(length)] for c in batch])
            gold = np.zeros((len(batch), length), dtype=np.int64)
            rows, owner = [], []
            for i, chain in enumerate(batch):
                for t, (w, y) in enumerate(chain):
                    gold[i, t] = y
                    rows.append(known[w])
                    owner.append(i * length + t)
            sizes = np.array([len(r) for r in rows])
            flat = np.concatenate(rows)
            spot = np.repeat(np.array(owner), sizes)
            emissions = np.zeros((len(batch) * length, n))
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            emissions[owner] = np.add.reduceat(theta[0][flat], starts)
            emissions = emissions.reshape(len(batch), length, n)
            marginals, forward, backward, local = forward_backward(emissions, mask, theta[1], theta[2])
            truth = np.eye(n)[gold]
            error = (marginals - truth) * mask[..., None]
            grads = [np.zeros_like(x) for x in theta]
            for lang in range(n):
                grads[0][:, lang] = np.bincount(flat, weights=error.reshape(-1, n)[spot, lang], minlength=WEIGHTS)
            pair = forward[:, :-1, :, None] * np.exp(theta[1]) * (local * backward)[:, 1:, None, :]
            pair /= pair.sum(axis=(2, 3), keepdims=True)
            pair -= truth[:, :-1, :, None] * truth[:, 1:, None, :]
            grads[1] = (pair * mask[:, 1:, None, None]).sum(axis=(0, 1))
            grads[2] = error[:, 0].sum(axis=0)
            steps += 1
            for x, g, (m, v) in zip(theta, grads, moments):
                g = g / len(batch) + 1e-5 * x
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                x -= 0.05 * (m / (1 - 0.9**steps)) / (np.sqrt(v / (1 - 0.99**steps)) + 1e-8)
    return Model(langs, theta[0].astype(np.float32), theta[1], theta[2], lexicon)


def held_out(id_column: Column) -> Column:
    """Rows that are never learned from: remainder 2 of the id's checksum, and null ids."""
    return F.coalesce(F.pmod(F.crc32(id_column.cast("string")), F.lit(FOLDS)) == HELD_OUT, F.lit(True))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & ~held_out(F.col("id")))
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = rows.where(F.length("text") > 0)
    spot = F.pmod(F.xxhash64("text"), F.lit(1_000_000))
    chosen = F.lit(False)
    for lang, n in counts.items():
        chosen = chosen | ((F.col("lang") == lang) & (spot < int(1_000_000 * min(1.0, SAMPLE_DOCS / n))))
    sample = rows.where(chosen).groupBy("text").agg(F.max("lang").alias("lang")).orderBy(F.xxhash64("text"), "text")
    texts = [(r.text, r.lang) for r in sample.limit(2 * SAMPLE_DOCS * max(1, len(counts))).collect()]
    return train(texts)


class Labeller:
    """Word probabilities under a model, with a memory of words' emissions."""

    def __init__(self, model: Model):
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.rows: dict[str, int] = {}
        self.emissions = np.zeros((1024, len(self.model.langs)), dtype=np.float64)

    def _rows(self, words: list[str]) -> np.ndarray:
        fresh = [w for w in dict.fromkeys(words) if w not in self.rows]
        if len(self.rows) + len(fresh) > REMEMBERED:
            self.forget()
            fresh = list(dict.fromkeys(words))
        if fresh:
            found = [features(w, self.model.lexicon) for w in fresh]
            sizes = np.array([len(f) for f in found])
            flat = np.fromiter((x for f in found for x in f), dtype=np.int64, count=int(sizes.sum()))
            sums = np.add.reduceat(self.model.weights[flat], np.concatenate([[0], np.cumsum(sizes)[:-1]]), axis=0)
            at = len(self.rows)
            if at + len(fresh) > len(self.emissions):
                more = np.zeros((max(len(self.emissions), len(fresh)), self.emissions.shape[1]))
                self.emissions = np.concatenate([self.emissions, more])
            self.emissions[at : at + len(fresh)] = sums
            self.rows.update(zip(fresh, range(at, at + len(fresh))))
        return np.fromiter(map(self.rows.__getitem__, words), dtype=np.int64, count=len(words))

    def marginals(self, words: list[str], borders: np.ndarray) -> np.ndarray:
        """(word, language) probabilities; ``borders`` are the documents' first words and the end."""
        rows = self._rows(words)
        sizes = np.diff(borders)
        chains = -(-sizes // CHAIN)
        first = np.repeat(borders[:-1], chains) + CHAIN * (np.arange(chains.sum()) - np.repeat(np.cumsum(chains) - chains, chains))
        last = np.minimum(first + CHAIN, np.repeat(borders[1:], chains))
        out = np.zeros((len(words), len(self.model.langs)))
        for at in range(0, len(first), BLOCK_CHAINS):
            begin, end = first[at : at + BLOCK_CHAINS, None], last[at : at + BLOCK_CHAINS, None]
            place = begin + np.arange(int((end - begin).max()))
            mask = place < end
            emissions = np.where(mask[..., None], self.emissions[rows[np.minimum(place, end - 1)]], 0.0)
            found = forward_backward(emissions, mask, self.model.transitions, self.model.start)[0]
            out[place[mask]] = found[mask]
        return out


def label_documents(docs: DataFrame, model: Model | None, text_col: str = "text", with_runs: bool = False) -> DataFrame:
    """``docs`` as ``row`` (its columns), ``lang_pred``, ``score`` and, if wanted, ``runs`` of words in one language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(model) if model else None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = part.column(1).to_pylist()
                words = [words_of(t) for t in texts]
                borders = np.concatenate([[0], np.cumsum([len(w) for w in words])])
                flat = [w for ws in words for w in ws]
                probable = labeller.marginals(flat, borders) if labeller and flat else None
                preds, scores, runs = [], [], []
                for i, text in enumerate(texts):
                    own = probable[borders[i] : borders[i + 1]] if probable is not None else ()
                    if not len(own) or not _has_letter(text):
                        preds.append(UNKNOWN)
                        scores.append(0.0)
                        runs.append([])
                        continue
                    mean = own.mean(axis=0)
                    preds.append(model.langs[int(mean.argmax())])
                    scores.append(float(min(mean.max(), 1.0)))
                    if with_runs:
                        best = own.argmax(axis=1)
                        cut = np.concatenate([[0], np.flatnonzero(np.diff(best)) + 1])
                        size = np.diff(np.concatenate([cut, [len(best)]]))
                        runs.append([{"first": int(a), "words": int(n), "lang": model.langs[best[a]]} for a, n in zip(cut, size)])
                arrays, names = [part.column(0), pa.array(preds, pa.string()), pa.array(scores, pa.float64())], ["row", "lang_pred", "score"]
                if with_runs:
                    kind = pa.list_(pa.struct([("first", pa.int64()), ("words", pa.int64()), ("lang", pa.string())]))
                    arrays.append(pa.array(runs, kind))
                    names.append("runs")
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    packed = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), F.col(text_col).alias("text"))
    kind = packed.schema["row"].dataType.simpleString()
    more = ", runs array<struct<first: long, words: long, lang: string>>" if with_runs else ""
    return packed.mapInArrow(run, f"row {kind}, lang_pred string, score double{more}")
