"""Toxicity: a counterfactual-regularised classifier (operator 6).

A sparse logistic model over the words a text holds and their beginnings (each
counted once, so one insult counts in a text of any length). Training adds a penalty on score
changes under counterfactuals: in each sentence of a labelled text that
mentions an identity term, the term is swapped for the others of its group and
for nothing, and the squared change of the sentence's logit is penalised. Words of the model
come from at most MOST labelled texts outside the held-out fold, of one text an
id, and at most features.MOST_BYTES of their words (documented bounds); an L1 step keeps those that matter, so that scoring looks up whole
words and needs no hashing.

Labels, lang, source and doc_id are no inputs. Edge cases: a null or empty text
scores as the bias alone. Repeated rows score alike. Without labels of both
classes the score is 0. Empty input, empty output; other columns don't matter.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.features import MOST_BYTES, bounded, fold, training_sample

MOST = 6000
#: Words in fewer sampled texts are left out.
LEAST_TEXTS = 4
CUT = 0.5
#: Lengths of the word beginnings that are features.
STEMS = (4, 5)
#: Features are chosen by the z score of their shares in the two classes, these many at most.
LEAST_Z, MOST_FEATURES = 4.0, 4000
#: Groups of identity terms that may stand for each other in a sentence.
IDENTITY = (
    ("women", "men", "girls", "boys", "transgender", "nonbinary"),
    ("woman", "man", "girl", "boy"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic", "protestant", "sikh"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics"),
    ("gay", "lesbian", "bisexual", "straight", "heterosexual", "homosexual", "queer"),
    ("black", "white", "asian", "hispanic", "latino", "african", "european", "arab"),
    ("american", "mexican", "chinese", "indian", "russian", "german", "french", "british", "african", "turkish"),
    ("immigrant", "immigrants", "refugee", "refugees", "foreigner", "foreigners", "citizen", "citizens"),
    ("old", "young", "elderly", "teenage"),
    ("deaf", "blind", "disabled", "paralyzed", "autistic"),
)
GROUP = {t: g for g in reversed(IDENTITY) for t in g}
_WORDS = re.compile(r"[^\W_]+(?:['’-][^\W_]+)*")
_SENTENCE = re.compile(r"[.!?\n]+")


def words_of(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


def parts_of(words) -> set[str]:
    """The words and, for longer ones, their beginnings of STEMS letters (marked), so that inflected forms share a feature."""
    out = set(words)
    for n in STEMS:
        out.update(f"{w[:n]}*" for w in words if len(w) > n)
    return out


@dataclass
class Model:
    bias: float
    weights: dict[str, float]

    def logit(self, words) -> float:
        get = self.weights.get
        return self.bias + sum(x for x in map(get, words) if x is not None)

    def score(self, text: str) -> float:
        found = self.weights.keys() & parts_of(set(words_of(text)))
        return float(1 / (1 + np.exp(-np.clip(self.logit(sorted(found)), -30, 30))))


def swaps(text: str) -> Iterator[tuple[str, str]]:
    """(term, other) for each sentence and identity term in it: the words a counterfactual takes out and puts in.

    The last swap of a term puts in nothing: a sentence with the term unsaid.
    """
    for sentence in _SENTENCE.split(text):
        words = set(words_of(sentence))
        for term in sorted(words & GROUP.keys()):
            for other in (*GROUP[term], ""):
                if other not in words:
                    yield term, other


def fit(texts: list[str], y: list[int], weight: list[float] | None = None, penalty: float = 2.0, l1: float = 1e-3, ridge: float = 1e-4, rounds: int = 1000, least: int = LEAST_TEXTS) -> Model:
    """Weighted logistic loss + penalty * mean squared logit change over the swaps.

    Features that differ between the classes are chosen first; FISTA with an L1
    step then finds the ones that matter, and a last fit of those, with a small
    ridge in place of L1, undoes the shrinking.
    """
    if set(y) != {0, 1}:
        return Model(-30.0, {})
    bags = [parts_of(set(words_of(t))) for t in texts]
    target, n = np.array(y, float), len(bags)
    share = np.array(weight if weight is not None else [1.0] * n)
    share = share / share.sum()
    counts = [Counter(x for b, v in zip(bags, y, strict=True) if v == k for x in b) for k in (0, 1)]
    size = [n - sum(y), sum(y)]

    def z(x: str) -> float:
        p = (counts[0][x] + counts[1][x]) / n
        return (counts[1][x] / size[1] - counts[0][x] / size[0]) / np.sqrt(max(1e-12, p * (1 - p) * (1 / size[0] + 1 / size[1])))

    pairs: Counter[tuple[str, str]] = Counter(p for t in texts for p in swaps(t))
    swapped = Counter()  # the features a swap takes out and puts in
    for (a, b), k in pairs.items():
        old, new = parts_of([a]), parts_of([b] if b else [])
        swapped[tuple(sorted(old - new)), tuple(sorted(new - old))] += k
    rated = sorted(((abs(z(x)), x) for x in counts[0].keys() | counts[1].keys() if counts[0][x] + counts[1][x] >= least), reverse=True)
    chosen = [x for v, x in rated[:MOST_FEATURES] if v >= LEAST_Z]
    chosen += sorted({x for out, into in swapped for x in (*out, *into)} - set(chosen))

    def matrices(features: list[str]):
        number = {x: i for i, x in enumerate(features)}
        hits = [(r, number[x]) for r, b in enumerate(bags) for x in sorted(b & number.keys())]
        rows, cols = (np.array([h[k] for h in hits], np.int64) for k in (0, 1))
        change = np.zeros((len(swapped), len(features)))
        for i, ((out, into), k) in enumerate(swapped.items()):
            scale = np.sqrt(penalty * k / sum(swapped.values()))
            for group, sign in ((out, -scale), (into, scale)):
                for x in group:
                    if x in number:
                        change[i, number[x]] += sign
        return rows, cols, change

    def solve(features: list[str], l1: float, ridge: float) -> tuple[np.ndarray, float]:
        rows, cols, change = matrices(features)
        m = len(features)
        product = lambda u: np.bincount(rows, u[cols], n)
        back = lambda r: np.bincount(cols, r[rows], m)
        u, lip = np.random.default_rng(3).normal(size=m + 1), 1.0
        for _ in range(30):  # the step, from a power iteration on the curvature's bound
            r = 0.25 * share * (product(u[:m]) + u[m])
            v = np.append(back(r) + 2 * change.T @ (change @ u[:m]) + ridge * u[:m], r.sum())
            lip = float(np.linalg.norm(v)) or 1.0
            u = v / lip
        step = 1 / (1.1 * lip)
        w = np.zeros(m + 1)
        w[m] = np.log((share @ target) / (1 - share @ target))
        q, t = w.copy(), 1.0
        for _ in range(rounds):
            r = share * (1 / (1 + np.exp(-np.clip(product(q[:m]) + q[m], -30, 30))) - target)
            new = q - step * np.append(back(r) + 2 * change.T @ (change @ q[:m]) + ridge * q[:m], r.sum())
            new[:m] = np.sign(new[:m]) * np.maximum(np.abs(new[:m]) - step * l1, 0)
            t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
            q, w, t = new + (t - 1) / t2 * (new - w), new, t2
        return w[:m], float(w[m])

    w, _ = solve(chosen, l1, 0.0)
    kept = [x for x, v in zip(chosen, w, strict=True) if abs(v) > 1e-4]
    w, bias = solve(kept, 0.0, ridge)
    return Model(bias, {x: float(v) for x, v in zip(kept, w, strict=True) if abs(v) > 1e-6})


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 5, held_out: int = 0, most: int = MOST, most_bytes: int = MOST_BYTES) -> Model:
    """The distinct words of the sampled texts' sentences are made by the executors; the driver gets that bounded sample only."""

    def shorten(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            kept = []
            for text in batch["text"]:
                # Sentences without identity terms serve as one bag of words.
                named = [s for s in _SENTENCE.split(text) if GROUP.keys() & set(words_of(s))]
                kept.append(". ".join([" ".join(sorted(set(words_of(text)) - GROUP.keys())), *named]))
            yield batch.assign(text=kept, size=[len(t.encode("utf-8", "surrogatepass")) for t in kept])

    sample = training_sample(docs, labels, label, folds, held_out, most)
    found = bounded(sample.mapInPandas(shorten, "doc_id long, text string, y int, weight double, size long"), most_bytes).toPandas().sort_values(["doc_id", "y", "text"])
    return fit(found["text"].tolist(), found["y"].tolist(), found["weight"].tolist())


def score(docs: DataFrame, model: Model, column: str = "text") -> DataFrame:
    """docs with score (0 to 1)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def rate(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([shared.value.score(t or "") for t in batch], dtype="float64")

    return docs.withColumn("score", rate(F.coalesce(F.col(column).cast("string"), F.lit(""))))


def op6(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    rated = score(docs.select("doc_id", "text"), train(docs, labels))
    return rated.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
