"""Quality classifier: a factorisation machine (operator 4).

The inputs are hashed words (binary counts, damped by length), structure
statistics of the text and its size as metadata. The model is
b + <w, x> + 1/2 * sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2), so that all
pairwise interactions cost time linear in the words. It is fitted by AdaGrad on
at most MOST labelled documents outside the held-out fold, of one text an id, and
at most features.MOST_BYTES of their vectors (documented bounds); features are
made by the executors, and only sparse vectors of that sample reach the driver.
Every document is scored in Arrow batches, on its
whole text.

Labels, lang, source and doc_id are no inputs. Edge cases: a null or empty text
has the structure of an empty text and a score like any other. Repeated rows
score alike. Without any labels of a class the score is 0.5 throughout. Empty
input, empty output; other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.features import MOST_BYTES, bounded, bucket, fold, training_sample

BITS = 16
RANK = 4
MOST = 4000
EPOCHS = 8
CUT = 0.7
#: Dense structure features, after the hashed words' buckets.
STRUCTURE = 14
SIZE = (1 << BITS) + STRUCTURE
_SYMBOLS = "#*$%&|<>"


def _known(cache: dict[str, int], words: set[str]) -> list[int]:
    out = []
    for w in words:
        if (b := cache.get(w)) is None:
            b = bucket(w, BITS)
            if len(cache) < 1 << 18:  # a memo of bounded size
                cache[w] = b
        out.append(b)
    return out


def vector(text: str, cache: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of one text: its distinct lower-case words scaled to length one, then the structure."""
    words = text.split()
    n, size = max(1, len(words)), max(1, len(text))
    idx = np.unique(np.array(_known(cache, set(text.lower().split())), np.int64))
    val = np.full(len(idx), 1 / np.sqrt(max(1, len(idx))))
    lines = [x for x in text.split("\n") if x.strip()]
    pairs = list(zip(words, words[1:], strict=False))
    symbols = sum(text.count(c) for c in _SYMBOLS)
    tails = sum(w[-1] in "!?.,;:" for w in words)
    s = [
        1.0 if words else 0.0,
        np.log1p(n) / 8,
        np.log1p(size) / 10,  # metadata: the document's size
        len(set(words)) / n,
        1 - len(set(pairs)) / max(1, len(pairs)),
        1 - len(set(lines)) / max(1, len(lines)),
        min(1.0, symbols / n),
        sum(map(str.isupper, words)) / n,
        min(1.0, text.count("!") / n),
        min(1.0, text.count("?") / n),
        tails / n,
        min(2.0, size / n / 10),
        sum(map(str.isalpha, words)) / n,
        min(1.0, len(lines) / n * 5),
    ]
    return np.concatenate((idx, (1 << BITS) + np.arange(STRUCTURE))), np.concatenate((val, s))


@dataclass
class Machine:
    bias: float
    w: np.ndarray
    v: np.ndarray

    def raw(self, idx: np.ndarray, val: np.ndarray) -> float:
        vx = self.v[idx] * val[:, None]
        total = vx.sum(0)
        return float(self.bias + self.w[idx] @ val + 0.5 * (total @ total - (vx * vx).sum()))

    def score(self, idx: np.ndarray, val: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.raw(idx, val), -30, 30))))


def fit(rows: list[tuple[np.ndarray, np.ndarray, int, float]], rank: int = RANK, epochs: int = EPOCHS, rate: float = 0.1, ridge: float = 1e-5) -> Machine:
    """AdaGrad over the rows (indices, values, label, weight), in a fixed random order."""
    rng = np.random.default_rng(7)
    m = Machine(0.0, np.zeros(SIZE), rng.normal(0, 0.05, (SIZE, rank)))
    gb, gw, gv = 1e-6, np.full(SIZE, 1e-6), np.full((SIZE, rank), 1e-6)
    if {r[2] for r in rows} != {0, 1}:
        return Machine(0.0, np.zeros(SIZE), np.zeros((SIZE, rank)))
    mean = np.mean([r[3] for r in rows])
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            idx, val, y, weight = rows[k]
            vx = m.v[idx] * val[:, None]
            total = vx.sum(0)
            z = m.bias + m.w[idx] @ val + 0.5 * (total @ total - (vx * vx).sum())
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * weight / mean
            dw = g * val + ridge * m.w[idx]
            dv = g * val[:, None] * (total[None, :] - vx) + ridge * m.v[idx]
            gb += g * g
            gw[idx] += dw * dw
            gv[idx] += dv * dv
            m.bias -= rate * g / np.sqrt(gb)
            m.w[idx] -= rate * dw / np.sqrt(gw[idx])
            m.v[idx] -= rate * dv / np.sqrt(gv[idx])
    return m


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 4, held_out: int = 2, most: int = MOST, most_bytes: int = MOST_BYTES) -> Machine:
    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache: dict[str, int] = {}
        for batch in batches:
            pairs = [vector(t, cache) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "y": batch["y"], "weight": batch["weight"], "size": [8 * len(p[0]) for p in pairs], "idx": [p[0].astype(np.int32) for p in pairs], "val": [p[1].astype(np.float32) for p in pairs]})

    sample = training_sample(docs, labels, label, folds, held_out, most)
    found = bounded(sample.mapInPandas(encode, "doc_id long, y int, weight double, size long, idx array<int>, val array<float>"), most_bytes).toPandas()
    found = found.sort_values(["doc_id", "y"], kind="stable")
    return fit([(np.asarray(i, np.int64), np.asarray(v, float), int(y), float(w)) for i, v, y, w in zip(found["idx"], found["val"], found["y"], found["weight"], strict=True)])


def score(docs: DataFrame, model: Machine, column: str = "text") -> DataFrame:
    """docs with score (0 to 1)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def rate(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cache: dict[str, int] = {}
        for batch in texts:
            yield pd.Series([shared.value.score(*vector(t or "", cache)) for t in batch], dtype="float64")

    return docs.withColumn("score", rate(F.coalesce(F.col(column).cast("string"), F.lit(""))))


def op4(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    rated = score(docs.select("doc_id", "text"), train(docs, labels))
    return rated.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
