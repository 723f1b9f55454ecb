"""Gradient boosting with leaf-wise trees on histograms, for several targets at once.

Features become bins once. A pass over the binned rows gives, for every target
that still grows, histograms of gradients by leaf, feature and bin: summed in
each task, added up by an ordinary aggregation. The driver holds histograms and
trees, never rows. A tree grows best leaf first. Leaves that it may come to are
split ahead, all in one pass, so a tree takes about as many passes as it is
deep, not one a leaf, and is the same tree. Of two siblings the smaller is
counted and the larger is the difference to the parent.

Gradients are rounded to multiples of 2 ** -FIXED and summed as integers, so
trees don't depend on partitions. All targets share the passes. Scores are
written every FRESH trees; newer trees are evaluated on the way. Rows come from
written tables only, so a lost executor costs its tasks, not the model.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.sources.scratch import materialize

BINS, FIXED, FRESH = 255, 20, 8
#: No leaf has less than this sum of second derivatives.
LEAST_HESSIAN = 1e-3


@dataclass(frozen=True)
class Boosting:
    trees: int = 800
    leaves: int = 31
    rate: float = 0.05
    patience: int = 50
    min_rows: int = 20
    columns: float = 0.9
    depth: int = 0  # no bound
    seed: int = 16


@dataclass(frozen=True)
class Target:
    """A column y to learn; rows whose weight is 0 or null are left out. binary: log-loss of 0 and 1, else squared error."""

    name: str
    y: Column
    weight: Column
    binary: bool


@dataclass
class Tree:
    """Nodes in the order they were made: a split (feature, bin, children) or a leaf (feature -1, value)."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int) -> tuple[int, int]:
        a = len(self.feature)
        self.feature[node], self.cut[node], self.left[node], self.right[node] = feature, cut, a, a + 1
        for x, fill in ((self.feature, -1), (self.cut, 0), (self.left, 0), (self.right, 0), (self.value, 0.0)):
            x += [fill, fill]
        return a, a + 1

    def leaf_of(self, bins: np.ndarray) -> np.ndarray:
        feature, cut, left, right = map(np.array, (self.feature, self.cut, self.left, self.right))
        node, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        while len(rows := rows[feature[node[rows]] >= 0]):
            at = node[rows]
            node[rows] = np.where(bins[rows, feature[at]] <= cut[at], left[at], right[at])
        return node

    def predict(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.leaf_of(bins)]


@dataclass
class Forest:
    """A fitted target: upper edges of each feature's bins, the score to start from, and trees."""

    edges: list[list[float]]
    start: float
    trees: list[Tree]
    binary: bool
    losses: list[float] = field(default_factory=list)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probabilities, or values within 0 and 1, of rows of features."""
        if not len(rows):
            return np.zeros(0)
        bins = np.stack([np.searchsorted(e, rows[:, j]) for j, e in enumerate(self.edges)], 1) if self.edges else np.zeros((len(rows), 0), int)
        s = self.start + sum((t.predict(bins) for t in self.trees), np.zeros(len(rows)))
        return _sigmoid(s) if self.binary else np.clip(s, 0.0, 1.0)

    def column(self, features: Column) -> Column:
        """The score of an array of features."""
        forest = self

        @F.pandas_udf(T.DoubleType())
        def scored(x: pd.Series) -> pd.Series:
            return pd.Series(forest.score(np.stack(x.to_list()).astype(float)) if len(x) else np.zeros(0))

        return scored(features)

    def to_json(self) -> str:
        return json.dumps({"edges": self.edges, "start": self.start, "binary": self.binary, "losses": self.losses, "trees": [vars(t) for t in self.trees]})

    @staticmethod
    def from_json(text: str) -> Forest:
        x = json.loads(text)
        return Forest(x["edges"], x["start"], [Tree(**t) for t in x["trees"]], x["binary"], x["losses"])


def _sigmoid(s: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(s, -500, 500)))


def bin_edges(rows: DataFrame, features: list[Column]) -> list[list[float]]:
    """Upper edges of at most BINS bins a feature, by quantiles in one pass; a value is in the first bin whose edge it doesn't exceed."""
    if not features:
        return []
    at = [k / BINS for k in range(1, BINS)]
    found = rows.agg(*[F.percentile_approx(c, at, 10_000).alias(f"q{j}") for j, c in enumerate(features)]).first()
    return [sorted({float(x) for x in found[j] or []}) for j in range(len(features))]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """A binary column of `width` bytes a row, without copying."""
    _, offsets, data = column.buffers()
    if not len(column) or not width:
        return np.zeros((len(column), width), np.uint8)
    start = int(np.frombuffer(offsets, np.int32)[column.offset])
    return np.frombuffer(data, np.uint8, len(column) * width, start).reshape(-1, width)


def _binned(rows: DataFrame, edges: list[list[float]], targets: list[Target], features: list[Column], is_val: Column) -> DataFrame:
    """x (a byte a feature), v (validation), and y, w, s of each target."""
    width = len(edges)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            bins = np.stack([np.searchsorted(e, flat[:, j]).astype(np.uint8) for j, e in enumerate(edges)], 1) if len(flat) else np.zeros((0, width), np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in bins], pa.binary()), *b.columns[1:]], names=["x", *b.schema.names[1:]])

    made = {"v": is_val}
    for k, t in enumerate(targets):
        made |= {f"y{k}": t.y.cast("double"), f"w{k}": F.when(t.y.isNotNull(), F.coalesce(t.weight.cast("double"), F.lit(0.0))).otherwise(F.lit(0.0))}
    table = rows.select(F.array(*features).cast("array<double>").alias("x"), *[F.coalesce(c, F.lit(False) if n == "v" else F.lit(0.0)).alias(n) for n, c in made.items()])
    kinds = ", ".join(["x binary", "v boolean", *[f"{c}{k} double" for k in range(len(targets)) for c in "yw"]])
    return table.mapInArrow(assign, kinds)


class _Growing:
    """One tree of one target while it grows.

    ahead is split wherever its histograms allow; tree is the part of it that
    splitting one leaf at a time, the best first, arrives at.
    """

    def __init__(self, cfg: Boosting, allowed: np.ndarray):
        self.cfg, self.allowed, self.tree, self.ahead = cfg, allowed, Tree(), Tree()
        #: By node of ahead: histograms of those not split yet, best splits, sums of both derivatives, depths.
        self.hist: dict[int, np.ndarray] = {}
        self.best: list[tuple[float, int, int] | None] = []
        self.sums: list[tuple[float, float]] = []
        self.level = [0]
        self.open: list[int] = []

    def add(self, hist: np.ndarray) -> None:
        node = len(self.best)
        self.hist[node] = hist
        self.sums.append((hist[0, :, 0].sum() / 2**FIXED, hist[0, :, 1].sum() / 2**FIXED))
        self.best.append(self._split(hist) if not self.cfg.depth or self.level[node] < self.cfg.depth else None)

    def _split(self, hist: np.ndarray) -> tuple[float, int, int] | None:
        """The best gain, its feature and bin; the first of equal ones."""
        left = hist.cumsum(1)
        g, h, n = left[0, -1, 0] / 2**FIXED, left[0, -1, 1] / 2**FIXED, left[0, -1, 2]
        gl, hl, nl = left[:, :, 0] / 2**FIXED, left[:, :, 1] / 2**FIXED, left[:, :, 2]
        gr, hr, nr = g - gl, h - hl, n - nl
        ok = (nl >= self.cfg.min_rows) & (nr >= self.cfg.min_rows) & (hl >= LEAST_HESSIAN) & (hr >= LEAST_HESSIAN) & self.allowed[:, None]
        if not ok.any():
            return None
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(ok, gl * gl / hl + gr * gr / hr - g * g / h, -np.inf)
        f, b = divmod(int(gain.argmax()), gain.shape[1])
        return (float(gain[f, b]), f, b) if gain[f, b] > 1e-12 else None

    def advance(self) -> bool:
        """Splits the best leaves as far as ahead is known; whether the tree is done."""
        self.tree, leaves = Tree(), {0: 0}  # nodes of the tree -> nodes of ahead
        while len(leaves) < self.cfg.leaves:
            order = sorted((n for n, a in leaves.items() if self.best[a]), key=lambda n: (-self.best[leaves[n]][0], n))
            if not order:
                break
            at = leaves[order[0]]
            if self.ahead.feature[at] < 0:
                self.open = [leaves[n] for n in order[: self.cfg.leaves - len(leaves)]]
                return False
            del leaves[order[0]]
            pair = self.tree.split(order[0], self.ahead.feature[at], self.ahead.cut[at])
            leaves |= zip(pair, (self.ahead.left[at], self.ahead.right[at]), strict=True)
        for n, a in leaves.items():
            g, h = self.sums[a]
            self.tree.value[n] = -self.cfg.rate * float(g) / float(h) if h > 0 else 0.0
        return True

    def wanted(self) -> list[tuple[int, int, int, bool]]:
        """(leaf of ahead, feature, bin, whether the left child is counted): the leaves that the budget could still reach, then the best of those below."""
        first = [a for a in self.open if a in self.hist]
        others = sorted((a for a in self.hist if self.best[a] and a not in first), key=lambda a: (-self.best[a][0], a))
        out = []
        for node in [*first, *others][: self.cfg.leaves]:
            _, f, b = self.best[node]
            n = self.hist[node][f, :, 2]
            out.append((node, f, b, bool(2 * n[: b + 1].sum() <= n.sum())))
        return out

    def learn(self, want: tuple[int, int, int, bool], hist: np.ndarray) -> None:
        node, f, b, is_left = want
        other = self.hist.pop(node) - hist
        self.ahead.split(node, f, b)
        self.level += [self.level[node] + 1] * 2
        for child in (hist, other) if is_left else (other, hist):
            self.add(child)


def _pass(table: DataFrame, width: int, binary: list[bool], starts: list[float], newer: dict[int, list[Tree]], jobs: dict[int, tuple[Tree, list[tuple[int, int, int, bool]] | None]], fresh: bool) -> tuple[dict[tuple[int, int], np.ndarray], dict[int, tuple[float, int]]]:
    """Histograms by target and place in its job's list (0 for the root, where the list is None); and, with roots, the validation losses."""
    cells = width * (BINS + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {(k, j): np.zeros((3, cells)) for k, (_, wants) in jobs.items() for j in range(len(wants) if wants is not None else 1)}
        losses = {k: np.zeros(2) for k, (_, wants) in jobs.items() if wants is None}
        base = np.arange(width) * (BINS + 1)
        for b in batches:
            x, v = _matrix(b.column("x"), width), b.column("v").to_numpy(zero_copy_only=False)
            for k, (tree, wants) in jobs.items():
                y, w = b.column(f"y{k}").to_numpy(), b.column(f"w{k}").to_numpy()
                s = b.column(f"s{k}").to_numpy() if not fresh else np.full(len(y), starts[k])
                for t in newer[k]:
                    s = s + t.predict(x)
                p = _sigmoid(s) if binary[k] else s
                if wants is None:
                    at = v & (w > 0)
                    loss = -np.where(y[at] > 0.5, np.log(np.maximum(p[at], 1e-15)), np.log(np.maximum(1 - p[at], 1e-15))) if binary[k] else (p[at] - y[at]) ** 2
                    losses[k] += np.rint(loss * 2**FIXED).sum(), at.sum()
                train = ~v & (w > 0)
                g = np.rint((p - y) * w * 2**FIXED)
                h = np.rint((p * (1 - p) if binary[k] else np.ones(len(p))) * w * 2**FIXED)
                leaf = tree.leaf_of(x) if wants is not None else None
                for j, want in enumerate(wants if wants is not None else [None]):
                    if want is None:
                        rows = np.flatnonzero(train)
                    else:
                        node, f, cut, is_left = want
                        rows = np.flatnonzero(train & (leaf == node) & ((x[:, f] <= cut) == is_left))
                    if len(rows):
                        at = (x[rows] + base).ravel()
                        for c, z in enumerate((g[rows], h[rows], np.ones(len(rows)))):
                            sums[k, j][c] += np.bincount(at, np.repeat(z, width), cells)
        for (k, j), s in sums.items():
            at = np.flatnonzero(s[2])
            yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (np.full(len(at), k), np.full(len(at), j), at, *s[:, at])], names=["k", "j", "cell", "g", "h", "n"])
        for k, (loss, n) in losses.items():
            yield pa.RecordBatch.from_arrays([pa.array([int(x)]) for x in (k, -1, 0, loss, 0, n)], names=["k", "j", "cell", "g", "h", "n"])

    parts = table.mapInArrow(run, "k long, j long, cell long, g long, h long, n long")
    found = parts.groupBy("k", "j", "cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n")).toArrow()  # targets * leaves * features * bins rows at most
    k, j, cell, g, h, n = (found.column(c).to_numpy() for c in ("k", "j", "cell", "g", "h", "n"))
    hists = {}
    for key in {(int(a), int(b)) for a, b in zip(k, j, strict=True) if b >= 0}:
        at = (k == key[0]) & (j == key[1])
        hist = np.zeros((cells, 3), np.int64)
        hist[cell[at]] = np.stack([g[at], h[at], n[at]], 1)
        hists[key] = hist.reshape(width, BINS + 1, 3)
    losses = {int(a): (int(x) / 2**FIXED, int(m)) for a, b, x, m in zip(k, j, g, n, strict=True) if b < 0}
    return hists, losses


def _allowed(cfg: Boosting, tree: int, width: int) -> np.ndarray:
    """The features that a tree may use: a share of all, by a hash."""
    keep = max(1, round(cfg.columns * width)) if width else 0
    order = sorted(range(width), key=lambda f: hashlib.md5(f"{cfg.seed}|{tree}|{f}".encode()).hexdigest())
    out = np.zeros(width, bool)
    out[order[:keep]] = True
    return out


def fit(rows: DataFrame, features: list[Column], targets: list[Target], is_val: Column, cfg: Boosting = Boosting()) -> dict[str, Forest]:
    """A forest for each target with rows to train on, and two classes if it is binary.

    Training ends where the loss on validation rows (not weighted) has not
    fallen for cfg.patience trees, and keeps the trees up to its least value.
    """
    rows = materialize(rows.select(*[c.alias(f"f{j}") for j, c in enumerate(features)], is_val.alias("v"), *[c.alias(f"{n}{k}") for k, t in enumerate(targets) for n, c in (("y", t.y.cast("double")), ("w", t.weight.cast("double")))]))
    features = [F.col(f"f{j}").cast("double") for j in range(len(features))]
    targets = [Target(t.name, F.col(f"y{k}"), F.col(f"w{k}"), t.binary) for k, t in enumerate(targets)]
    v = F.coalesce(F.col("v"), F.lit(False))
    edges = bin_edges(rows.where(~v), features)
    binary, width = [t.binary for t in targets], len(edges)
    table = materialize(_binned(rows, edges, targets, features, v))
    seen = table.where("NOT v").agg(*[x for k in range(len(targets)) for x in (F.sum(f"w{k}"), F.sum(F.col(f"w{k}") * F.col(f"y{k}")))]).first()
    means = {k: seen[2 * k + 1] / seen[2 * k] for k in range(len(targets)) if seen[2 * k]}
    active = {k: m for k, m in means.items() if not binary[k] or 0 < m < 1}
    starts = [float(np.log(active[k] / (1 - active[k]))) if k in active and binary[k] else float(active.get(k, 0.0)) for k in range(len(targets))]
    forests = {k: Forest(edges, starts[k], [], binary[k]) for k in active}
    newer: dict[int, list[Tree]] = {k: [] for k in active}
    growing, fresh, round_ = sorted(active) if width else [], True, 0
    while growing:
        grown = {k: _Growing(cfg, _allowed(cfg, round_, width)) for k in growing}
        hists, losses = _pass(table, width, binary, starts, newer, {k: (grown[k].ahead, None) for k in growing}, fresh)
        for k in growing:
            forest = forests[k]
            if losses.get(k, (0, 0))[1]:
                forest.losses.append(losses[k][0] / losses[k][1])
        late = {k for k in growing if forests[k].losses and len(forests[k].losses) - 1 - int(np.argmin(forests[k].losses)) >= cfg.patience}
        growing = [k for k in growing if k not in late and len(forests[k].trees) < cfg.trees and (k, 0) in hists]
        for k in growing:
            grown[k].add(hists[k, 0])
        open_ = [k for k in growing if not grown[k].advance()]
        while open_:
            wants = {k: grown[k].wanted() for k in open_}
            hists, _ = _pass(table, width, binary, starts, newer, {k: (grown[k].ahead, wants[k]) for k in open_}, fresh)
            for k in open_:
                for j, want in enumerate(wants[k]):
                    grown[k].learn(want, hists[k, j])
            open_ = [k for k in open_ if not grown[k].advance()]
        growing = [k for k in growing if len(grown[k].tree.feature) > 1]
        for k in growing:
            forests[k].trees.append(grown[k].tree)
            newer[k].append(grown[k].tree)
        round_ += 1
        if growing and round_ % FRESH == 0:
            table, fresh = _rescored(table, width, starts, newer, sorted(active), fresh), False
            newer = {k: [] for k in active}
    for forest in forests.values():
        if forest.losses:
            del forest.trees[int(np.argmin(forest.losses)) :]
    return {targets[k].name: f for k, f in forests.items()}


def _rescored(table: DataFrame, width: int, starts: list[float], newer: dict[int, list[Tree]], active: list[int], fresh: bool) -> DataFrame:
    """The table with the scores of all trees so far, written anew."""
    kept = [c for c in table.columns if not c.startswith("s")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, made = _matrix(b.column("x"), width), []
            for k in active:
                s = np.full(b.num_rows, starts[k]) if fresh else b.column(f"s{k}").to_numpy()
                made.append(pa.array(s + sum((t.predict(x) for t in newer[k]), np.zeros(b.num_rows))))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], *made], names=[*kept, *[f"s{k}" for k in active]])

    kinds = ", ".join([f"{n} {t}" for n, t in table.select(*kept).dtypes] + [f"s{k} double" for k in active])
    return materialize(table.mapInArrow(run, kinds))
