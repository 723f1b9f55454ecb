"""Leaf-wise boosting against a plain version, against level-wise trees, and in any partitioning."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.functions import schema
from plumbline.operators import boosting, features, metrics, modeling
from plumbline.operators.boosting import Boosting, Forest, Target, fit
from plumbline.plans import catalog

NAMES = "abcdef"


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 6))
    x[:, 3] = rng.integers(0, 5, 500)
    z = 2 * x[:, 0] - x[:, 1] * x[:, 2] + x[:, 3] - 2 + rng.normal(size=500)
    return x, (z > 0).astype(float), 1 / (1 + np.exp(-z)), np.arange(500) % 5 == 0


@pytest.fixture(scope="module")
def table(spark, data):
    x, y, r, v = data
    w = np.where(y > 0, 1.5, 0.75)
    return spark.createDataFrame([(*map(float, x[i]), float(y[i]), float(r[i]), float(w[i]), bool(v[i])) for i in range(500)], ", ".join([*[f"{c} double" for c in NAMES], "y double", "r double", "w double", "v boolean"]))




def columns(n=6):
    return [F.col(c) for c in NAMES[:n]]


def targets():
    return [Target("y", F.col("y"), F.col("w"), True), Target("r", F.col("r"), F.lit(1.0), False)]


CFG = Boosting(trees=4, leaves=9, rate=0.2, min_rows=10, columns=0.7)


@pytest.fixture(scope="module")
def forests(table):
    return fit(table.repartition(3), columns(), targets(), F.col("v"), CFG)


def plain(x, y, w, binary, cfg, rounds):
    """One leaf at a time is split, always the one with the greatest gain; its rows are counted anew."""
    edges = [sorted(set(np.quantile(c, np.arange(1, 255) / 255, method="inverted_cdf"))) for c in x.T]
    bins = np.stack([np.searchsorted(e, c) for e, c in zip(edges, x.T, strict=True)], 1)
    mean = (w * y).sum() / w.sum()
    score = np.full(len(y), np.log(mean / (1 - mean)) if binary else mean)
    shapes = []
    for k in range(rounds):
        p = 1 / (1 + np.exp(-score)) if binary else score
        g, h = (p - y) * w, (p * (1 - p) if binary else np.ones(len(y))) * w
        allowed = boosting._allowed(cfg, k, x.shape[1])

        def best(rows):
            found = (0.0, None)
            for f in np.flatnonzero(allowed):
                for b in range(256):
                    left = bins[rows, f] <= b
                    if min(left.sum(), (~left).sum()) < cfg.min_rows:
                        continue
                    a, c = rows[left], rows[~left]
                    gain = g[a].sum() ** 2 / h[a].sum() + g[c].sum() ** 2 / h[c].sum() - g[rows].sum() ** 2 / h[rows].sum()
                    if gain > found[0] + 1e-9:
                        found = (gain, (int(f), b))
            return found

        nodes = {0: np.arange(len(y))}
        gains, splits, size = {0: best(nodes[0])}, {}, 1
        while len(nodes) < cfg.leaves:
            n = max(nodes, key=lambda i: (gains[i][0], -i))
            if gains[n][1] is None:
                break
            f, b = splits[n] = gains[n][1]
            rows = nodes.pop(n)
            for side in (rows[bins[rows, f] <= b], rows[bins[rows, f] > b]):
                nodes[size], gains[size] = side, best(side)
                size += 1
        for rows in nodes.values():
            score[rows] -= cfg.rate * g[rows].sum() / h[rows].sum()
        shapes.append(splits)
    return shapes, score


@pytest.mark.parametrize("name", ["y", "r"])
def test_equals_one_leaf_at_a_time(forests, data, name):
    x, y, r, v = data
    target, w = (y, np.where(y > 0, 1.5, 0.75)) if name == "y" else (r, np.ones(500))
    forest = forests[name]
    shapes, score = plain(x[~v], target[~v], w[~v], name == "y", CFG, len(forest.trees))
    assert len(forest.trees) == 4
    for tree, want in zip(forest.trees, shapes, strict=True):
        assert {i: (f, c) for i, (f, c) in enumerate(zip(tree.feature, tree.cut, strict=True)) if f >= 0} == want
    want = 1 / (1 + np.exp(-score)) if name == "y" else np.clip(score, 0, 1)
    assert np.allclose(forest.score(x[~v]), want, atol=1e-5)


def test_partitions_dont_matter(table, forests):
    again = fit(table.repartition(7, "a"), columns(), targets()[:1], F.col("v"), CFG)
    assert again["y"].to_json() == forests["y"].to_json()
    assert Forest.from_json(forests["y"].to_json()).to_json() == forests["y"].to_json()


def test_passes_are_few(table, monkeypatch):
    """A tree takes a pass a level at most, not one a leaf."""
    calls = []
    once = boosting._pass
    monkeypatch.setattr(boosting, "_pass", lambda *a: calls.append(1) or once(*a))
    got = fit(table, columns(), targets()[:1], F.lit(False), Boosting(trees=1, leaves=31, min_rows=3))
    tree = got["y"].trees[0]
    depth = lambda n: 1 + max(depth(tree.left[n]), depth(tree.right[n])) if tree.feature[n] >= 0 else 0
    assert tree.feature.count(-1) == 31 and len(calls) <= depth(0) + 2 < 20


def test_scores_are_written_between(table, data, monkeypatch):
    x, y, _, v = data
    want = fit(table, columns(), targets(), F.col("v"), Boosting(trees=3, leaves=4, rate=0.3))
    monkeypatch.setattr(boosting, "FRESH", 1)
    got = fit(table, columns(), targets(), F.col("v"), Boosting(trees=3, leaves=4, rate=0.3))
    assert {k: f.to_json() for k, f in got.items()} == {k: f.to_json() for k, f in want.items()}
    p = got["y"].score(x[v])
    assert got["y"].losses[3] == pytest.approx(float(-np.where(y[v] > 0, np.log(p), np.log(1 - p)).mean()), abs=1e-5)


def test_stops_on_validation(spark):
    """Labels without a pattern: training ends after the patience, and keeps the trees up to the least loss."""
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(float(a), float(b), int(rng.random() < 0.5), i % 2 == 0) for i, (a, b) in enumerate(rng.normal(size=(200, 2)))], "a double, b double, y int, v boolean")
    forest = fit(df, columns(2), [Target("y", F.col("y"), F.lit(1.0), True)], F.col("v"), Boosting(trees=60, leaves=4, rate=0.5, patience=2, min_rows=5))["y"]
    assert len(forest.losses) < 20 and len(forest.trees) == int(np.argmin(forest.losses))


def test_odd_tables(spark, table):
    none = table.limit(0)
    assert fit(none, columns(), targets(), F.col("v"), CFG) == {}
    assert set(fit(table.withColumn("y", F.lit(1.0)), columns(), targets(), F.col("v"), Boosting(trees=1))) == {"r"}
    few = fit(table.limit(15), columns(), targets()[1:], F.lit(None).cast("boolean"), CFG)["r"]
    assert few.trees == [] and few.score(np.zeros((2, 6))).tolist() == [pytest.approx(few.start)] * 2
    left_out = fit(table.withColumn("r", F.when(F.col("v"), F.col("r"))), columns(), targets()[1:], F.col("v"), CFG)
    assert left_out == {}
    same = fit(table.select(*[F.lit(1.0).alias(c) for c in NAMES], "r", "v"), columns(), targets()[1:], F.col("v"), CFG)["r"]
    assert same.trees == []


def test_against_level_wise_trees(spark):
    """On the labels' held-out fold, the loss is no higher than that of MLlib's heads with as many trees."""
    sf = "/root/testdata/sf0.01"
    docs = schema.documents_as_reviews(spark.read.parquet(f"{sf}/documents.parquet"))
    made = features.features(docs, 1735689600, groups=("text_form", "language"))
    truth = spark.read.parquet(f"{sf}/labels.parquet").select(F.col("doc_id").cast("string").alias("review_id"), F.col("quality").cast("double").alias("spam_low_quality"))
    known = modeling.materialize(made.join(truth, "review_id"))
    fold = F.crc32(F.col("review_id").cast("binary")) % 4
    train, val, test = known.where(fold > 1), known.where(fold == 1), known.where(fold == 0)
    auc, loss = {}, {}
    for booster, more in (("leaf", {"rate": 0.1, "leaves": 15}), ("level", {"rate": 0.1, "depth": 4})):
        cfg = modeling.Training(exclude=("review_id", "gmap_id", "user_id", "text", "time", "rating"), booster=booster, trees=15, calibrate=None, min_rows=10, **more)
        heads = modeling.train(train, val, cfg, ("spam_low_quality",))
        pairs = modeling.predict(test, heads).join(test.select("review_id", "spam_low_quality"), "review_id").select(F.col("spam_low_quality").cast("int").alias("y"), F.col("pred_spam_low_quality").alias("p"))
        auc[booster], loss[booster] = metrics.ranking(pairs).first()["roc_auc"], metrics.brier(pairs).first()["brier"]
    assert auc["leaf"] > 0.6 and auc["leaf"] >= auc["level"] - 0.02 and loss["leaf"] <= loss["level"] + 0.02, (auc, loss)


def test_single_reviews_need_no_job(spark, data, tmp_path):
    x, y, r, _ = data
    df = spark.createDataFrame([(str(i), *map(float, x[i, :3]), float(y[i]), float(r[i])) for i in range(500)], "review_id string, a double, b double, c double, ads_promo double, relevancy_score double")
    train, val = df.where("review_id % 4 > 0"), df.where("review_id % 4 = 0")
    for booster in ("leaf", "level"):
        heads = modeling.train(train, val, modeling.Training(trees=4, depth=3, rate=0.3, booster=booster))
        modeling.save(heads, str(tmp_path / booster), spark)
        heads = modeling.load(str(tmp_path / booster), spark)
        row = val.first()
        want = modeling.predict(val.where(F.col("review_id") == row.review_id), heads).first()
        tracker, group = spark.sparkContext.statusTracker(), f"single-{booster}"
        spark.sparkContext.setJobGroup(group, group)
        got = modeling.predict_one(heads, {"a": row.a, "b": row.b, "c": row.c, "text": "ignored"})
        assert not tracker.getJobIdsForGroup(group)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert got == {k: pytest.approx(want[f"pred_{k}"]) for k in heads}


def test_documents_are_read_once(spark):
    """Predictions read the features that training read, and search no text again."""
    got = catalog.train_predict(spark, "/root/testdata/sf0.001")
    assert got.inputFiles() and not any("documents.parquet" in f for f in got.inputFiles())
    assert got.count() == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
