"""Plans that don't grow with moves or files, and orders that no single task holds."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from plumbline.operators import features, labeling, metrics, sampling, splitting
from plumbline.operators.ranges import placed
from plumbline.sources import io, scratch


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_places_are_those_of_a_window(spark):
    df = spark.createDataFrame([(i % 3 if i % 7 else None, i) for i in range(3000)], "k int, id int")
    key = F.md5(F.col("id").cast("string"))
    w = Window.partitionBy("k")
    want = df.select("id", F.row_number().over(w.orderBy(key, "id")).alias("n"), F.count(F.lit(1)).over(w).alias("t")).collect()
    got = placed(df, ["k"], key, ["id"]).select("id", "__n", "__total").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    cut = placed(df, ["k"], key, ["id"], F.col("__start") < 5).where("__n <= 5").select("id", "__n").collect()
    assert sorted(map(tuple, cut)) == sorted((r.id, r.n) for r in want if r.n <= 5)


def test_windows_are_cut_into_ranges(spark):
    groups = spark.createDataFrame([(str(i), "genuine") for i in range(50)], "gmap_id string, label string")
    text = plan(splitting.assign(groups))
    assert "SinglePartition" not in text and "__range" in text
    pool = spark.createDataFrame([(str(i), i % 2) for i in range(50)], "review_id string, rating int")
    assert "__range" in plan(sampling.proportional_sample(pool, ["rating"], 10, 1))


def test_quantiles_are_exact(spark):
    rng = random.Random(1)
    for values in ([rng.random() for _ in range(2001)], [0.0] * 500 + [1e-9, 1.0], [3.0], [1.0, 2.0], [rng.choice([0.1, 0.2, 0.9]) for _ in range(100)], [-1e300, 1e300, 0.0]):
        df = spark.createDataFrame([(v,) for v in values], "x double")
        for q in (0.0, 0.33, 0.5, 0.95, 0.97, 1.0):
            assert np.isclose(splitting.quantile(df, q), np.percentile(values, 100 * q), rtol=1e-12, atol=1e-300), (len(values), q)
    assert splitting.quantile(spark.createDataFrame([], "x double"), 0.5) is None


def test_rebalance_in_the_worst_case(spark):
    """Every label is short in both splits: all sixteen moves happen, and the plan stays short."""
    labels = splitting.BINARY
    rows = [(f"g{i}", "train", *[1 if i % 4 == j else 0 for j in range(4)]) for i in range(80)]
    table = spark.createDataFrame(rows, ", ".join(["gmap_id string", "split string", *[f"{k}_bin int" for k in labels]]))
    out = splitting.rebalance(table, labels, {"val": 5, "test": 5})
    assert plan(out).count("Join") <= 2
    for s in ("val", "test"):
        assert out.where(F.col("split") == s).agg(*[F.sum(f"{k}_bin") for k in labels]).first() == (5, 5, 5, 5)
    assert out.count() == 80


def test_group_aggregates_have_no_window(spark):
    df = spark.createDataFrame([("g", "u", 1, "a"), ("g", None, 3, "a")], "gmap_id string, user_id string, rating int, text string")
    joined, made = features.group_windows(df)
    assert "Window" not in plan(joined.select(*made.values()))


def test_best_threshold_has_no_window_over_all(spark):
    rng = random.Random(2)
    rows = [(int(rng.random() < p), p) for p in (round(rng.random(), 4) for _ in range(3000))]
    df = spark.createDataFrame(rows, "y int, p double")
    got = metrics.best_f1(df).first()
    points = sorted({p for _, p in rows})
    picked = {points[int(k * (len(points) - 1) / 511)] for k in range(512)} | set(metrics.COARSE)
    f1 = lambda t: 2 * sum(y for y, p in rows if p >= t) / (sum(p >= t for _, p in rows) + sum(y for y, _ in rows))
    best = max(round(f1(t), 12) for t in picked)
    assert round(got.f1, 12) == best and got.threshold == min(t for t in picked if round(f1(t), 12) == best)
    c = {r.p: r for r in metrics.curve(df).collect()}
    assert all(c[p]["rank"] == i for i, p in enumerate(reversed(points)))


def test_one_reader_a_format(spark, tmp_path):
    for i in range(6):
        (tmp_path / f"review-{i}.jsonl").write_text('{"gmap_id": "g", "text": "good", "rating": %d}\n' % i)
        spark.createDataFrame([("g", "fine", i)], "gmap_id string, text string, rating long").coalesce(1).write.parquet(str(tmp_path / f"review-{i}.parquet"))
    (tmp_path / "meta-a.json").write_text('[{"gmap_id": "g", "name": "n"}]')
    reviews, meta = io.read_sources(spark, [f"{tmp_path}/*"])
    assert reviews.count() == 12 and meta.count() == 1
    assert plan(reviews).count("Union") == 1 and plan(reviews).count("FileScan") == 2


def test_repair_prompt(spark):
    df = spark.createDataFrame([("1", "fine place")], "review_id string, text string")

    def stubborn(chat):
        return '{"ads_promo": 0.5}' if "nothing else" in chat[-1]["content"] and "Review:\nfine place" in chat[-1]["content"] else "I'd say it is fine."

    assert labeling.score(df, make=lambda: stubborn).first()["ads_promo"] == 0.5
    assert labeling.score(df, make=lambda: stubborn, retries=0).first()["ads_promo"] == 0.0
    found = labeling.answers(df, make=lambda: stubborn).first()
    assert found["answer"] == '{"ads_promo": 0.5}' and "nothing else" in found["prompt"]


def test_prompts_and_raw_answers(spark, tmp_path):
    df = spark.createDataFrame([("1", "fine place")], "review_id string, text string")
    shots = [{"input": {"text": "x"}, "output": {"ads_promo": 1}}]
    seen = lambda chat: '{"ads_promo": %s}' % (1 if chat[0]["content"] == "Be strict." and len(chat) == 4 else 0)
    got = labeling.silver(df, make=lambda: seen, prompt={"system": "Be strict.", "shots": shots}, debug=str(tmp_path))
    assert got.first()["ads_promo"] == 1.0
    assert any("ads_promo" in p.read_text() for p in tmp_path.rglob("*.json"))


def test_scratch_is_cleared(spark):
    df = scratch.materialize(spark.range(3))
    assert df.count() == 3 and scratch.clear(spark) >= 1 and scratch.clear(spark) == 0


def test_cached_reader(spark, tmp_path):
    path = str(tmp_path / "x.parquet")
    spark.range(3).write.parquet(path)
    first, again = io.read_cached(spark, path), io.read_cached(spark, path)
    assert first.count() == again.count() == 3 and again.storageLevel.useMemory
    spark.catalog.clearCache()


@pytest.mark.parametrize("n", [10, 29, 47, 99])
def test_a_cut_between_equal_scores_is_that_score(spark, n):
    """At these sizes the weighted sum of two equal scores rounds to below them; rows at the cut aren't above it."""
    df = spark.createDataFrame([(0.949,)] * n, "ads_promo double")
    assert splitting.quantile(df.toDF("x"), 0.95) == 0.949
    assert splitting.binarize(df, splitting.cuts(df, {"ads_promo": 5})).agg({"ads_promo_bin": "sum"}).first()[0] == 0


@pytest.mark.parametrize("reverse", [False, True])
def test_equal_means_are_equal_in_any_order_of_rows(spark, reverse):
    """Sums of doubles of these scores differ in the last digit by the order of rows; the labels' order decides."""
    scores = [0.1, 0.2, 0.3, 0.7, 0.6, 1.0, 0.4]
    rows = [("g", x, y, 1, 1) for x, y in zip(scores, reversed(scores), strict=True)]
    assert np.cumsum(scores)[-1] != np.cumsum(scores[::-1])[-1]
    a, b = ("irrelevant", "ads_promo") if reverse else ("ads_promo", "irrelevant")
    df = spark.createDataFrame(rows, f"gmap_id string, {a} double, {b} double, {a}_bin int, {b}_bin int").coalesce(1)
    for labels in ((a, b), (b, a)):
        assert splitting.group_labels(df, "gmap_id", labels).first()["label"] == labels[0]
    # Means of larger numbers are compared as doubles.
    df = spark.createDataFrame([("g", 1e300, 2e300, 1, 1), ("h", 3e7, 2e7, 1, 1)], df.schema)
    assert dict(splitting.group_labels(df, "gmap_id", (a, b)).collect()) == {"g": b, "h": a}
