"""Rules, policy, metrics, joins, sampling, splitting and labels on small tables."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from plumbline.functions.schema import BINARY, CONTINUOUS, SCORES
from plumbline.operators import annotation, features, joins, labeling, metrics, modeling, policy, rules, sampling, splitting


def test_rules(spark):
    rows = [(6, True, 3, 2, 0, 0), (5, False, 0, 1, 1, 1)]
    df = spark.createDataFrame([("r", n, "short" if s else "long", s, 1 if s else 0, 0, e, d, o, v) for n, s, e, d, o, v in rows], "id string, n int, length_bucket string, has_short_url boolean, punct_runs int, elong_runs int, emoji_count int, text_dup_count_place int, offtopic_hits int, nonvisit_hits int")
    flags = [c for c in rules.FLAGS if c != "has_short_url"]
    df = df.withColumns({c: F.col("n") - F.col("has_short_url").cast("int") > i for i, c in enumerate(flags)})
    a, b = rules.rules(df.withColumns({"promo_hits": F.lit(0), "contact_hits": F.lit(0)})).collect()
    assert a.rule_ads_score == pytest.approx(6 / 14) and a.rule_ads_strong == 1 and b.rule_ads_strong == 0
    assert a.rule_spam_score == pytest.approx(5 / 6) and a.rule_spam_strong == 1
    assert (a.rule_none, b.rule_irrelevant_strong, b.rule_rant_strong, b.rule_none) == (0, 1, 1, 0)
    assert rules.rules(spark.createDataFrame([("x",)], "id string")).first()["rule_none"] == 1


def decided(spark, **p):
    known = dict.fromkeys((*BINARY, *CONTINUOUS), None) | p
    return policy.decide(spark.createDataFrame([tuple(known.values())], ", ".join(f"pred_{k} double" for k in known))).first()


def test_policy(spark):
    good = dict.fromkeys(BINARY, 0.0) | dict.fromkeys(CONTINUOUS, 1.0)
    r = decided(spark, **good)
    assert (r.action, r.final, r.reasons) == ("allow", "genuine", ["genuine_score>=0.85"])
    r = decided(spark, **good | {"spam_low_quality": 0.8, "ads_promo": 0.95, "irrelevant": 0.8})
    assert (r.action, r.final, r.reasons) == ("remove", "not_genuine", ["spam_low_quality>=0.80", "ads_promo>=0.95"])
    r = decided(spark, **good | {"visit_likelihood": 0.35})
    assert (r.action, r.final, r.reasons) == ("review", "review", ["visit_likelihood<=0.35"])
    r = decided(spark)
    assert (r.action, r.final, r.genuine_score, r.reasons) == ("allow", "not_genuine", None, ["genuine_score<0.65"])
    r = decided(spark, **good | {"spam_low_quality": float("nan")})
    assert (r.action, r.final) == ("allow", "not_genuine")


def test_policy_is_monotone(spark):
    rng = random.Random(5)
    rows = [[rng.random() for _ in range(6)] for _ in range(200)]
    cols = ", ".join(f"pred_{k} double" for k in (*BINARY, *CONTINUOUS))
    rank = {"allow": 0, "review": 1, "remove": 2}
    for i in range(4):
        worse = [[min(1.0, x + 0.3) if j == i else x for j, x in enumerate(r)] for r in rows]
        a, b = (policy.decide(spark.createDataFrame(x, cols)).select("action").collect() for x in (rows, worse))
        assert all(rank[x.action] <= rank[y.action] for x, y in zip(a, b, strict=True))


def test_browse(spark):
    df = spark.createDataFrame([("a", 0.1, 0.1, 0.1, 0.1, 0.9, 0.9), ("b", 0.6, 0.1, 0.1, 0.1, 0.9, 0.9), ("c", None, 0.1, 0.1, 0.1, 0.9, 0.9)], "review_id string, " + ", ".join(f"pred_{k} double" for k in (*BINARY, *CONTINUOUS)))
    assert [r.genuine for r in policy.browse_policy(df).orderBy("review_id").collect()] == [True, False, True]
    assert [r.review_id for r in policy.held_only(df).collect()] == ["b"]
    assert policy.head_thresholds({"ads_promo": 0.0})["ads_promo"] == policy.THRESHOLD_EDGE
    assert policy.search(df.withColumn("text", F.col("review_id")), "zz").count() == 3


def pairs(n=60, seed=1):
    rng = random.Random(seed)
    return [(rng.randint(0, 1), round(rng.random(), 1)) for _ in range(n)]


def test_ranking(spark):
    for seed in range(3):
        z = pairs(seed=seed)
        got = metrics.ranking(spark.createDataFrame(z, "y int, p double")).first()
        pos, neg = [p for y, p in z if y], [p for y, p in z if not y]
        auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / len(pos) / len(neg)
        steps = sorted({p for _, p in z}, reverse=True)
        ap, before = 0.0, 0
        for s in steps:
            tp, n = sum(p >= s for p in pos), sum(p >= s for _, p in z)
            ap += (tp - before) / len(pos) * tp / n
            before = tp
        assert got.roc_auc == pytest.approx(auc) and got.pr_auc == pytest.approx(ap)
        flipped = metrics.ranking(spark.createDataFrame([(y, -p) for y, p in z], "y int, p double")).first()
        assert flipped.roc_auc == pytest.approx(1 - auc)
    assert metrics.ranking(spark.createDataFrame([(1, 0.5)], "y int, p double")).first()["roc_auc"] is None
    assert metrics.ranking(spark.createDataFrame([], "y int, p double")).first()["roc_auc"] is None


def test_best_f1(spark):
    z = pairs(40, 9)
    got = metrics.best_f1(spark.createDataFrame(z, "y int, p double")).first()
    f1 = lambda t: 2 * sum(y for y, p in z if p >= t) / (sum(p >= t for _, p in z) + sum(y for y, _ in z))
    tries = sorted({p for _, p in z} | set(metrics.COARSE))
    best = max(round(f1(t), 12) for t in tries)
    assert got.threshold == min(t for t in tries if round(f1(t), 12) == best) and got.f1 == pytest.approx(best)


def test_confusion_and_bins(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.6), (1, 0.1), (0, 1.0)], "y int, p double")
    r = metrics.confusion(df, 0.6).first()
    assert (r.tp, r.fp, r.tn, r.fn, r.precision, r.recall) == (1, 2, 0, 1, pytest.approx(1 / 3), 0.5)
    assert metrics.calibration(df).agg(F.sum("n")).first()[0] == 3
    empty = metrics.confusion(df.limit(0), 0.5).first()
    assert (empty.tp, empty.f1) == (0, 0.0)


def test_joins(spark):
    reviews = spark.createDataFrame([("g", "u", 1, "t"), ("h", "u", 1, "t")], "gmap_id string, user_id string, time long, text string")
    meta = spark.createDataFrame([("g", "b", "x"), ("g", "a", "y")], "gmap_id string, name string, text string")
    got = {r.gmap_id: r.name for r in joins.merge_metadata(reviews, meta).collect()}
    assert got == {"g": "a", "h": None}
    assert "review_id" in joins.merge_metadata(reviews, None).columns
    labels = spark.createDataFrame([("1", 0.2, 5), ("1", 0.3, 6)], "review_id string, ads_promo double, x int")
    base = spark.createDataFrame([("1", "p", 9)], "review_id string, place string, x int")
    out = joins.merge_with_base(base, labels)
    assert out.columns == ["review_id", "ads_promo", "x", "place"] and out.count() == 1
    rows = spark.createDataFrame([("1", 1)], "review_id string, rule_ads_strong int")
    assert joins.fuse_with_rules(labels.limit(1), rows).first()["ads_promo"] == 0.9
    assert joins.fuse_with_rules(labels, rows.drop("review_id")).count() == 2


def test_windows(spark):
    df = spark.createDataFrame([("g", "u", 1, "a"), ("g", "v", 3, "a"), ("h", "u", 5, "a"), (None, None, 2, None)], "gmap_id string, user_id string, rating int, text string")
    joined, made = features.group_windows(df)
    got = joined.select("rating", *[v.alias(k) for k, v in made.items()]).orderBy("rating").collect()
    assert [r.place_review_count for r in got] == [2, None, 2, 1]
    assert [r.text_dup_count_place for r in got] == [2, 1, 2, 1]
    assert got[0].place_rating_std == pytest.approx(2**0.5) and got[3].place_rating_std == 0.0


def test_sampler(spark):
    rng = random.Random(2)
    rows = [(str(i), f"g{rng.randint(0, 40)}", f"u{rng.randint(0, 300)}", 1_000_000 * rng.randint(1500, 1700), rng.randint(1, 5), "word " * rng.randint(1, 60)) for i in range(1500)]
    df = spark.createDataFrame(rows, "review_id string, gmap_id string, user_id string, time long, rating int, text string")
    cfg = sampling.Sampler(target=400)
    got = sampling.sample_reviews(df, cfg, 1_700_000_000).collect()
    assert len(got) == len({r.review_id for r in got}) == 400
    for key, most in (("gmap_id", 50), ("user_id", 10)):
        assert all(len(list(g)) <= most for _, g in itertools.groupby(sorted(r[key] for r in got)))
    assert sum(1_700_000_000 - r.time <= 730 * 86400 for r in got) >= 120
    assert sorted(r.review_id for r in sampling.sample_reviews(df.repartition(7), cfg, 1_700_000_000).collect()) == sorted(r.review_id for r in got)
    assert sampling.sample_reviews(df.limit(30), cfg, 0).count() == 30


def test_quotas(spark):
    counts = spark.createDataFrame([(1, 5), (2, 5), (3, 5), (None, 1)], "k int, count long")
    q = {r.k: r.quota for r in sampling.quotas(counts, ["k"], 10).collect()}
    assert sum(q.values()) == 10 and q[1] >= q[3]


def test_majority(spark):
    rows = [("a", 1, 0, 1, 0, 0.2, None, "x"), ("a", 0, 0, 1, 0, 0.4, 0.5, "y"), ("b", 0, 0, 0, 0, 1.0, 1.0, "x")]
    df = spark.createDataFrame(rows, "review_id string, " + ", ".join(f"{k} int" for k in BINARY) + ", " + ", ".join(f"{k} double" for k in CONTINUOUS) + ", annotator_id string")
    got = {r.review_id: r for r in annotation.ingest(spark.createDataFrame([("a",), ("c",)], "review_id string"), df).collect()}
    assert (got["a"].ads_promo, got["a"].spam_low_quality, got["a"].irrelevant, got["a"].n_annot) == (1, 0, 1, 2)
    assert got["a"].relevancy_score == pytest.approx(0.3) and got["a"].visit_likelihood == 0.5 and got["c"].ads_promo is None


def test_split(spark):
    rng = random.Random(4)
    rows = [(str(i), f"g{i % 60}", "text", *[rng.random() for _ in range(6)]) for i in range(600)]
    df = spark.createDataFrame(rows, "review_id string, gmap_id string, text string, " + ", ".join(f"{k} double" for k in (*BINARY, *CONTINUOUS)))
    out, folds, cut = splitting.split(df)
    got = out.collect()
    assert len(got) == 600 and set(cut) == set(BINARY)
    by_group = {}
    for r in got:
        by_group.setdefault(r.gmap_id, set()).add(r._split)
    assert all(len(s) == 1 for s in by_group.values())
    assert {r._split for r in got} == {"train", "val", "test"}
    assert folds.columns == ["review_id", "gmap_id", "_grp_label", "_split"]
    assert all(0.05 <= r.sample_weight <= 1 for r in got)
    zeros = spark.createDataFrame([(0.0,) * 4], ", ".join(f"{k} double" for k in BINARY))
    assert splitting.cuts(zeros, {"ads_promo": 5}) == {"ads_promo": splitting.TINY}


def test_labels(spark):
    cases = {
        '{"a": 1}': '{"a": 1}',
        'Sure! {"a": {"b": "}"}} bye': '{"a": {"b": "}"}}',
        "{'a': 1,}": '{"a": 1}',
        '```json\n{"a": 1}\n```': '{"a": 1}',
        "assistant: nothing": None,
        "{broken": None,
        None: None,
    }
    for given, want in cases.items():
        assert labeling.first_object(given) == want
    df = spark.createDataFrame([("1", "free promo code", 5, "Cafe")], "review_id string, text string, rating int, name string")
    chat = df.select(labeling.messages(df, shots=[{"input": {"text": "x"}, "output": {"ads_promo": 1.0}}]).alias("m")).first()["m"]
    assert [m.role for m in chat] == ["system", "user", "assistant", "user"] and chat[-1].content == "Place: Cafe\nRating: 5\nReview:\nfree promo code"
    got = labeling.score(df).first()
    assert got.ads_promo == 1.0 and all(0 <= got[k] <= 1 for k in SCORES)
    nothing = labeling.score(df, make=lambda: lambda chat: "no idea").first()
    assert [nothing[k] for k in SCORES] == [0.0] * 6
    broken = labeling.score(df, make=lambda: lambda chat: '{"ads_promo": 7, "irrelevant": "x"}').first()
    assert (broken.ads_promo, broken.irrelevant, broken.visit_likelihood) == (1.0, None, None)
    assert labeling.silver(df).count() == 1


def test_models(spark, tmp_path):
    rng = random.Random(3)
    rows = [(str(i), x := rng.random(), rng.random(), i % 2 == 0, float(x > 0.5), x) for i in range(400)]
    df = spark.createDataFrame(rows, "review_id string, a double, b double, c boolean, ads_promo double, relevancy_score double").withColumn("ads_promo_bin", F.lit(1))
    cfg = modeling.Training(trees=5, depth=2, rate=0.4)
    assert modeling.pick_features(df, cfg) == ["a", "b", "c"]
    train, val = df.where("review_id % 4 > 0"), df.where("review_id % 4 = 0")
    heads = modeling.train(train, val, cfg)
    assert set(heads) == {"ads_promo", "relevancy_score"}
    got = modeling.predict(val, heads).join(val, "review_id")
    assert metrics.ranking(got.select(F.col("ads_promo").cast("int").alias("y"), F.col("pred_ads_promo").alias("p"))).first()["roc_auc"] > 0.95
    assert metrics.regression(got.select(F.col("relevancy_score").alias("y"), F.col("pred_relevancy_score").alias("p"))).first()["r2"] > 0.5
    modeling.save(heads, str(tmp_path / "m"), spark)
    again = modeling.predict(val, modeling.load(str(tmp_path / "m"), spark))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, modeling.predict(val, heads).collect()))
    some = val.first()
    one = modeling.predict_one(heads, {"a": some.a, "b": some.b, "c": some.c, "text": "ignored"}, spark)
    many = modeling.predict(val.where(F.col("review_id") == some.review_id), heads).first()
    assert one == {k: pytest.approx(many[f"pred_{k}"]) for k in heads} and modeling.predict_one({}, {}, spark) == {}
    assert modeling.predict_one(heads, {}, spark) == modeling.predict_one(heads, {"a": None, "b": float("nan")}, spark)
    assert modeling.train_binary(train.withColumn("ads_promo", F.lit(0.0)), val, "ads_promo", ["a"], cfg) is None
    sig = modeling.train_binary(train, val, "ads_promo", ["a"], modeling.Training(trees=3, depth=2, rate=0.4, calibrate="sigmoid", tune=True))
    assert isinstance(sig.calibrator, tuple) and 0 <= sig.threshold <= 1
