"""Cubes with distinct counts, daily sketches against exact answers, table functions against their column forms."""

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from plumbline.operators import labeling, sketches, strata

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(6)
    return [(rng.choice(["x", "y", None]), rng.choice([1, 2, None]), rng.choice(["p", "q", "r", None])) for _ in range(300)]


@pytest.mark.parametrize("rollup", [False, True])
def test_cube(spark, rows, rollup):
    df = spark.createDataFrame(rows, "`a.b` string, n int, who string")
    sets = [s for k in range(3) for s in combinations(range(2), k)] if not rollup else [(), (0,), (0, 1)]
    want = set()
    for s in sets:
        groups = {}
        for r in rows:
            groups.setdefault(tuple(r[i] for i in s), []).append(r[2])
        level = sum(1 << (1 - i) for i in range(2) if i not in s)
        for k, v in groups.items():
            full = dict(zip(s, k, strict=True))
            want.add((full.get(0), full.get(1), level, len(v), len({x for x in v if x})))
    got = strata.cube(df, ["a.b", "n"], "who", rollup)
    assert got.columns == ["a.b", "n", "level", "n", "members"] and {tuple(r) for r in got.collect()} == want
    assert {r.members for r in strata.cube(df, ["n"]).collect()} == {0}
    assert strata.cube(df.limit(0), ["n"]).count() <= 1


def test_merged_days_are_within_the_error(spark):
    df = spark.range(40_000).select((F.col("id") % 30).alias("day"), F.lit("g").alias("g"), F.pow(F.rand(3), 3).alias("v"), (F.col("id") % 7001).alias("who"))
    df = df.withColumn("v", F.when(F.col("day") > 0, F.col("v"))).cache()
    days = sketches.daily(df, F.col("day"), ["g"], F.col("v"), F.col("who"))
    assert days.count() == 30
    one = sketches.merged(days, ["g"]).select("n", sketches.distinct(F.col("distinct")).alias("d"), *[sketches.quantile(F.col("quantiles"), q).alias(f"q{i}") for i, q in enumerate((0.01, 0.33, 0.66, 0.99))]).first()
    assert one.n == 40_000 and abs(one.d - 7001) <= sketches.DISTINCT_ERROR * 7001
    held = df.where("v IS NOT NULL")
    total = held.count()
    for i, q in enumerate((0.01, 0.33, 0.66, 0.99)):
        assert abs(held.where(F.col("v") <= one[f"q{i}"]).count() / total - q) <= sketches.QUANTILE_ERROR
    span = sketches.merged(days.where("day = 0"), ["g"]).select(sketches.quantile(F.col("quantiles"), 0.5).alias("q"), sketches.distinct(F.col("distinct")).alias("d")).first()
    assert span.q is None and abs(span.d - 1334) <= sketches.DISTINCT_ERROR * 1334
    assert sketches.merged(days.limit(0), ["g"]).count() == 0


def test_table_functions(spark):
    queries = __spark_entry__.queries()
    assert sorted(queries["llm_scorer_sql"](spark, SF).collect()) == sorted(queries["llm_scorer"](spark, SF).collect())
    assert sorted(map(str, queries["policy_reasons_sql"](spark, SF).collect())) == sorted(map(str, queries["policy_reasons"](spark, SF).collect()))
    said = {"good": '{"ads_promo": "0.5", "irrelevant": 7, "rant_no_visit": true, "spam_low_quality": null}', "bad": "no object"}
    labeling.register(spark, lambda: lambda chat: next((v for k, v in said.items() if k in chat[-1]["content"]), "{}"), 0)
    df = spark.createDataFrame([("1", "good"), ("2", "bad")], "review_id string, text string")
    asked = df.select("review_id", labeling.messages(df).alias("chat"))
    asked.createOrReplaceTempView("asked_by_test")
    want = {"1": (0.5, 1.0, None, None, None, None), "2": (0.0,) * 6}
    assert {r[0]: tuple(r[1:]) for r in spark.sql("SELECT * FROM score_reviews(TABLE(asked_by_test))").collect()} == want
    assert {r[0]: tuple(r[1]) for r in spark.sql("SELECT review_id, review_scores(chat) FROM asked_by_test").collect()} == want
    labeling.register(spark)


@pytest.mark.parametrize("rollup", [False, True])
def test_a_cube_repeats_no_members(spark, rows, rollup):
    """No rows are repeated by subset and member; what is repeated is counted by subset at once."""
    df = spark.createDataFrame(rows, "a string, n int, who string")
    text = strata.cube(df, ["a", "n"], "who", rollup)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in text
