"""As-of joins, interval joins, rolling frames and sessions against plain versions; no task holds a key's whole history."""

import random

import pytest
from pyspark.sql import functions as F

from plumbline.operators import temporal


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("edges", [[], [1.0], [float(i) for i in range(15)], [float(i) for i in range(16)], [float(i) for i in range(40)], [float(i) for i in range(255)]])
def test_buckets(spark, edges):
    df = spark.range(-2, 270).select((F.col("id") + 0.5).alias("t"))
    got = [r[0] for r in df.select(temporal.bucket_of(F.col("t"), edges)).collect()]
    assert got == [sum(e <= i + 0.5 for e in edges) for i in range(-2, 270)]


@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(1)
    key = lambda: rng.choice(["hot", "hot", "hot", "a", "b", "c", None])
    left = [(key(), rng.choice([None, *range(120)]), i) for i in range(600)] + [("hot", 50, 1000 + i) for i in range(200)]
    right = [(key(), rng.choice([None, *range(0, 120, 3)]), i, f"p{i % 7}") for i in range(300)]
    return left, right, spark.createDataFrame(left, "k string, t int, id int").withColumn("a.b", F.lit(1)), spark.createDataFrame(right, "k string, t int, n int, p string")


@pytest.mark.parametrize("strict, tolerance, buckets", [(False, None, 256), (True, None, 8), (False, 5, 1), (True, 4, 40)])
def test_as_of(sides, strict, tolerance, buckets):
    left, right, a, b = sides
    want = []
    for k, t, i in left:
        found = [(u, n, p) for kk, u, n, p in right if None not in (k, t, kk, u) and kk == k and (u < t if strict else u <= t)]
        best = max(found, default=None)
        want.append((i, *(best[1:] if best and (tolerance is None or t - best[0] <= tolerance) else (None, None))))
    got = temporal.as_of_join(a, b, "k", "t", "t", ["n", "p"], ["n"], strict, tolerance, buckets)
    assert got.columns == ["k", "t", "id", "a.b", "n", "p"]
    assert sorted(((r.id, r.n, r.p) for r in got.collect()), key=str) == sorted(want, key=str)


def test_as_of_without_rows(sides):
    _, _, a, b = sides
    assert temporal.as_of_join(a.limit(0), b, "k", "t", "t", ["n"]).count() == 0
    none = temporal.as_of_join(a, b.limit(0), "k", "t", "t", ["n"])
    assert none.count() == 800 and none.where("n IS NOT NULL").count() == 0


def test_hot_keys_fill_many_buckets(spark):
    """One key with all rows: no window group has more than a few times its share, and nothing is windowed by key alone but bucket rows."""
    rows = spark.range(20_000).select((F.col("id") % 1).alias("k"), (F.col("id") * F.col("id")).alias("t"))
    edges = temporal.time_edges(rows)
    largest = rows.groupBy(temporal.bucket_of(F.col("t"), edges)).count().agg(F.max("count")).first()[0]
    assert len(edges) > 200 and largest < 4 * 20_000 / 256
    text = plan(temporal.as_of_join(rows, rows.withColumn("p", F.col("t")), "k", "t", "t", ["p"]))
    assert "NestedLoop" not in text and "CartesianProduct" not in text and "SinglePartition" not in text
    text = plan(temporal.rolling(rows, "k", "t", 1000, {"n": F.count(F.lit(1))}))
    assert "hashpartitioning(k" in text and "__b" in text.split("hashpartitioning(k")[1][:40]


def test_rolling(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["hot", "hot", "x", None]), rng.choice([None, *range(-50, 400)]), rng.random(), i) for i in range(800)]
    df = spark.createDataFrame(rows, "k string, t int, v double, id int")
    made = {"n": F.count(F.lit(1)), "s": F.sum("v"), "m": F.max("v")}
    for length, spread in ((10, 8), (10, 1), (0, 3), (90, 2)):
        got = {r.id: (r.n, r.s, r.m) for r in temporal.rolling(df, "k", "t", length, made, spread if length else 3).collect()} if length else None
        if got is None:
            continue
        assert len(got) == 800
        for k, t, _, i in rows:
            if k is None or t is None:
                assert got[i] == (None, None, None)
                continue
            near = [v for kk, u, v, _ in rows if kk == k and u is not None and t - length <= u <= t]
            assert got[i] == (len(near), pytest.approx(sum(near)), max(near))


@pytest.mark.parametrize("key, share", [("k", 1024), ("k", 4), (None, 1024), (None, 2)])
def test_overlapping(spark, monkeypatch, key, share):
    rng = random.Random(3)

    def spans(n):
        out = []
        for i in range(n):
            s = rng.randrange(1000)
            out.append((rng.choice(["hot", "hot", "hot", "a", None]), s, s + rng.choice([0, 1, 1, 3, 10, 64, 500, 2000, -5]), i))
        return [*out, ("a", None, 5, n), ("a", 5, None, n + 1)]

    left, right = spans(150), spans(130)
    a, b = (spark.createDataFrame(x, "k string, s int, e int, id int") for x in (left, right))
    monkeypatch.setattr(temporal, "HOT_SHARE", share)
    want = sorted((x[3], y[3]) for x in left for y in right if None not in (*x[1:], *y[1:]) and x[1] < x[2] and y[1] < y[2] and x[1] < y[2] and y[1] < x[2] and (not key or (x[0] == y[0] and x[0])))
    pairs = temporal.overlapping(a, b, ("s", "e"), ("s", "e"), key, unit=2.0)
    assert sorted((r.l.id, r.r.id) for r in pairs.collect()) == want
    assert temporal.overlapping(a.limit(0), b, ("s", "e"), ("s", "e"), key).count() == 0
    text = plan(pairs)
    assert "NestedLoop" not in text and "CartesianProduct" not in text


def test_hot_bins_are_dealt_out(spark):
    """A bin with all rows of both sides is joined in as many parts as its salts, each with its share of one side."""
    a = spark.range(4000).select(F.lit("x").alias("k"), F.lit(0).alias("at"), F.lit(0).alias("bin"), F.struct("id").alias("l"))
    b = spark.range(3000).select(F.lit("x").alias("k"), F.lit(0).alias("at"), F.lit(0).alias("bin"), F.struct("id").alias("r"))
    x, y = temporal._dealt(a, b, ["k", "at", "bin"])
    n = x.join(y, ["k", "at", "bin", "salt"]).groupBy("salt").count().collect()
    assert len(n) == temporal.MOST_SALTS**2 and sum(r["count"] for r in n) == 4000 * 3000 and max(r["count"] for r in n) < 4 * 4000 * 3000 / len(n)


def test_sessions(spark):
    rows = [("u", 0), ("u", 1799), ("u", 3600), ("u", 5400), ("u", 9000), ("v", 0), (None, 5), ("w", None), ("u", 0)]
    df = spark.createDataFrame(rows, "k string, s int").withColumn("ts", F.timestamp_seconds("s"))
    got = sorted((r.k, r.start.timestamp(), r.end.timestamp(), r.n) for r in temporal.sessions(df, "k", "ts").collect())
    assert got == [("u", 0.0, 1799.0, 3), ("u", 3600.0, 5400.0, 2), ("u", 9000.0, 9000.0, 1), ("v", 0.0, 0.0, 1)]
