"""Operator 11 against a plain version and its SQL, on rows with nulls, ties and copies."""

from itertools import permutations

import duckdb
from pyspark.sql import functions as F

from plumbline.llm import filter_audit

LONG = " ".join(f"word{i}" for i in range(120))
ROWS = [(1, LONG, "en"), (2, LONG, "en"), (3, LONG, "de"), (3, LONG, "de"), (None, LONG, "en"), (4, None, None), (5, "", "en"), (6, "A B C # d", "en"), (7, "same " * 150, "de"), (8, LONG + " #", None), (9, LONG.upper(), "de"), (9, "x", "de"), (10, "é" * 300_000, "en"), (11, "x", "en")]
LABELS = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (7, 0, 1), (9, 1, 1), (None, 1, 1), (99, 1, 1)]
SCHEMA = "doc_id long, text string, lang string"


def plain(rows, labels):
    first, good, toxic = {}, {}, {}
    for d, t, _ in rows:
        if d is not None:
            first[t or ""] = min(d, first.get(t or "", d))
    for d, q, x in labels:
        if d is not None:
            good[d], toxic[d] = max(q, good.get(d, 0)), max(x, toxic.get(d, 0))
    docs = []
    for d, t, lang in rows:
        t = t or ""
        w = [x for x in t.replace("\n", " ").split(" ") if x]
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t), "D": any(c in "#$%&*|" for c in t), "E": t in first and (d is None or d > first[t])}
        docs.append((lang or "", fails, good.get(d, 0), toxic.get(d, 0)))
    out = {}
    for part in {x[0] for x in docs}:
        mine = [x for x in docs if x[0] == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for k, c in enumerate(order):
                hit = [x for x in left if x[1][c]]
                out[part, order, k + 1] = [len(left) - len(hit), len(hit), sum(x[1][c] for x in mine) - len(hit), sum(x[1][c] and sum(x[1].values()) == 1 for x in mine), sum(x[2] for x in hit), sum(x[3] for x in hit)]
                total[c] += len(hit)
                left = [x for x in left if not x[1][c]]
        for order in map("".join, permutations("ABCDE")):
            for k, c in enumerate(order):
                out[part, order, k + 1].append(total[c])
    return out


def test_equals_a_plain_version(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA).withColumns({"a.b": F.lit(1), "TEXT2": F.lit("x"), "part": F.lit("z"), "A": F.lit(True), "n": F.lit(1)})
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int").withColumn("c.d", F.lit(1))
    got = {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in filter_audit.op11(docs, labels).collect()}
    assert got == plain(ROWS, LABELS)
    assert filter_audit.op11(docs.limit(0), labels).count() == 0
    assert {r[0] for r in filter_audit.op11(docs, labels.limit(0)).select("good_lost").distinct().collect()} == {0}


def test_sql(spark):
    documents = spark.createDataFrame(ROWS, SCHEMA).toPandas()  # noqa: F841
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int").toPandas()  # noqa: F841
    got = {(r[0], r[1], r[2]): list(r[3:]) for r in duckdb.sql(filter_audit.ORACLE).fetchall()}
    assert got == plain(ROWS, LABELS)


def test_hot_keys_are_joined_alone(spark):
    """Copies of one text, a half of all rows, never meet in a shuffled join."""
    from plumbline.llm.common import HOT_SHARE, join_back

    rows = spark.range(6000).select(F.when(F.col("id") < 3000, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.lit("x").alias("a.b"))
    groups = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), (F.max("k") * 2).alias("twice"))
    out = join_back(rows, groups, ["k"], "n")
    assert out.columns == ["k", "a.b", "twice"] and out.where("twice = 2 * k").count() == 6000
    assert 6000 > HOT_SHARE and out.where("k = -1").count() == 3000
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan and plan.count("Join") >= 3
