"""Line deduplication without a lower bound on the words of a line."""

import re
from collections import defaultdict

from pyspark.sql import functions as F

from plumbline.llm import line_dedup


def removed(docs):
    """Row -> removed line numbers, by comparing every pair of lines that have words."""
    lines = [(r, i, frozenset(w)) for r, (_, t) in enumerate(sorted(docs)) for i, x in enumerate(t.split("\n")) if (w := re.findall(r"[^\x20\x09-\x0D]+", x.lower()))]
    out = defaultdict(list)
    for k, (r, i, w) in enumerate(lines):
        if any(5 * len(w & v) >= 4 * len(w | v) for _, _, v in lines[:k]):
            out[r].append(i)
    return out


def check(spark, docs):
    want = removed(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r for r in line_dedup.op10(df).collect()}
    text = {r.doc_id: r.text for r in line_dedup.stage(spark, df, "").collect()}
    for k, (d, t) in enumerate(sorted(docs)):
        assert got[d].removed_lines == ",".join(map(str, want[k]))
        assert text[d] == "\n".join(x for i, x in enumerate(t.split("\n")) if i not in want[k])
    return {k: v for k, v in want.items() if v}


def test_short_lines(spark):
    docs = [
        (1, "All rights reserved.\n\n \t\nOK\n中文没有空格的一行文字\na b c d"),
        (2, "all  Rights reserved.\n\nok\nb a\n中文没有空格的一行文字\na b c d e"),
        (3, "reserved. all rights\n" + "QUJD" * 500 + "\na b\na c"),
        (4, "QUJD" * 500 + "\n \t\nb a"),
    ]
    docs[3] = (4, docs[3][1].lower())
    assert check(spark, docs) == {1: [0, 2, 4, 5], 2: [0, 2], 3: [0, 2]}


def test_short_lines_of_a_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    short = [(d, "\n".join(x for x in t.split("\n") if len(x.split()) < 9)) for d, t in rows]
    assert sum(map(len, check(spark, short).values())) > 50


def test_lines_whose_names_clash(spark, monkeypatch):
    """Unequal lines that share a name are told apart by the second hash."""
    real = line_dedup._names
    monkeypatch.setattr(line_dedup, "_names", lambda low: (F.length(low).cast("long"), real(low)[1]))
    docs = [(1, "one two three\nsix two three\nlonger line than these"), (2, "six two three\none two three\nten two three"), (3, "longer line than these\nTEN two three")]
    assert check(spark, docs) == {1: [0, 1], 2: [0, 1]}


def test_tokens_that_collide(spark, monkeypatch):
    """Prefix words are joined by few bits; where these are equal for most words, nothing is lost."""
    monkeypatch.setattr(line_dedup, "TOKEN", 7)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    docs = [(d, "\n".join(" ".join(x.split()[:25]) for x in t.split("\n")[:6])) for d, t in rows[:60]]
    assert check(spark, docs + [(1000 + d, t.replace("the", "thee", 1)) for d, t in docs])


def test_rows_to_shuffle_are_narrow(spark):
    """A prefix word's row has five longs, and pairs that share too little of their prefixes are dropped before words are shuffled."""
    words = [f"w{i}" for i in range(400)]
    near = " ".join(words[:60])
    lines = [near, near.replace("w3 ", "x "), " ".join(words[:30] + words[60:90]), " ".join(words[20:70] + words[100:105])]
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(lines * 2)], "doc_id long, text string")
    c, drop = line_dedup.classes(docs)
    marked = c.withColumn("settled", F.lit(False))
    bags, drop_bags = line_dedup.prefixes(marked, line_dedup.rarity(c))
    assert [t for _, t in line_dedup._rows(bags).dtypes] == ["bigint"] * 5
    k = bags.select("key", "at")
    pairs = k.select(F.col("key").alias("later"), F.col("at").alias("i")).join(k.select(F.col("key").alias("earlier"), F.col("at").alias("j")), F.col("i") > F.col("j")).select("later", "earlier", F.lit(False).alias("tie"), F.lit(0).alias("far"), "i", "j")
    assert [(r.i, r.j) for r in line_dedup._near(pairs, bags).collect()] == [(1, 0)]
    drop_bags()
    drop()


def test_plans_do_not_hold_the_sketch(spark, monkeypatch):
    """The sketch of word counts is a subquery's result: no plan spells it out on the driver, and no row carries it."""
    real, plans = line_dedup.bucketed, []

    def seen(df, key):
        plans.append(df._jdf.queryExecution().toString())
        return real(df, key)

    monkeypatch.setattr(line_dedup, "bucketed", seen)
    docs = spark.createDataFrame([(1, "one two three four five six"), (2, "one two three four five seven"), (3, "one two three eight nine ten")], "doc_id long, text string")
    c, drop = line_dedup.classes(docs)
    bags, drop_bags = line_dedup.prefixes(c.withColumn("settled", F.lit(False)), line_dedup.rarity(c))
    assert bags.count() == 3
    assert len(plans) == 2
    assert max(map(len, plans)) < 200_000
    assert "array_repeat(scalar-subquery" in plans[1].split("== Optimized Logical Plan ==")[1]
    drop_bags()
    drop()
