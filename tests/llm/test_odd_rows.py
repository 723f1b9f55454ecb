"""Rows that divide by zero, names with dots, items and spans of any size."""

import random

import brute
import pytest
from pyspark.sql import functions as F

from plumbline.llm import decontamination, filter_audit, html_text, licenses, line_dedup, mixing, pii, quality_model, quality_rules, secrets, simhash, toxicity, vector_codes

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = " ".join(f"good{i}" for i in range(80))
TOKENS = ["=" * 20, "=" * 400, "x" + "=" * 19, "xy" + "=" * 19, "=" * 19, "-" * 30 + "=" * 3, "0" * 40, "a" * 40, "A" * 40, "/" * 25, "+=" * 20, "ab" * 30, "f" * 23, "9" * 400, "_" * 30, "é" * 30]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, f"Title\n{t}\nbody {t} end", "en", "a", 1) for i, t in enumerate(TOKENS)] + [(100 + i, t, None, None, None) for i, t in enumerate(TOKENS)] + [(200, WORDS, "en", "a", 1), (None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).withColumns({"a.b": F.lit(1), "c`d": F.lit(2), "Some Name": F.lit(3)})


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(200, 1, 0), (1, 0, 1)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, WORDS), (2, None)], "item_id long, text string")


def test_tokens_of_one_symbol(odd):
    rows = odd.select("doc_id", "text").collect()
    got = {r.doc_id: r for r in secrets.op1(odd).collect()}
    assert len(got) == len(rows)
    for r in rows:
        assert got[r.doc_id].base_sha256 == brute.digest(brute.secrets(r.text or ""))


def test_squares(spark):
    rng = random.Random(3)
    rows = [[float(rng.randrange(k)) for _ in range(n)] for n, k in ((0, 1), (1, 1), (50, 3), (200, 64), (30, 1))]
    df = spark.createDataFrame([(r,) for r in rows], "v array<double>")
    assert [r[0] for r in df.select(secrets._squares(F.col("v"))).collect()] == [sum(r.count(x) ** 2 for x in set(r)) for r in rows]


@pytest.mark.parametrize("what", ["all", "none", "nulls"])
def test_every_operator_on_odd_rows(spark, odd, labels, bench, what):
    docs = {"all": odd, "none": odd.limit(0), "nulls": odd.where("doc_id IS NULL")}[what]
    n = docs.count()
    for op in (secrets.op1, licenses.op2, pii.op3, lambda d: quality_model.op4(d, labels), lambda d: decontamination.op5(d, bench), lambda d: toxicity.op6(d, labels), mixing.op7, quality_rules.op8, simhash.op9, line_dedup.op10):
        assert len(op(docs).collect()) == n
    assert filter_audit.op11(docs, labels).count() == 600 * docs.select("lang").distinct().count()
    pages = docs.select(F.col("doc_id").alias("page_id"), F.col("source").alias("url"), F.col("text").alias("html"), "`a.b`")
    assert len(html_text.op12(pages).collect()) == n
    vectors = docs.select(F.col("doc_id").alias("vec_id"), F.lit(None).cast("array<float>").alias("embedding"), F.lit(1).alias("label"), "`a.b`")
    assert vector_codes.op13(vectors).collect() == []


def test_stages_keep_names_with_dots(spark, odd, bench, tmp_path):
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    for stage in (quality_rules.stage, line_dedup.stage, simhash.stage, decontamination.stage):
        out = stage(spark, odd, str(tmp_path))
        assert out.columns == odd.columns
        assert {(r["a.b"], r["c`d"], r["Some Name"]) for r in out.collect()} <= {(1, 2, 3)}
    assert mixing.stage(spark, odd, str(tmp_path)).count() == odd.count()


def test_long_items_are_cut(spark):
    """Pieces of an item give the windows of the whole; spans of several blocks are merged."""
    rng = random.Random(5)
    words = [f"w{rng.randrange(500)}" for _ in range(3000)]
    text = " ".join(words)
    cut = list(decontamination.pieces(text, 300, 10))
    assert len(cut) > 20 and all(len(p.encode()) < 400 for p, _ in cut)
    windows = lambda w: [tuple(w[i : i + 10]) for i in range(len(w) - 9)]
    found = {}
    for p, first in cut:
        for i, x in enumerate(windows(p.split())):
            found[first + i] = x
    assert [found[i] for i in range(len(found))] == windows(words)
    assert list(decontamination.pieces("a b", 1, 10)) == [("a b", 0)] and list(decontamination.pieces("", 1, 10)) == [("", 0)]
    bench = spark.createDataFrame([(1, text), (2, "w1 w2 w3"), (3, " ".join(words[100:150]))], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"x {text} y"), (2, " ".join(words[40:160])), (3, "clean"), (4, " ".join(words[5:14]) + " stop " + " ".join(words[14:30]))], "doc_id long, text string")
    want = sorted(decontamination.op5(docs, bench).collect())
    for most in (300, 2000):
        blocks = list(decontamination.item_blocks(bench, most))
        assert len(blocks) > 1
        kept, decontamination.item_blocks = decontamination.item_blocks, lambda b, window: iter(blocks)  # noqa: B023
        try:
            assert sorted(decontamination.op5(docs, bench).collect()) == want
        finally:
            decontamination.item_blocks = kept
