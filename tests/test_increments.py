"""Aggregates that came in increments against those of one run."""

import random

import pytest
from pyspark.sql import functions as F

from plumbline.operators import features, increments

SCHEMA = "review_id string, gmap_id string, user_id string, rating double, text string"


def made(n, seed):
    rng = random.Random(seed)
    return [(f"{seed}-{i}", rng.choice(["hot", "hot", "a", "b", None]), rng.choice(["u", "v", None, f"w{i}"]), rng.choice([None, 1e9 + rng.random(), 3.0]) if seed % 2 else rng.random() * 5, rng.choice(["x", "y", None, f"z{i}"])) for i in range(n)]


def rows_of(joined, made):
    return {r.review_id: r.asDict() for r in joined.select("review_id", *[v.alias(k) for k, v in made.items()]).collect()}


def same(got, want):
    assert got.keys() == want.keys()
    for i, w in want.items():
        for k, v in w.items():
            if isinstance(v, float):
                assert got[i][k] == pytest.approx(v, rel=1e-9, abs=1e-6), (i, k)
            else:
                assert got[i][k] == v, (i, k)


@pytest.mark.parametrize("fan", [2, 3, 50])
def test_increments_equal_one_run(spark, tmp_path, fan):
    parts = [spark.createDataFrame(made(60, s), SCHEMA) for s in range(7)]
    book = increments.Book(spark, str(tmp_path / "book"), fan)
    for i, p in enumerate(parts):
        assert book.add(p, f"day-{i}") and not book.add(p, f"day-{i}")
    everything = parts[0]
    for p in parts[1:]:
        everything = everything.unionByName(p)
    same(rows_of(*book.windows(everything)), rows_of(*features.group_windows(everything)))
    for kind in features.KINDS:
        df = everything.withColumns(features.hashes(F.col("text")))
        key = features.KINDS[kind]
        want = {tuple(r[c] for c in key): r.n for r in features.totals_of(df, kind).collect()}
        assert {tuple(r[c] for c in key): r.n for r in book.totals(kind).collect()} == want
    levels = [r["level"] for r in book.manifest()["runs"]["place"]]
    assert len(levels) < fan * 3 and max(levels) == {2: 2, 3: 1, 50: 0}[fan]


def test_a_new_day_reads_no_old_reviews(spark, tmp_path):
    book = increments.Book(spark, str(tmp_path / "book"), 4)
    old = str(tmp_path / "old")
    spark.createDataFrame(made(50, 1), SCHEMA).write.parquet(old)
    book.add(spark.read.parquet(old), "old")
    day = spark.createDataFrame(made(5, 2), SCHEMA)
    book.add(day, "new")
    joined, cols = book.windows(day)
    read = joined.select("review_id", *cols.values()).inputFiles()
    assert any("/place-0-" in f for f in read) and not any("/old/" in f for f in read)


def test_a_job_that_dies_leaves_the_state(spark, tmp_path, monkeypatch):
    book = increments.Book(spark, str(tmp_path / "book"), 2)
    day = spark.createDataFrame(made(30, 3), SCHEMA)
    book.add(day, "one")
    before = {r.gmap_id: (r.n, r.mean) for r in book.totals("place").collect()}
    monkeypatch.setattr(increments.io, "write_document", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        book.add(day, "two")
    monkeypatch.undo()
    again = increments.Book(spark, str(tmp_path / "book"), 2)
    assert {r.gmap_id: (r.n, r.mean) for r in again.totals("place").collect()} == before
    assert again.vacuum() > 0 and again.vacuum() == 0
    assert again.add(day, "two")
    assert {r.gmap_id: r.n for r in again.totals("place").collect()} == {k: 2 * n for k, (n, _) in before.items()}


def test_nothing_yet(spark, tmp_path):
    book = increments.Book(spark, str(tmp_path / "book"))
    day = spark.createDataFrame(made(8, 4), SCHEMA)
    got = rows_of(*book.windows(day))
    assert all(r["place_review_count"] is None and r["text_dup_count_place"] == 1 and r["user_rating_std"] == 0.0 for r in got.values())
    assert book.totals("place") is None
    book.add(day.limit(0), "empty")
    assert book.totals("user").count() == 0
