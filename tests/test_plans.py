"""Files, configuration, the whole run, streams and the catalogue's oracles."""

import json
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from plumbline.functions.schema import REVIEW
from plumbline.operators import features, modeling, rules, sampling, splitting
from plumbline.plans import catalog, cli, pipelines
from plumbline.sources import config, io
from plumbline.streaming import scoring

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "é", 0.5, None), (2, "b", float("nan"), None), (3, "c", 1.5, "x")], "id long, text string, score double, extra string")
    io.put_jsonl(df, str(tmp_path), "a/b.jsonl")
    got = io.get_jsonl(spark, str(tmp_path), "a/b.jsonl")
    assert sorted(got.select(*df.columns).collect()) == sorted([(1, "é", 0.5, None), (2, "b", None, None), (3, "c", 1.5, "x")], key=lambda r: r[0])
    for f, path in io.export(df, str(tmp_path), "t", ("parquet", "csv", "jsonl")).items():
        assert io.read_any(spark, path).count() == 3, f
    with pytest.raises(ValueError):
        io.read_any(spark, "x.xls")
    assert io.try_read(spark, str(tmp_path / "none.parquet")) is None and io.try_read(spark, "x.xls") is None
    io.write_document(spark, {"a": 1}, str(tmp_path / "d.json"))
    assert io.read_document(spark, str(tmp_path / "d.json")) == {"a": 1} and io.read_document(spark, str(tmp_path / "no.json"), {}) == {}
    twice = df.select("id", F.col("text").alias("id"))
    assert io.unique_columns(twice).columns == ["id"]


def test_config(tmp_path, monkeypatch):
    monkeypatch.setenv("PLUMBLINE_ROOT", "/data")
    assert config.expand({"a": ["${PLUMBLINE_ROOT}/x", 1], "b": "${MISSING_NAME}"}) == {"a": ["/data/x", 1], "b": "${MISSING_NAME}"}
    (tmp_path / "s.txt").write_text("system")
    (tmp_path / "f.jsonl").write_text('{"input": {}, "output": {}}\n\n')
    assert config.prompts(str(tmp_path / "s.txt"), str(tmp_path / "f.jsonl")) == ("system", [{"input": {}, "output": {}}])


def raw(tmp_path, n=400):
    rng = random.Random(8)
    with open(tmp_path / "review-x.jsonl", "w") as f:
        for i in range(n):
            text = rng.choice(["nice place and good food here", "free promo code call us now", "i heard it is bad, never been", "iphone and laptop talk only", "!!! wow ..."]) + f" {i}"
            f.write(json.dumps({"gmap_id": f"g{i % 40}", "user_id": "1" * 20 + str(i), "time": 1_600_000_000 + i * 100_000, "rating": 1 + i % 5, "text": text, "pics": None, "resp": {"time": 1_700_000_000, "text": "thanks"} if i % 3 == 0 else None}) + "\n")
        f.write(json.dumps({"gmap_id": "g1", "user_id": "2", "time": 1, "rating": 1, "text": " None "}) + "\n")
    with open(tmp_path / "meta-x.jsonl", "w") as f:
        for i in range(40):
            f.write(json.dumps({"gmap_id": f"g{i}", "name": f"Cafe {i}", "category": ["Cafe"]}) + "\n")


def test_all_stages(spark, tmp_path):
    raw(tmp_path)
    cfg = modeling.Training(trees=3, depth=2, min_rows=1)
    run = pipelines.Run(spark, pipelines.Paths(str(tmp_path / "out"), [str(tmp_path / "*.jsonl")]), as_of=1_700_000_000, sampler=sampling.Sampler(target=300), training=cfg, n_silver=200, split_cfg=splitting.Split(min_per_split={"val": 1, "test": 1}, min_total={}))
    decisions = run.all()
    sampled = run._read("sampled")
    assert sampled.count() == 300 and sampled.where("length(user_id) > 20").count() == 300
    assert {"name", "category"} <= set(sampled.columns)
    assert run._read("rules").where("rule_rant_strong = 1").count() > 0
    test = run._read("test")
    assert decisions.count() == test.count() > 0
    assert decisions.where("final IS NULL OR action IS NULL").count() == 0
    labels = run._read("gold_pack").select("review_id", *[F.lit(1).alias(k) for k in pipelines.BINARY], *[F.lit(0.5).alias(k) for k in pipelines.CONTINUOUS], F.lit("x").alias("annotator_id"))
    assert run.gold_ingest(labels).where("ads_promo = 1").count() == labels.count()
    assert pipelines.report(run._read("summary")).startswith("# Evaluation")
    assert pipelines.demo(spark, str(tmp_path / "out"))["decisions"].count() == 1


def test_cli_options():
    with pytest.raises(SystemExit):
        cli.main(["no_such_stage", "--config", "x"])


def test_stream(spark, tmp_path):
    raw(tmp_path, 60)
    (tmp_path / "in").mkdir()
    (tmp_path / "review-x.jsonl").rename(tmp_path / "in/review-x.jsonl")
    stream = scoring.read(spark, str(tmp_path / "in"), REVIEW)
    scoring.write(scoring.score(stream, 1_700_000_000), str(tmp_path / "scored"), str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "scored"))
    batch = rules.rules(features.features(io.read_any(spark, str(tmp_path / "in/review-x.jsonl"), REVIEW), 1_700_000_000, groups=scoring.STATELESS))
    assert sorted(got.select("text", "rule_ads_score").collect()) == sorted(batch.select("text", "rule_ads_score").collect())
    q = scoring.flagged_counts(stream, 1_700_000_000).writeStream.format("memory").queryName("flagged").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("flagged").agg(F.sum("n")).first()[0] == 61


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(rows):
    return sorted(repr([round(float(x), 6) if isinstance(x, float) else x for x in r]) for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_oracle(spark, db, name):
    got = catalog.QUERIES[name](spark, SF)
    cols = sorted(got.columns)
    want = db.sql(f"SELECT {', '.join(cols)} FROM ({catalog.ORACLES[name]})").fetchall()
    assert plain(map(tuple, got.select(*cols).collect())) == plain(want)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
