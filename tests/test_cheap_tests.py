"""Cheap tests before patterns change no result; texts are read once for the rules and never shuffled."""

import random

from pyspark.sql import functions as F

from plumbline.functions import patterns, text
from plumbline.operators import features, rules

PIECES = ["use code", "Apply COUPON", "ABCD-12", "order now", "ORDER NOW", "link in bio", "dm us", "DM", "whatſapp me", "whatsapp", "Kall", "call now", "tel: +65 6123 4567", "5551234567", "٣٤٥٦٧٨٩٠١٢", "$5", "a$5", "US$ 20", "uſd 5", "10% off", "10%off", "5 %x", "me@x.org", "@ab", ":@a.b", "#tag", "a#b", "https://a.b/c", "WWW.x.com", "wWw.y", "www", "://", "bit.ly/x", "BIT.LY/y", "ſhop.example.ſg", "a.İnfo", "b.info", "x.us", "c.ſtore", "4.5/5", "3 stars", "5 ſtars", "never been", "NEVER  been", "I heard", "ı heard", "ſomeone ſaid", "won't go", "graphics card", "graphicſ card", "GPU", "ram", "program", "sale", "ſale", "deal", "é", "ß", "漢字", "\U0001F600", "…", "!!", "sooo", "\n", "  ", "İ", "K", "0", "９"]


def fuzz(n):
    rng = random.Random(7)
    return [rng.choice(["", " ", "x"]).join(rng.choice(PIECES) for _ in range(rng.randrange(1, 7))) for _ in range(n)] + PIECES + ["", None]


def test_flags_and_hits_are_those_of_the_patterns(spark):
    t = F.col("t")
    df = spark.createDataFrame([(x,) for x in fuzz(1500)], "t string").repartition(4)
    pairs = {k: (patterns.flag(k, t), F.coalesce(t.rlike(p), F.lit(False))) for k, p in patterns.FLAGS.items()}
    for k, terms in (patterns.LEXICONS | {"own": ["k", "İx", "two-part", " "], "none": []}).items():
        pairs[f"{k}_hits"] = patterns.hits(t, terms), F.coalesce(text.count(t, patterns.lexicon(terms)), F.lit(0).cast("long"))
    made = patterns.relevancy(t, [])["star_rating_mention"]
    pairs["stars"] = made, F.coalesce(t.rlike(patterns.STAR_RATING), F.lit(False))
    wrong = df.select(*[F.sum((~a.eqNullSafe(b)).cast("int")).alias(k) for k, (a, b) in pairs.items()]).first().asDict()
    seen = df.select(*[F.sum(b.cast("int")).alias(k) for k, (_, b) in pairs.items()]).first().asDict()
    assert not any(wrong.values()), wrong
    assert all(v for k, v in seen.items() if k not in ("none_hits",)), seen


def test_counts_of_characters(spark):
    t = F.col("t")
    df = spark.createDataFrame([(x,) for x in fuzz(400)[:-1]], "t string").withColumn("s", text.token_stats(F.col("t")))
    made = text.text_form(t, F.col("s")) | text.language(t)
    n = F.length(t)
    plain = {"emoji_count": text.count(t, text.EMOJI), "upper_ratio": text.ratio(text.count(t, "[A-Z]"), text.count(t, "[A-Za-z]")), "ascii_ratio": text.ratio(text.count(t, r"[\x00-\x7F]"), n), "nonlatin_ratio": text.ratio(text.count(t, r"[^\x{0000}-\x{024F}]"), n)}
    assert df.select(*[F.sum((~made[k].eqNullSafe(v)).cast("int")).alias(k) for k, v in plain.items()]).first() == (0, 0, 0, 0)


def test_texts_are_read_once_and_not_shuffled(spark, tmp_path):
    path = str(tmp_path / "reviews")
    spark.createDataFrame([(str(i), f"g{i % 3}", f"u{i % 5}", 1_600_000_000 + i, 1 + i % 5, f"good place {i % 4}") for i in range(60)], "review_id string, gmap_id string, user_id string, time long, rating int, text string").write.parquet(path)
    df = spark.read.parquet(path)
    out = rules.rules(features.features(df, 1_700_000_000, carry=("review_id", "gmap_id")))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in plan and "reviews" not in plan  # everything reads the written table of numbers
    assert not any("text#" in line for line in plan.split("\n"))
    assert out.columns[:2] == ["review_id", "gmap_id"] and "user_id" not in out.columns and out.count() == 60
    again = features.features(df, 1_700_000_000)
    assert {c for c in again.columns} >= {"text", "text_dup_count_place", "user_rating_std", "lang_hint_non_en"}
    same = ["review_id", "text_dup_count_place", "place_review_count", "user_rating_mean", "upper_ratio"]
    both = features.features(df, 1_700_000_000, carry=("review_id",))
    assert sorted(again.select(*same).collect()) == sorted(both.select(*same).collect())


def test_joins_stay_when_broadcasts_are_off(spark):
    """Also where nothing is broadcast, no exchange carries a text."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame([("1", "g", "u", 1, 2, "t")], "review_id string, gmap_id string, user_id string, time long, rating int, text string")
        joined, made = features.group_windows(df.select("*", F.length("text").alias("n")))
        plan = joined.select("review_id", "n", *made.values())._jdf.queryExecution().optimizedPlan().toString()
        above = plan.split("Join")[1:-1]
        assert above and all("text#" not in x.split("\n")[1] for x in above)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
