"""Column expressions against hand-made rows."""

import hashlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions import fields, patterns, schema, text


def one(spark, value, c, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(c(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "value, want",
    [
        ("", (0, 0, "short", 0, 0, 0, 0)),
        ("a b c d e f g h", (15, 8, "short", 0, 0, 0, 0)),
        ("a b c d e f g h i", (17, 9, "medium", 0, 0, 0, 0)),
        ("word " * 9 + "x" * 155, (200, 10, "long", 0, 0, 1, 0)),
        ("so \U0001f600 \U0001f1e8\U0001f1e6 ok", (10, 4, "short", 3, 0, 0, 0)),
        ("soooo good!!! wow... really…", (28, 4, "short", 0, 2, 3, 2)),
    ],
)
def test_text_form(spark, value, want):
    df = spark.createDataFrame([(value,)], "t string").withColumn("s", text.token_stats(F.col("t")))
    made = text.text_form(F.col("t"), F.col("s"))
    assert tuple(df.select(*[v.alias(k) for k, v in made.items()]).first()[:7]) == want


def test_ratios(spark):
    df = spark.createDataFrame([("ABc1 ABc1 x٣",)], "t string").withColumn("s", text.token_stats(F.col("t")))
    r = df.select(*[v.alias(k) for k, v in (text.text_form(F.col("t"), F.col("s")) | text.language(F.col("t"))).items()]).first()
    assert r.upper_ratio == pytest.approx(4 / 7) and r.digit_ratio == pytest.approx(3 / 12) and r.unique_token_ratio == pytest.approx(2 / 3)
    assert r.nonlatin_ratio == pytest.approx(1 / 12) and r.lang_hint_non_en == 0
    assert one(spark, "ab", lambda c: text.shorten(c, 1)) == "a…"


@pytest.mark.parametrize(
    "flag, yes, no",
    [
        ("has_url", "see https://a.b/c now", "no link"),
        ("has_url", "www.x.de", "wwwx.de"),
        ("has_domain", "at shop.example.com today", "at example.dex"),
        ("has_short_url", "bit.ly/x1", "bit.ly alone"),
        ("has_phone_us", "5551234567", "555123"),
        ("has_phone_any", "+65 6123 4567", "12345"),
        ("has_email", "me@x.org", "me@x"),
        ("has_social_handle", "hi @ab", "mid@ab"),
        ("has_hashtag", "#ab", "a#ab"),
        ("has_currency", "a$5", " $5"),
        ("has_percent_off", "10% off", "10% "),
        ("has_promo_code", "use code ABCD", "use code AB"),
        ("has_cta", "DM us", "dm them"),
        ("has_cta", "limited time", "limited times"),
    ],
)
def test_flags(spark, flag, yes, no):
    assert one(spark, yes, lambda c: c.rlike(patterns.FLAGS[flag])) is True
    assert one(spark, no, lambda c: c.rlike(patterns.FLAGS[flag])) is False


def test_lexicon(spark):
    count = lambda v, terms: one(spark, v, lambda c: text.count(c, patterns.lexicon(terms)))
    assert count("I  heard it. i heard", ["i heard"]) == 2
    assert count("dealer deal DEAL", ["deal"]) == 2
    assert count("e-mail email e_mail", ["e-mail"]) == 3
    assert count("anything", []) == 0 and count("anything", [" "]) == 0
    assert one(spark, "4.5/5 and 5 stars", lambda c: c.rlike(patterns.STAR_RATING)) is True


def test_mentions(spark):
    df = spark.createDataFrame([("The SUSHI bar", ["Sushi restaurant"]), ("plain", None)], "t string, category array<string>")
    assert [r[0] for r in df.select(patterns.mentions(F.col("t"), F.col("category"))).collect()] == [True, False]


def test_media(spark):
    df = spark.createDataFrame([("[1,2]", '{"time": 86400, "text": "thanks"}', 0), ("(1,2,)", "plain reply", 0), (None, None, None), ("x", "{broken", 0)], "pics string, resp string, time long")
    got = df.select(*[v.alias(k) for k, v in fields.media(df).items()]).collect()
    assert [r.pic_count for r in got] == [2, 2, 0, 0]
    assert [r.resp_char_len for r in got] == [6, 11, 0, 7]
    assert [r.response_delay_days for r in got] == [1.0, -1.0, -1.0, -1.0]
    struct = spark.createDataFrame([([("u",)], (86400, "ok"), 0)], "pics array<struct<url:string>>, resp struct<time:long,text:string>, time long")
    r = struct.select(*[v.alias(k) for k, v in fields.media(struct).items()]).first()
    assert (r.with_pics, r.pic_count, r.with_resp, r.response_delay_days) == (True, 1, True, 1.0)


def test_time(spark):
    as_of = 1_700_000_000
    day = 86400
    df = spark.createDataFrame([(as_of - 730 * day, 5), ((as_of - 731 * day) * 1000, 3), (None, None)], "time long, rating int")
    got = df.select(*[v.alias(k) for k, v in fields.temporal(df, as_of).items()], fields.is_recent(F.col("time"), as_of).alias("recent"), fields.year_bin(F.col("time")).alias("bin")).collect()
    assert [r.recent for r in got] == [True, False, False]
    assert [r.age_days for r in got] == [730.0, 731.0, -1.0]
    assert [r.extreme_star for r in got] == [1, 0, 0]
    assert [r.bin for r in got] == ["2019-2021", "2019-2021", "<=2018"]
    assert got[2].review_year == 0


def test_ids(spark):
    df = spark.createDataFrame([("g", None, 1, "t")], "gmap_id string, user_id string, time long, text string")
    want = hashlib.md5(b"g||None||1||t").hexdigest()
    assert fields.with_review_id(df).first()["review_id"] == want
    assert fields.with_review_id(fields.with_review_id(df)).first()["review_id"] == want
    assert fields.ensure_id(df.select("text")).first()["review_id"] == hashlib.md5(b"t").hexdigest()
    assert fields.hashed_id(df, "rid", ["gmap_id", "text"]).first()["rid"] == hashlib.md5(b"g||t").hexdigest()
    assert fields.pick_id(df)[1] == "row_id"


def test_numbers(spark):
    df = spark.createDataFrame([("2",), ("x",), ("-1",), ("nan",), ("0.5",), (None,)], "v string")
    assert [r[0] for r in df.select(fields.clip01(F.col("v"))).collect()] == [1.0, None, 0.0, None, 0.5, None]
    assert [r[0] for r in df.select(fields.finite(F.col("v"))).collect()] == [2.0, 0.0, -1.0, 0.0, 0.5, 0.0]
    assert schema.nan_to_null(df.select(F.col("v").try_cast("double").alias("d"))).where("d IS NULL").count() == 3


def test_defaults(spark):
    df = schema.with_defaults(spark.createDataFrame([("a",)], "text string"))
    assert set(df.columns) == set(schema.REVIEW.names) and isinstance(df.schema["resp"].dataType, T.StructType)
    with pytest.raises(ValueError):
        schema.require(df, ["absent"])


def test_upper_ratio_of_odd_texts(spark):
    """By runs of letters, as by single ones; the letters of a text are searched once."""
    texts = ["", "ABC", "aBc1D é ÀB", "123 é", "x\nY\U0001f600Z", None]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    t = schema.safe_text(F.col("text"))
    made = df.select("text", text.text_form(t, text.token_stats(t))["upper_ratio"].alias("u"))
    for r in made.collect():
        s = "None" if r.text is None else r.text
        letters = sum(c.isascii() and c.isalpha() for c in s)
        assert r.u == (sum(c.isascii() and c.isupper() for c in s) / letters if letters else 0)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("[A-Za-z]") == 1 and "[^A-Za-z]" not in plan
