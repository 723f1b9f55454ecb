"""Queries over the driver's tables, one or more for each operator family, each with DuckDB SQL that gives the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions import fields, patterns, schema, text
from plumbline.functions.schema import BINARY, CONTINUOUS
from plumbline.operators import annotation, features, increments, joins, labeling, metrics, modeling, policy, rules, sampling, sketches, splitting, strata, temporal
from plumbline.sources.scratch import materialize, new_path
from plumbline.streaming import scoring, sessions

#: 2025-01-01 UTC, so that ages don't depend on the day.
AS_OF = 1735689600
SEED = 16

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def reviews(spark, d) -> DataFrame:
    return schema.documents_as_reviews(table(spark, d, "documents"))


def pool(spark, d) -> DataFrame:
    return schema.orders_as_reviews(table(spark, d, "orders"))


R = """reviews AS (SELECT CAST(doc_id AS VARCHAR) AS review_id, doc_id, source AS gmap_id, CAST(doc_id % 97 AS VARCHAR) AS user_id,
  CAST(1483228800 + doc_id * 86400 AS BIGINT) AS time, CAST(1 + doc_id % 5 AS INTEGER) AS rating, text, lang AS category FROM documents)"""
P = """pool AS (SELECT CAST(o_orderkey AS VARCHAR) AS review_id, CAST(o_custkey AS VARCHAR) AS gmap_id, CAST(o_orderkey % 997 AS VARCHAR) AS user_id,
  CAST(epoch(o_orderdate) AS BIGINT) AS time, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS rating,
  CASE o_orderstatus WHEN 'O' THEN 'short' WHEN 'F' THEN 'medium' WHEN 'P' THEN 'long' END AS length_bucket FROM orders)"""
KEY = f"md5(concat('{SEED}|', review_id))"
TOKENS = r"list_filter(regexp_split_to_array(text, '[\s\x1c-\x1f]+'), lambda x: x <> '')"


def n_matches(pattern: str, c: str = "text") -> str:
    return f"CAST(len(regexp_extract_all({c}, '{pattern}')) AS BIGINT)"


def rounded(df: DataFrame, places: int = 9) -> DataFrame:
    return df.select(*[F.round(c, places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


# --- text form, signals, fields ------------------------------------------------------------------


@query(f"""WITH {R}, t AS (SELECT *, {TOKENS} AS tok FROM reviews)
SELECT review_id, CAST(length(text) AS BIGINT) AS char_len, CAST(len(tok) AS BIGINT) AS token_len,
  CASE WHEN len(tok) <= 8 THEN 'short' WHEN length(text) >= 200 THEN 'long' ELSE 'medium' END AS length_bucket,
  {n_matches('[!?.,;:/|_*…-]{2,}')} AS punct_runs, {n_matches('[.]{3,}|…')} AS ellipsis_runs,
  {n_matches('[\U0001F300-\U0001FAFF\U00002600-\U000027BF\U0001F1E6-\U0001F1FF]')} AS emoji_count FROM t""")
def text_form(spark, d):
    t = reviews(spark, d).withColumn("s", text.token_stats(F.col("text")))
    made = text.text_form(F.col("text"), F.col("s"))
    return t.select("review_id", *[made[c].alias(c) for c in ("char_len", "token_len", "length_bucket", "punct_runs", "ellipsis_runs", "emoji_count")])


@query(f"""WITH {R}, t AS (SELECT *, {TOKENS} AS tok FROM reviews)
SELECT review_id, round(coalesce({n_matches('[A-Z]')} / nullif({n_matches('[A-Za-z]')}, 0), 0), 9) AS upper_ratio,
  round(coalesce({n_matches('[0-9]')} / nullif(length(text), 0), 0), 9) AS digit_ratio,
  round(coalesce(len(list_distinct(tok)) / nullif(len(tok), 0), 0), 9) AS unique_token_ratio FROM t""")
def text_ratios(spark, d):
    t = reviews(spark, d).withColumn("s", text.token_stats(F.col("text")))
    made = text.text_form(F.col("text"), F.col("s"))
    return rounded(t.select("review_id", *[made[c].alias(c) for c in ("upper_ratio", "digit_ratio", "unique_token_ratio")]))


@query(f"""WITH {R}, r AS (SELECT *, {n_matches('[^\\x00-\u024f]')} AS other FROM reviews)
SELECT review_id, round(coalesce({n_matches('[\\x00-\\x7F]')} / nullif(length(text), 0), 0), 9) AS ascii_ratio,
  round(coalesce(other / nullif(length(text), 0), 0), 9) AS nonlatin_ratio,
  CAST(coalesce(other / nullif(length(text), 0), 0) > 0.25 AS INTEGER) AS lang_hint_non_en FROM r""")
def language_ratios(spark, d):
    return rounded(reviews(spark, d).select("review_id", *[v.alias(k) for k, v in text.language(F.col("text")).items()]))


@query(f"""WITH {R}, c AS (SELECT review_id, unnest(range(1, length(text) + 1)) AS i, text FROM reviews),
x AS (SELECT review_id, i, substr(text, i, 1) AS ch FROM c),
g AS (SELECT review_id, ch, i - row_number() OVER (PARTITION BY review_id, ch ORDER BY i) AS run FROM x WHERE ch <> chr(10)),
h AS (SELECT review_id, count(*) AS n FROM (SELECT review_id FROM g GROUP BY review_id, ch, run HAVING count(*) >= 3) GROUP BY review_id)
SELECT r.review_id, CAST(coalesce(n, 0) AS BIGINT) AS elong_runs FROM reviews r LEFT JOIN h USING (review_id)""")
def elong_runs(spark, d):
    return reviews(spark, d).select("review_id", text.count(F.col("text"), text.ELONGATED).alias("elong_runs"))


@query(rf"""WITH {R} SELECT review_id,
  regexp_matches(text, '[+]?[0-9][0-9\s().-]{{7,}}[0-9]') AS has_phone_any,
  regexp_matches(text, '(?i)(^|[^\pL\pN_])[A-Z0-9._%+-]+@[A-Z0-9.-]+[.][A-Z]{{2,}}([^\pL\pN_]|$)') AS has_email,
  regexp_matches(text, '([+]?1[\s.-]?)?[(]?[0-9]{{3}}[)]?[\s.-]?[0-9]{{3}}[\s.-]?[0-9]{{4}}') AS has_phone_us,
  regexp_matches(text, '(?i)(^|[\s:])@[\pL\pN_.]{{2,}}') AS has_social_handle,
  regexp_matches(text, '(^|\s)#[\pL\pN_]{{2,}}') AS has_hashtag FROM reviews""")
def contact_flags(spark, d):
    return reviews(spark, d).select("review_id", *[F.col("text").rlike(patterns.FLAGS[c]).alias(c) for c in ("has_phone_any", "has_email", "has_phone_us", "has_social_handle", "has_hashtag")])


@query(r"""SELECT page_id, regexp_matches(url, '(?i)\b(https?://|www[.])\S+\b') AS has_url,
  regexp_matches(url, '(?i)\b([a-z0-9]([a-z0-9-]{0,61}[a-z0-9])?[.])+(com|net|org|io|co|ai|me|shop|store|biz|info|app|site|uk|us|ca|sg)(/\S*)?\b') AS has_domain,
  regexp_matches(url, '(?i)\b(bit[.]ly|t[.]co|goo[.]gl|tinyurl[.]com|lnkd[.]in|rebrand[.]ly|is[.]gd|buff[.]ly|ow[.]ly|cutt[.]ly)/\S+\b') AS has_short_url FROM pages""")
def url_flags_pages(spark, d):
    return table(spark, d, "pages").select("page_id", *[F.col("url").rlike(patterns.FLAGS[c]).alias(c) for c in ("has_url", "has_domain", "has_short_url")])


_LEX = ["that", "with the", "of"]


@query(rf"""WITH {R} SELECT review_id, CAST(len(regexp_extract_all(regexp_replace(lower(text), '([^\pL\pN_])', ' \1 ', 'g'), '\s(that|with\s+the|of)\s')) AS BIGINT) AS hits
FROM (SELECT review_id, ' ' || text || ' ' AS text FROM reviews)""")
def lexicon_hits(spark, d):
    return reviews(spark, d).select("review_id", text.count(F.col("text"), patterns.lexicon(_LEX)).alias("hits"))


@query(f"WITH {R} SELECT review_id, contains(lower(text), lower(category)) AS mentions_category FROM reviews")
def category_mention(spark, d):
    return reviews(spark, d).select("review_id", patterns.mentions(F.col("text"), F.col("category")).alias("mentions_category"))


@query(f"""WITH {R}, t AS (SELECT *, make_timestamp(time * 1000000) AS ts FROM reviews)
SELECT review_id, CAST(year(ts) AS INTEGER) AS review_year, CAST(month(ts) AS INTEGER) AS review_month, CAST(isodow(ts) - 1 AS INTEGER) AS review_dow,
  CAST(hour(ts) AS INTEGER) AS review_hour, round(({AS_OF} - time) / 86400.0, 6) AS age_days, CAST(rating IN (1, 5) AS INTEGER) AS extreme_star,
  CASE WHEN year(ts) <= 2018 THEN '<=2018' WHEN year(ts) <= 2021 THEN '2019-2021' WHEN year(ts) <= 2023 THEN '2022-2023' ELSE '2024+' END AS year_bin,
  ({AS_OF} - time) / 86400.0 <= 730 AS recent FROM t""")
def time_parts(spark, d):
    r = reviews(spark, d)
    made = fields.temporal(r, AS_OF) | {"year_bin": fields.year_bin(F.col("time")), "recent": fields.is_recent(F.col("time"), AS_OF)}
    return rounded(r.select("review_id", *[v.alias(k) for k, v in made.items()]), 6)


@query("""SELECT event_id, CAST(s AS DOUBLE) AS seconds FROM (SELECT event_id, floor(epoch(ts)) AS s FROM events)""")
def epoch_autounit(spark, d):
    """Half of the times are given in milliseconds."""
    e = table(spark, d, "events")
    s = F.unix_timestamp("ts")
    return e.select("event_id", fields.epoch_seconds(F.when(F.col("event_id") % 2 == 0, s * 1000).otherwise(s)).alias("seconds"))


@query(f"WITH {R} SELECT review_id AS row_id, md5(concat(gmap_id, '||', user_id, '||', CAST(time AS VARCHAR), '||', text)) AS review_id FROM reviews")
def review_id_md5(spark, d):
    return fields.with_review_id(reviews(spark, d).withColumnRenamed("review_id", "row_id")).select("row_id", "review_id")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def event_props(spark, d):
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


# --- windows, rules --------------------------------------------------------------------------------

_W = """SELECT review_id, CAST(count(*) OVER (PARTITION BY gmap_id) AS BIGINT) AS place_review_count,
  round(avg(rating) OVER (PARTITION BY gmap_id), 9) AS place_rating_mean,
  round(coalesce(stddev_samp(rating) OVER (PARTITION BY gmap_id), 0), 9) AS place_rating_std,
  round(rating - avg(rating) OVER (PARTITION BY gmap_id), 9) AS rating_dev_from_place_mean,
  CAST(count(*) OVER (PARTITION BY gmap_id, text) AS BIGINT) AS text_dup_count_place,
  CAST(count(*) OVER (PARTITION BY user_id) AS BIGINT) AS user_review_count,
  round(avg(rating) OVER (PARTITION BY user_id), 9) AS user_rating_mean,
  round(coalesce(stddev_samp(rating) OVER (PARTITION BY user_id), 0), 9) AS user_rating_std,
  round(rating - avg(rating) OVER (PARTITION BY user_id), 9) AS rating_dev_from_user_mean FROM reviews"""


@query(f"WITH {R} {_W}")
def group_windows(spark, d):
    r = reviews(spark, d)
    joined, made = features.group_windows(r)
    return rounded(joined.select("review_id", *[v.alias(k) for k, v in made.items()]))


@query(f"WITH {R} {_W}")
def incremental_windows(spark, d):
    """The same columns from aggregates that came in five increments and were merged, none of which was read again."""
    r = reviews(spark, d)
    book = increments.Book(spark, new_path(spark), fan=2)
    for k in range(5):
        book.add(r.where(F.pmod(F.xxhash64("review_id"), F.lit(5)) == k), f"part-{k}")
    joined, made = book.windows(r)
    return rounded(joined.select("review_id", *[v.alias(k) for k, v in made.items()]))


_RULES = rf"""f AS (SELECT review_id, gmap_id, {TOKENS} AS tok, text, category,
  CAST(regexp_matches(text, '[+]?[0-9][0-9\s().-]{{7,}}[0-9]') AS INTEGER) AS phone,
  CAST(regexp_matches(text, '([+]?1[\s.-]?)?[(]?[0-9]{{3}}[)]?[\s.-]?[0-9]{{3}}[\s.-]?[0-9]{{4}}') AS INTEGER) AS us,
  CAST(regexp_matches(text, '(?i)(^|[^\pL\pN_])[A-Z0-9._%+-]+@[A-Z0-9.-]+[.][A-Z]{{2,}}([^\pL\pN_]|$)') AS INTEGER) AS email,
  {n_matches('[!?.,;:/|_*…-]{2,}')} AS punct_runs, CAST(count(*) OVER (PARTITION BY gmap_id, text) AS BIGINT) AS dup FROM reviews)"""


@query(rf"""WITH {R}, {_RULES}, s AS (SELECT review_id, gmap_id, (phone + email + us) / 14.0 AS ads,
  (CAST(len(tok) <= 8 AS INTEGER) + CAST(punct_runs >= 1 AS INTEGER) + CAST(dup >= 2 AS INTEGER)) / 6.0 AS spam FROM f)
SELECT review_id, round(CAST(ads AS DOUBLE), 9) AS rule_ads_score, round(CAST(spam AS DOUBLE), 9) AS short_punct_dup_score FROM s""")
def rules_scores(spark, d):
    """The rule scores, on the signals that the oracle's dialect can state; on all signals: rules_scores_whole."""
    r = reviews(spark, d)
    f = features.features(r, AS_OF, groups=("text_form", "ad_promo", "aggregates"))
    known = ("has_phone_any", "has_email", "has_phone_us")
    f = f.withColumns({c: F.lit(False) for c in patterns.FLAGS if c not in known} | {"promo_hits": F.lit(0), "contact_hits": F.lit(0), "emoji_count": F.lit(0), "elong_runs": F.lit(0)})
    scored = rules.rules(f)
    return rounded(scored.select("review_id", "rule_ads_score", F.col("rule_spam_score").alias("short_punct_dup_score")))


@query(rf"""WITH {R}, {_RULES}, s AS (SELECT gmap_id, (phone + email + us) / 14.0 AS ads,
  (CAST(len(tok) <= 8 AS INTEGER) + CAST(punct_runs >= 1 AS INTEGER) + CAST(dup >= 2 AS INTEGER)) / 6.0 AS spam FROM f)
SELECT gmap_id, count(*) AS n, CAST(sum(CAST(ads >= 0.15 AS INTEGER)) AS BIGINT) AS ads, CAST(sum(CAST(spam >= 0.3 AS INTEGER)) AS BIGINT) AS spam,
  CAST(sum(CAST(ads < 0.15 AND spam < 0.3 AS INTEGER)) AS BIGINT) AS none FROM s GROUP BY gmap_id""")
def rules_by_place(spark, d):
    """Flagged reviews of each place on the oracle's signals only (all: rules_by_place_whole), with cutoffs low enough for the tables to have some."""
    f = features.features(reviews(spark, d), AS_OF, groups=("text_form", "ad_promo", "aggregates"))
    known = ("has_phone_any", "has_email", "has_phone_us")
    f = f.withColumns({c: F.lit(False) for c in patterns.FLAGS if c not in known} | {"promo_hits": F.lit(0), "contact_hits": F.lit(0), "emoji_count": F.lit(0), "elong_runs": F.lit(0)})
    scored = rules.rules(f, {**rules.STRONG, "ads": 0.15, "spam": 0.3})
    total = lambda c: F.sum(F.col(c).cast("long"))
    return scored.groupBy("gmap_id").agg(F.count(F.lit(1)).alias("n"), total("rule_ads_strong").alias("ads"), total("rule_spam_strong").alias("spam"), total("rule_none").alias("none"))


_TOP, _SHORT = "|".join(patterns.TOP_LEVEL), "|".join(h.replace(".", "[.]") for h in patterns.SHORTENERS)
_START, _END = r"(^|[^\pL\pN_])", r"([^\pL\pN_]|$)"


def _listed(name: str) -> str:
    """Whether a text has any term of a lexicon as whole words."""
    terms = "|".join(t.replace("'", "''").replace(" ", r"\s+") for t in patterns.LEXICONS[name])
    return f"regexp_matches(text, '(?i){_START}({terms}){_END}')"


#: The twelve flags in a dialect without look-around or Unicode word boundaries.
_SHAPES = {
    "has_url": rf"(?i){_START}(https?://|www[.])\S*[\pL\pN_]",
    "has_domain": rf"(?i){_START}([a-z0-9]([a-z0-9-]{{0,61}}[a-z0-9])?[.])+({_TOP}){_END}",
    "has_short_url": rf"(?i){_START}({_SHORT})/\S*[\pL\pN_]",
    "has_phone_us": r"([+]?1[\s.-]?)?[(]?\d{3}[)]?[\s.-]?\d{3}[\s.-]?\d{4}",
    "has_phone_any": r"[+]?\d[\d\s().-]{7,}\d",
    "has_email": rf"(?i){_START}[A-Z0-9._%+-]+@[A-Z0-9.-]+[.][A-Z]{{2,}}{_END}",
    "has_social_handle": r"(^|[\s:])@[\pL\pN_.]{2,}",
    "has_hashtag": r"(^|\s)#[\pL\pN_]{2,}",
    "has_currency": rf"(?i)({_START}(USD|SGD|US[$]|S[$])|[\pL\pN_][$])\s?\d{{1,4}}([.,]\d{{3}})*([.]\d{{2}})?{_END}",
    "has_percent_off": rf"(?i){_START}\d{{1,3}}\s?%(\s*(off|discount){_END}|[\pL\pN_])",
    "has_promo_code": rf"(?i){_START}(use|apply|enter)\s+(code|coupon)\s+[A-Z0-9-]{{3,}}[A-Z0-9](-|{_END})",
    "has_cta": rf"(?i){_START}((dm|pm|message|whatsapp|telegram|call|text)\s+(me|us|now)|order now|limited time|link in bio){_END}",
}
_RULED = rf"""{R}, c AS (SELECT review_id, unnest(range(1, length(text) + 1)) AS i, text FROM reviews),
x AS (SELECT review_id, i, substr(text, i, 1) AS ch FROM c),
w AS (SELECT review_id, ch, i - row_number() OVER (PARTITION BY review_id, ch ORDER BY i) AS run FROM x WHERE ch <> chr(10)),
long_runs AS (SELECT DISTINCT review_id FROM w GROUP BY review_id, ch, run HAVING count(*) >= 3),
f AS (SELECT review_id, gmap_id, {TOKENS} AS tok, {", ".join(f"CAST(regexp_matches(text, '{p}') AS INTEGER) AS {k}" for k, p in _SHAPES.items())},
  CAST({_listed("promo")} AS INTEGER) AS promo, CAST({_listed("contact")} AS INTEGER) AS contact, {_listed("nonvisit")} AS nonvisit, {_listed("offtopic")} AS offtopic,
  contains(lower(text), lower(category)) AS mentioned, {n_matches('[!?.,;:/|_*…-]{2,}')} AS punct_runs,
  {n_matches('[🌀-🫿☀-➿🇦-🇿]')} AS emoji, CAST(count(*) OVER (PARTITION BY gmap_id, text) AS BIGINT) AS dup,
  CAST(review_id IN (SELECT review_id FROM long_runs) AS INTEGER) AS elong FROM reviews),
s AS (SELECT review_id, gmap_id, ({" + ".join(_SHAPES)} + promo + contact) / 14.0::DOUBLE AS ads,
  (CAST(len(tok) <= 8 AS INTEGER) + has_short_url + CAST(punct_runs >= 1 AS INTEGER) + elong + CAST(emoji >= 3 AS INTEGER) + CAST(dup >= 2 AS INTEGER)) / 6.0::DOUBLE AS spam,
  CAST(offtopic AND NOT mentioned AS DOUBLE) AS irrelevant, CAST(nonvisit AS DOUBLE) AS rant FROM f),
b AS (SELECT *, CAST(ads >= 0.4 AS INTEGER) AS rule_ads_strong, CAST(spam >= 0.6 AS INTEGER) AS rule_spam_strong, CAST(irrelevant >= 0.5 AS INTEGER) AS rule_irrelevant_strong, CAST(rant >= 0.5 AS INTEGER) AS rule_rant_strong FROM s),
ruled AS (SELECT *, CAST(rule_ads_strong + rule_spam_strong + rule_irrelevant_strong + rule_rant_strong = 0 AS INTEGER) AS rule_none FROM b)"""


def _ruled(spark, d) -> DataFrame:
    """All groups of features and the rules on all of their signals, unchanged."""
    return rules.rules(features.features(reviews(spark, d), AS_OF, carry=("review_id", "gmap_id", "user_id", "time", "rating", "category")))


@query(f"""WITH {_RULED} SELECT review_id, round(ads, 9) AS rule_ads_score, round(spam, 9) AS rule_spam_score, irrelevant AS rule_irrelevant_score, rant AS rule_rant_score,
  rule_ads_strong, rule_spam_strong, rule_irrelevant_strong, rule_rant_strong, rule_none FROM ruled""")
def rules_scores_whole(spark, d):
    """The four rule scores, strong flags and rule_none on all signals."""
    return rounded(_ruled(spark, d).select("review_id", *[f"rule_{k}_score" for k in rules.STRONG], *[f"rule_{k}_strong" for k in rules.STRONG], "rule_none"))


@query(f"""WITH {_RULED} SELECT gmap_id, count(*) AS n, CAST(sum(rule_ads_strong) AS BIGINT) AS ads, CAST(sum(rule_spam_strong) AS BIGINT) AS spam,
  CAST(sum(rule_irrelevant_strong) AS BIGINT) AS irrelevant, CAST(sum(rule_rant_strong) AS BIGINT) AS rant, CAST(sum(rule_none) AS BIGINT) AS none FROM ruled GROUP BY gmap_id""")
def rules_by_place_whole(spark, d):
    """Flagged reviews of each place, on all signals and with the rules' own cutoffs."""
    total = lambda c: F.sum(F.col(c).cast("long"))
    return _ruled(spark, d).groupBy("gmap_id").agg(F.count(F.lit(1)).alias("n"), *[total(f"rule_{k}_strong").alias(k) for k in rules.STRONG], total("rule_none").alias("none"))


@query(f"""WITH {R} SELECT review_id, rating, category, CAST(length(text) AS BIGINT) AS char_len, CAST(0 AS BIGINT) AS pic_count, false AS with_resp FROM reviews""")
def feature_stage(spark, d):
    """All eight groups in one plan; the columns here are those without a counterpart elsewhere in this catalogue."""
    f = features.features(reviews(spark, d), AS_OF, carry=(*features.CARRY, "category"))
    return f.select("review_id", "rating", "category", "char_len", "pic_count", "with_resp")


@query()
def feature_stage_whole(spark, d):
    """All columns of all eight groups in one plan; feature_stage has those of its SQL only."""
    return features.features(reviews(spark, d), AS_OF, carry=(*features.CARRY, "category"))


# --- joins, dedup ----------------------------------------------------------------------------------


@query("""SELECT o_orderkey AS review_id, CAST(o_custkey AS BIGINT) AS gmap_id, c_name, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def meta_left_join(spark, d):
    r = table(spark, d, "orders").select(F.col("o_orderkey").alias("review_id"), F.col("o_custkey").alias("gmap_id"))
    meta = table(spark, d, "customer").select(F.col("c_custkey").alias("gmap_id"), "c_name", "c_mktsegment")
    return joins.merge_metadata(r, meta)


@query("""SELECT c_nationkey, c_custkey, c_name FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey, c_name) AS n FROM customer) WHERE n = 1""")
def meta_dedup_first(spark, d):
    return joins.keep_first(table(spark, d, "customer").select("c_nationkey", "c_custkey", "c_name"), ["c_nationkey"])


@query(f"WITH {R} SELECT gmap_id, review_id FROM (SELECT *, row_number() OVER (PARTITION BY gmap_id, text ORDER BY review_id) AS n FROM reviews) WHERE n = 1")
def dedup_exact_text(spark, d):
    return joins.keep_first(reviews(spark, d), ["gmap_id", "text"], [F.col("review_id")]).select("gmap_id", "review_id")


_S = {k: f"CAST((doc_id * {p}) % 1000 AS DOUBLE) / 1000.0" for k, p in zip(schema.SCORES, (7919, 7907, 7901, 7883, 7879, 7877), strict=True)}
S = f"silver AS (SELECT CAST(doc_id AS VARCHAR) AS review_id, {', '.join(f'{v} AS {k}' for k, v in _S.items())} FROM documents)"


def pseudo_silver(spark, d) -> DataFrame:
    """Scores by arithmetic in place of a model's."""
    return table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("review_id"), *[F.expr(v).alias(k) for k, v in _S.items()])


@query(f"WITH {R}, {S} SELECT s.*, r.gmap_id, r.rating FROM silver s LEFT JOIN reviews r USING (review_id)")
def silver_base_merge(spark, d):
    return joins.merge_with_base(reviews(spark, d).select("review_id", "gmap_id", "rating"), pseudo_silver(spark, d))


_FLAGS = "flags AS (SELECT CAST(doc_id AS VARCHAR) AS review_id, CAST(toxic = 1 AS INTEGER) AS a, CAST(quality = 0 AS INTEGER) AS b FROM labels)"


def _flagged(spark, d):
    """Flags by the labels, which cover some of the documents."""
    return table(spark, d, "labels").select(F.col("doc_id").cast("string").alias("review_id"), (F.col("toxic") == 1).cast("int").alias("rule_ads_strong"), (F.col("quality") == 0).cast("int").alias("rule_spam_strong"))


@query(f"""WITH {S}, {_FLAGS} SELECT review_id, CASE WHEN a = 1 THEN greatest(ads_promo, 0.9) ELSE ads_promo END AS ads_promo,
  CASE WHEN b = 1 THEN greatest(spam_low_quality, 0.85) ELSE spam_low_quality END AS spam_low_quality FROM silver LEFT JOIN flags USING (review_id)""")
def rule_fusion_max(spark, d):
    return joins.fuse_with_rules(pseudo_silver(spark, d), _flagged(spark, d)).select("review_id", "ads_promo", "spam_low_quality")


@query(f"""WITH {S}, {_FLAGS} SELECT review_id, round(CASE WHEN a = 1 THEN 0.7 * 0.9 + 0.3 * ads_promo ELSE ads_promo END, 9) AS ads_promo,
  round(CASE WHEN b = 1 THEN 0.7 * 0.85 + 0.3 * spam_low_quality ELSE spam_low_quality END, 9) AS spam_low_quality FROM silver LEFT JOIN flags USING (review_id)""")
def rule_fusion_blend(spark, d):
    return rounded(joins.fuse_with_rules(pseudo_silver(spark, d), _flagged(spark, d), mode="blend").select("review_id", "ads_promo", "spam_low_quality"))


@query("""WITH a AS (SELECT doc_id AS review_id, doc_id % 1000 / 1000.0 AS pred_ads_promo FROM documents),
b AS (SELECT doc_id AS review_id, doc_id % 500 / 500.0 AS pred_irrelevant FROM labels)
SELECT review_id, CAST(pred_ads_promo AS DOUBLE) AS pred_ads_promo, CAST(pred_irrelevant AS DOUBLE) AS pred_irrelevant FROM a FULL JOIN b USING (review_id)""")
def merge_predictions(spark, d):
    """Predictions for all documents and for the labelled ones."""
    a = table(spark, d, "documents").select(F.col("doc_id").alias("review_id"), (F.col("doc_id") % 1000 / 1000.0).alias("pred_ads_promo"))
    b = table(spark, d, "labels").select(F.col("doc_id").alias("review_id"), (F.col("doc_id") % 500 / 500.0).alias("pred_irrelevant"))
    return joins.merge_predictions([a, b])


# --- sampling --------------------------------------------------------------------------------------


@query(f"WITH {P} SELECT review_id, gmap_id FROM (SELECT *, row_number() OVER (PARTITION BY gmap_id ORDER BY {KEY}, review_id) AS n FROM pool) WHERE n <= 5")
def cap_per_place(spark, d):
    return sampling.cap_per_key(pool(spark, d).select("review_id", "gmap_id"), "gmap_id", 5, SEED)


_POP = """sizes AS (SELECT gmap_id, count(*) AS n FROM pool GROUP BY gmap_id), q AS (SELECT quantile_cont(n, 0.33) AS a, quantile_cont(n, 0.66) AS b FROM sizes),
tiers AS (SELECT gmap_id, CASE WHEN n <= a THEN 'tail' WHEN n <= b THEN 'mid' ELSE 'head' END AS pop FROM sizes, q)"""


@query(f"WITH {P}, {_POP} SELECT review_id, pop FROM pool JOIN tiers USING (gmap_id)")
def popularity_tier(spark, d):
    return sampling.popularity(pool(spark, d)).select("review_id", "pop")


def _quota(n: int, keys: str = "rating, length_bucket") -> str:
    return f"""counts AS (SELECT {keys}, count(*) AS c FROM pool GROUP BY ALL), q0 AS (SELECT *, round_even(c * ({n} / sum(c) OVER ()), 0) AS q, row_number() OVER (ORDER BY c DESC, rating NULLS FIRST, length_bucket NULLS FIRST) AS k FROM counts),
quota AS (SELECT {keys}, c, CAST(q + CASE WHEN k <= abs({n} - sum(q) OVER ()) THEN sign({n} - sum(q) OVER ()) ELSE 0 END AS BIGINT) AS q FROM q0)"""


@query(f"WITH {P}, {_quota(700)} SELECT rating, length_bucket, c AS count, q AS quota FROM quota")
def strat_quota(spark, d):
    return sampling.quotas(pool(spark, d).groupBy("rating", "length_bucket").count(), ["rating", "length_bucket"], 700)


@query(f"""WITH {P}, {_quota(700)}, r AS (SELECT p.*, q, row_number() OVER (PARTITION BY p.rating, p.length_bucket ORDER BY {KEY}, review_id) AS n
  FROM pool p JOIN quota u ON p.rating IS NOT DISTINCT FROM u.rating AND p.length_bucket IS NOT DISTINCT FROM u.length_bucket)
SELECT review_id, rating, length_bucket FROM r ORDER BY n <= q DESC, {KEY}, review_id LIMIT 700""")
def strat_sample(spark, d):
    return sampling.proportional_sample(pool(spark, d).select("review_id", "rating", "length_bucket"), ["rating", "length_bucket"], 700, SEED)


@query(f"WITH {P} SELECT review_id FROM pool ORDER BY {KEY}, review_id LIMIT 500")
def random_sample(spark, d):
    """A sampling operator: 500 rows."""
    return sampling.random_sample(pool(spark, d).select("review_id"), 500, SEED)


def _sampler_sql(target: int, as_of: int) -> str:
    """The whole sampler: caps, tiers, then each floor and target as a proportional sample of the rows not yet chosen."""
    steps = [("recent", half_even(0.30 * target), "recent")] + [(f"pop = '{tier}'", half_even(share * target), f"pop = '{tier}'") for tier, share in (("tail", 0.25), ("mid", 0.50), ("head", 0.25))] + [("true", target, "true")]
    ctes = [
        P,
        f"""c1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY gmap_id ORDER BY {KEY}, review_id) AS n1 FROM pool) WHERE n1 <= 50)""",
        f"""c2 AS (SELECT review_id, gmap_id, rating, ({as_of} - time) / 86400.0 <= 730 AS recent, CASE WHEN year(ts) <= 2018 THEN '<=2018' WHEN year(ts) <= 2021 THEN '2019-2021' WHEN year(ts) <= 2023 THEN '2022-2023' ELSE '2024+' END AS year_bin
  FROM (SELECT *, make_timestamp(time * 1000000) AS ts, row_number() OVER (PARTITION BY user_id ORDER BY {KEY}, review_id) AS n2 FROM c1) WHERE n2 <= 10)""",
        "sizes AS (SELECT gmap_id, count(*) AS n FROM c2 GROUP BY gmap_id)",
        "q AS (SELECT quantile_cont(n, 0.33) AS a, quantile_cont(n, 0.66) AS b FROM sizes)",
        "tiered AS MATERIALIZED (SELECT c2.*, CASE WHEN n <= a THEN 'tail' WHEN n <= b THEN 'mid' ELSE 'head' END AS pop FROM c2 JOIN sizes USING (gmap_id), q)",
        "chosen0 AS (SELECT review_id FROM tiered WHERE false)",
    ]
    for i, (mask, most, counted) in enumerate(steps, 1):
        have = "0" if mask == "recent" else f"(SELECT count(*) FROM tiered WHERE ({counted}) AND review_id IN (SELECT review_id FROM chosen{i - 1}))"
        ctes += [
            f"need{i} AS MATERIALIZED (SELECT greatest(0, {most} - {have}) AS n)",
            f"left{i} AS MATERIALIZED (SELECT * FROM tiered WHERE {mask} AND review_id NOT IN (SELECT review_id FROM chosen{i - 1}))",
            f"s{i} AS (SELECT rating, year_bin, count(*) AS c FROM left{i} GROUP BY ALL)",
            f"q{i} AS (SELECT s.*, n, round_even(c * (n / sum(c) OVER ()), 0) AS q, row_number() OVER (ORDER BY c DESC, rating NULLS FIRST, year_bin NULLS FIRST) AS k FROM s{i} s, need{i})",
            f"u{i} AS (SELECT rating, year_bin, q + CASE WHEN k <= abs(n - sum(q) OVER ()) THEN sign(n - sum(q) OVER ()) ELSE 0 END AS q FROM q{i})",
            f"r{i} AS (SELECT l.review_id, q, row_number() OVER (PARTITION BY l.rating, l.year_bin ORDER BY {KEY.replace('review_id', 'l.review_id')}, l.review_id) AS n FROM left{i} l JOIN u{i} u ON l.rating = u.rating AND l.year_bin = u.year_bin)",
            f"chosen{i} AS MATERIALIZED (SELECT review_id FROM chosen{i - 1} UNION ALL (SELECT review_id FROM r{i} ORDER BY n <= q DESC, {KEY}, review_id LIMIT (SELECT n FROM need{i})))",
        ]
    whole = f"(SELECT count(*) FROM tiered) <= {target}"
    return f"WITH {', '.join(ctes)} SELECT review_id FROM tiered WHERE {whole} UNION ALL SELECT review_id FROM chosen{len(steps)} WHERE NOT {whole}"


def half_even(x: float) -> int:
    return int(round(x))


@query(_sampler_sql(1000, 999_000_000))
def full_sampler(spark, d):
    """The ids that the whole sampler picks of the orders: a sampling operator, 1,000 rows."""
    p = pool(spark, d).select("*", F.lit("some words").alias("text"))
    cfg = sampling.Sampler(target=1000, region=None)
    return sampling.sample_ids(sampling.prepared_pool(p, cfg, 999_000_000), cfg).select("review_id")  # as_of: within the orders' years


@query(f"""WITH votes AS (SELECT CAST(user_id AS VARCHAR) AS review_id, event_type AS annotator_id, CAST(value > 250 AS INTEGER) AS v, value / 500 AS s FROM events)
SELECT review_id, CAST(2 * sum(v) >= count(*) AS INTEGER) AS ads_promo, round(avg(s), 6) AS relevancy_score, count(DISTINCT annotator_id) AS n_annot FROM votes GROUP BY review_id""")
def gold_majority(spark, d):
    e = table(spark, d, "events").select(F.col("user_id").cast("string").alias("review_id"), F.col("event_type").alias("annotator_id"), *[(F.col("value") > 250).cast("int").alias(k) for k in BINARY], *[(F.col("value") / 500).alias(k) for k in CONTINUOUS])
    return rounded(annotation.majority(e).select("review_id", "ads_promo", "relevancy_score", "n_annot"), 6)


@query()
def gold_pack(spark, d):
    f = features.features(reviews(spark, d), AS_OF, carry=(*features.CARRY, "category"))
    return sampling.gold_pack(rules.rules(f), AS_OF)


# --- splitting -------------------------------------------------------------------------------------

_CUTS = """cuts AS (SELECT quantile_cont(ads_promo, 0.95) AS a, quantile_cont(spam_low_quality, 0.95) AS s, quantile_cont(irrelevant, 0.95) AS i, quantile_cont(rant_no_visit, 0.97) AS r FROM silver)"""
_BINS = f"""{S}, {_CUTS}, bins AS (SELECT silver.*, CAST(ads_promo > a AS INTEGER) AS ads_promo_bin, CAST(spam_low_quality > s AS INTEGER) AS spam_low_quality_bin,
  CAST(irrelevant > i AS INTEGER) AS irrelevant_bin, CAST(rant_no_visit > r AS INTEGER) AS rant_no_visit_bin FROM silver, cuts)"""


def _bins(spark, d) -> DataFrame:
    s = pseudo_silver(spark, d)
    return splitting.binarize(s, splitting.cuts(s, splitting.Split().prevalence))


@query(f"""WITH {_BINS} SELECT review_id, ads_promo_bin, spam_low_quality_bin, irrelevant_bin, rant_no_visit_bin,
  CAST(relevancy_score >= 0.6 AND greatest(ads_promo_bin, spam_low_quality_bin, irrelevant_bin, rant_no_visit_bin) = 0 AS INTEGER) AS genuine_bin FROM bins""")
def binarize_genuine(spark, d):
    return _bins(spark, d).select("review_id", *[f"{k}_bin" for k in BINARY], "genuine_bin")


@query(f"""WITH {S}, p AS (SELECT review_id, list_transform([ads_promo, spam_low_quality, irrelevant, rant_no_visit], lambda x: x + 1e-6) AS p FROM silver),
q AS (SELECT review_id, list_transform(p, lambda x: x / list_sum(p)) AS q FROM p)
SELECT review_id, round(greatest(0.05, least(1.0, 1 + list_sum(list_transform(q, lambda x: x * ln(x))) / ln(4))), 9) AS sample_weight FROM q""")
def sample_weight(spark, d):
    return rounded(pseudo_silver(spark, d).select("review_id", splitting.sample_weight().alias("sample_weight")))


_GROUPED = f"{R}, {_BINS}, rows AS (SELECT b.*, r.gmap_id, r.time FROM bins b JOIN reviews r USING (review_id))"


def _rows(spark, d) -> DataFrame:
    return _bins(spark, d).join(reviews(spark, d).select("review_id", "gmap_id", "time", "user_id"), "review_id")


@query(f"""WITH {_GROUPED}, best AS (SELECT gmap_id, max(ads_promo) AS s FROM rows GROUP BY gmap_id HAVING max(ads_promo_bin) = 0 ORDER BY s DESC, gmap_id LIMIT 3)
SELECT review_id, CASE WHEN gmap_id IN (SELECT gmap_id FROM best) THEN 1 ELSE ads_promo_bin END AS ads_promo_bin FROM rows""")
def sparsity_top_groups(spark, d):
    return splitting.mark_top_groups(_rows(spark, d), "ads_promo", 3, "gmap_id").select("review_id", "ads_promo_bin")


@query(f"""WITH {R} SELECT gmap_id FROM (SELECT gmap_id, max(time) AS t FROM reviews GROUP BY gmap_id)
ORDER BY t DESC, gmap_id DESC LIMIT (SELECT greatest(1, CAST(round_even(0.1 * count(DISTINCT gmap_id), 0) AS BIGINT)) FROM reviews)""")
def time_holdout(spark, d):
    return splitting.holdout_groups(reviews(spark, d), 10, "gmap_id")


_USER = f"{R}, {_BINS}, rows AS (SELECT b.*, r.user_id FROM bins b JOIN reviews r USING (review_id))"
_LABEL = """sums AS (SELECT user_id, [struct_pack(n := sum(ads_promo_bin), m := avg(ads_promo), o := 0, l := 'ads_promo'), struct_pack(n := sum(spam_low_quality_bin), m := avg(spam_low_quality), o := -1, l := 'spam_low_quality'),
  struct_pack(n := sum(irrelevant_bin), m := avg(irrelevant), o := -2, l := 'irrelevant'), struct_pack(n := sum(rant_no_visit_bin), m := avg(rant_no_visit), o := -3, l := 'rant_no_visit')] AS x FROM rows GROUP BY user_id),
labelled AS (SELECT user_id, CASE WHEN list_max(x).n > 0 THEN list_max(x).l ELSE 'genuine' END AS label FROM sums)"""


@query(f"WITH {_USER}, {_LABEL} SELECT user_id, label FROM labelled")
def group_major_label(spark, d):
    return splitting.group_labels(_rows(spark, d), "user_id")


@query(f"""WITH {_USER}, {_LABEL}, k AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(concat('{SEED}|', user_id)), user_id) - 1 AS i, count(*) OVER (PARTITION BY label) AS n FROM labelled)
SELECT user_id, label, CASE WHEN i < round_even(n * 0.7::DOUBLE, 0) THEN 'train' WHEN i < round_even(n * 0.7::DOUBLE, 0) + round_even(n * 0.15::DOUBLE, 0) THEN 'val' ELSE 'test' END AS split FROM k""")
def group_split(spark, d):
    return splitting.assign(splitting.group_labels(_rows(spark, d), "user_id"), seed=SEED, group="user_id")


def _rebalance_sql() -> str:
    """The split stage by user: enough positives in all, groups by label, and up to sixteen moves of whole groups."""
    cfg = splitting.Split()
    ctes = [R, _BINS, "rows0 AS (SELECT b.*, r.user_id FROM bins b JOIN reviews r USING (review_id) WHERE trim(coalesce(text, '')) <> '')"]
    for k in BINARY:
        ctes.append(f"top_{k} AS MATERIALIZED (SELECT user_id FROM (SELECT user_id, max({k}) AS s FROM rows0 GROUP BY user_id HAVING max({k}_bin) = 0) ORDER BY s DESC NULLS LAST, user_id LIMIT (SELECT greatest(0, {cfg.min_total[k]} - coalesce(sum({k}_bin), 0)) FROM rows0))")
    marked = ", ".join(f"CASE WHEN user_id IN (SELECT user_id FROM top_{k}) THEN 1 ELSE {k}_bin END AS {k}_bin" for k in BINARY)
    sums = ", ".join(f"CAST(sum({k}_bin) AS BIGINT) AS {k}_bin" for k in BINARY)
    ctes += [
        f"rows AS MATERIALIZED (SELECT review_id, user_id, {', '.join(BINARY)}, {marked} FROM rows0)",
        _LABEL,
        f"k AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(concat('{SEED}|', user_id)), user_id) - 1 AS i, count(*) OVER (PARTITION BY label) AS n FROM labelled)",
        f"t0 AS MATERIALIZED (SELECT user_id, CASE WHEN i < round_even(n * 0.7::DOUBLE, 0) THEN 'train' WHEN i < round_even(n * 0.7::DOUBLE, 0) + round_even(n * 0.15::DOUBLE, 0) THEN 'val' ELSE 'test' END AS split, {', '.join(f'{k}_bin' for k in BINARY)} FROM k JOIN (SELECT user_id, {sums} FROM rows GROUP BY user_id) USING (user_id))",
    ]
    n = 0
    for target, other in (("val", "test"), ("test", "val")):
        for k in BINARY:
            want, start = f"(SELECT greatest(0, {cfg.min_per_split[target]} - coalesce(sum({k}_bin), 0)) FROM t{n} WHERE split = '{target}')", n
            for donor in ("train", other):
                if n > start:
                    want = f"(SELECT {want} - count(*) FROM m{start})"
                ctes.append(f"m{n} AS MATERIALIZED (SELECT user_id FROM t{n} WHERE split = '{donor}' AND {k}_bin > 0 ORDER BY md5(concat('{SEED}|', user_id)), user_id LIMIT {want})")
                ctes.append(f"t{n + 1} AS MATERIALIZED (SELECT * REPLACE (CASE WHEN user_id IN (SELECT user_id FROM m{n}) THEN '{target}' ELSE split END AS split) FROM t{n})")
                n += 1
    total = ", ".join(f"CAST(sum(r.{k}_bin) AS BIGINT) AS {k}" for k in BINARY)
    return f"WITH {', '.join(ctes)} SELECT split AS _split, count(*) AS n, {total} FROM rows r JOIN t{n} USING (user_id) GROUP BY split"


@query(_rebalance_sql())
def rebalanced_split(spark, d):
    """The whole split stage; rows and positives by split and label."""
    rows = pseudo_silver(spark, d).join(reviews(spark, d), "review_id")
    found, _, _ = splitting.split(rows, splitting.Split(group="user_id"))
    return splitting.coverage(found)


# --- metrics ---------------------------------------------------------------------------------------

Y = "z AS (SELECT CAST(quality AS INTEGER) AS y, CAST((doc_id * 7919) % 100 AS DOUBLE) / 100.0 AS p FROM labels)"


def scored(spark, d) -> DataFrame:
    return table(spark, d, "labels").select(F.col("quality").cast("int").alias("y"), (((F.col("doc_id") * 7919) % 100).cast("double") / 100.0).alias("p"))


@query(f"""WITH {Y}, c AS (SELECT CAST(sum((y = 1 AND p >= 0.5)::INT) AS BIGINT) AS tp, CAST(sum((y = 0 AND p >= 0.5)::INT) AS BIGINT) AS fp, CAST(sum((y = 0 AND p < 0.5)::INT) AS BIGINT) AS tn,
  CAST(sum((y = 1 AND p < 0.5)::INT) AS BIGINT) AS fn, avg(y) AS prevalence FROM z), d AS (SELECT *, tp / (tp + fp) AS precision, tp / (tp + fn) AS recall FROM c)
SELECT tp, fp, tn, fn, round(prevalence, 9) AS prevalence, round(precision, 9) AS precision, round(recall, 9) AS recall, round(2 * precision * recall / (precision + recall), 9) AS f1, round((tp + tn) / (tp + fp + tn + fn), 9) AS accuracy FROM d""")
def confusion_metrics(spark, d):
    return rounded(metrics.confusion(scored(spark, d), 0.5))


@query(f"WITH {Y} SELECT round(avg((p - y) * (p - y)), 9) AS brier FROM z")
def brier(spark, d):
    return rounded(metrics.brier(scored(spark, d)))


_CURVE = """g AS (SELECT p, sum(y) AS dt, sum(1 - y) AS df FROM z GROUP BY p), c AS (SELECT p, dt, df, sum(dt) OVER (ORDER BY p DESC) AS tp, sum(df) OVER (ORDER BY p DESC) AS fp, sum(dt) OVER () AS pos, sum(df) OVER () AS neg FROM g)"""


@query(f"WITH {Y}, {_CURVE} SELECT round(CAST(sum(df * (tp - dt / 2)) / max(pos * neg) AS DOUBLE), 9) AS roc_auc, round(CAST(sum(dt * tp / (tp + fp)) / max(pos) AS DOUBLE), 9) AS pr_auc FROM c")
def ranking_metrics(spark, d):
    return rounded(metrics.ranking(scored(spark, d)))


@query(f"WITH {Y}, {_CURVE} SELECT p, round(fp / neg, 9) AS fpr, round(tp / pos, 9) AS tpr, round(tp / (tp + fp), 9) AS precision FROM c")
def roc_points(spark, d):
    return rounded(metrics.roc_points(scored(spark, d)))


@query(f"WITH {Y} SELECT CAST(floor(p * 10) AS INTEGER) AS bin, count(*) AS n, round(avg(p), 9) AS confidence, round(avg(y), 9) AS rate FROM z WHERE p < 1 GROUP BY 1")
def calibration_bins(spark, d):
    return rounded(metrics.calibration(scored(spark, d)))


@query(f"""WITH {Y}, e AS (SELECT y, min(p) AS lo, max(p) AS hi FROM z GROUP BY y)
SELECT y, CAST(least(19, floor((p - lo) / (hi - lo) * 20)) AS INTEGER) AS bin, count(*) AS n FROM z JOIN e USING (y) GROUP BY 1, 2""")
def score_hist(spark, d):
    return metrics.histogram(scored(spark, d))


@query(f"""WITH {Y}, t AS (SELECT DISTINCT p AS t FROM z UNION SELECT CAST(unnest(range(1, 20)) AS DOUBLE) * 5 / 100),
f AS (SELECT t, sum((y = 1 AND p >= t)::INT) AS tp, sum((p >= t)::INT) AS hits, sum(y) AS pos FROM z, t GROUP BY t)
SELECT t AS threshold, round(2 * tp / (hits + pos), 9) AS f1 FROM f ORDER BY round(2 * tp / (hits + pos), 12) DESC, t LIMIT 1""")
def best_f1_threshold(spark, d):
    """A top-1 report."""
    return rounded(metrics.best_f1(scored(spark, d)))


@query(f"""WITH {Y} SELECT round(avg(abs(p - y)), 9) AS mae, round(sqrt(avg((p - y) * (p - y))), 9) AS rmse,
  round(1 - sum((p - y) * (p - y)) / (sum(y * y) - sum(y) * sum(y) / count(*)), 9) AS r2 FROM z""")
def reg_metrics(spark, d):
    return rounded(metrics.regression(scored(spark, d)))


# --- policy ----------------------------------------------------------------------------------------

_PRED = ", ".join(f"{k} AS pred_{k}" for k in schema.SCORES)
_LOGS = " + ".join([f"ln(CASE WHEN pred_{k} < 1 THEN 1 - pred_{k} WHEN pred_{k} >= 1 THEN 1e-6 END)" for k in BINARY] + [f"ln(CASE WHEN pred_{k} > 0 THEN pred_{k} WHEN pred_{k} <= 0 THEN 1e-6 END)" for k in CONTINUOUS])
_GATES = ", ".join(
    [f"struct_pack(a := pred_{k} >= 0.95, v := pred_{k} >= 0.80, ra := '{k}>=0.95', rv := '{k}>=0.80')" for k in policy.LABELS]
    + [f"struct_pack(a := pred_{k} <= 0.15, v := pred_{k} <= 0.35, ra := '{k}<=0.15', rv := '{k}<=0.35')" for k in ("visit_likelihood", "relevancy_score")]
)
_DECIDE = f"""{R}, {S}, m AS (SELECT r.review_id, {_PRED} FROM reviews r LEFT JOIN silver USING (review_id)),
g AS (SELECT review_id, exp(({_LOGS}) / 6) AS g, list_transform([{_GATES}], lambda x: struct_pack(a := coalesce(x.a, false), v := coalesce(x.v, false), ra := x.ra, rv := x.rv)) AS x FROM m),
h AS (SELECT review_id, g, x, list_position(list_transform(x, lambda y: y.a), true) AS first_a, len(list_filter(x, lambda y: y.v AND NOT y.a)) > 0 AS any_v FROM g),
k AS (SELECT review_id, g, CASE WHEN first_a > 0 THEN 'remove' WHEN any_v THEN 'review' ELSE 'allow' END AS action,
  list_filter(list_transform(x, lambda y, i: CASE WHEN y.a THEN y.ra WHEN y.v AND (coalesce(first_a, 0) = 0 OR i < first_a) THEN y.rv END), lambda z: z IS NOT NULL) AS why FROM h),
decided AS (SELECT review_id, action, CASE action WHEN 'remove' THEN 'not_genuine' WHEN 'review' THEN 'review' ELSE CASE WHEN g >= 0.85 THEN 'genuine' WHEN g >= 0.65 THEN 'review' ELSE 'not_genuine' END END AS final,
  round(g, 9) AS genuine_score, CASE WHEN action = 'allow' THEN list_append(why, CASE WHEN g >= 0.85 THEN 'genuine_score>=0.85' WHEN g >= 0.65 THEN 'genuine_score>=0.65' ELSE 'genuine_score<0.65' END) ELSE why END AS reasons FROM k)"""


def _decided(spark, d) -> DataFrame:
    preds = pseudo_silver(spark, d)
    preds = preds.select("review_id", *[F.col(k).alias(f"pred_{k}") for k in schema.SCORES])
    return policy.decisions(reviews(spark, d), preds)


@query(f"WITH {_DECIDE} SELECT review_id, action, final, genuine_score, array_to_string(reasons, '; ') AS reasons FROM decided")
def policy_decisions(spark, d):
    return rounded(_decided(spark, d).select("review_id", "action", "final", "genuine_score", F.array_join("reasons", "; ").alias("reasons")))


@query(f"WITH {_DECIDE} SELECT final, action, count(*) AS count FROM decided GROUP BY final, action")
def policy_counts(spark, d):
    return policy.counts(_decided(spark, d))


@query(f"WITH {_DECIDE} SELECT review_id, action, final, unnest(reasons) AS reason FROM decided")
def policy_reasons(spark, d):
    return policy.reasons(_decided(spark, d))


_UI = f"""{S}, f AS (SELECT review_id, ads_promo >= 0.5 AS flag_ads, spam_low_quality >= 0.5 AS flag_spam, irrelevant >= 0.5 AS flag_irrelevant, rant_no_visit >= 0.5 AS flag_rant,
  relevancy_score >= 0.5 AND NOT irrelevant >= 0.5 AS relevant, visit_likelihood >= 0.5 AS visit_ok FROM silver),
ui AS (SELECT *, relevant AND NOT (flag_ads OR flag_spam OR flag_rant) AND visit_ok AS genuine, flag_ads OR flag_spam OR flag_rant OR flag_irrelevant AS hold FROM f)"""


def _preds(spark, d) -> DataFrame:
    return pseudo_silver(spark, d).select("review_id", *[F.col(k).alias(f"pred_{k}") for k in schema.SCORES])


@query(f"WITH {_UI} SELECT * FROM ui")
def ui_policy(spark, d):
    return policy.browse_policy(_preds(spark, d)).drop(*[f"pred_{k}" for k in schema.SCORES])


@query(f"WITH {_UI} SELECT review_id FROM ui WHERE hold")
def ui_held(spark, d):
    return policy.held_only(_preds(spark, d)).select("review_id")


@query(f"""WITH {_UI}, f500 AS (SELECT * FROM ui ORDER BY review_id LIMIT 500)
SELECT count(*) AS n, round(CAST(sum(hold::INT) AS DOUBLE) / count(*), 9) AS hold_rate, CAST(sum(relevant::INT) AS BIGINT) AS n_relevant, CAST(sum((NOT relevant)::INT) AS BIGINT) AS n_not_relevant FROM f500""")
def ui_summary(spark, d):
    """The browser's preview, of 500 rows by definition."""
    return rounded(policy.preview_summary(_preds(spark, d), ["review_id"]))


@query(f"WITH {R} SELECT review_id FROM reviews WHERE contains(text, 'heat')")
def substring_search(spark, d):
    return policy.search(reviews(spark, d), "heat").select("review_id")


# --- labelling and models (no SQL counterpart) -----------------------------------------------------


@query(r"""SELECT conv_id, turn, CASE WHEN NOT contains(coalesce(text, ''), chr(39)) THEN regexp_replace(regexp_replace(coalesce(text, ''), '```(json)?', '', 'gi'), '\b(assistant|user)\s*:\s*', '', 'gi') END AS k FROM conversations""")
def json_extract(spark, d):
    """The texts as JSON, found in answers with prose, fences and a trailing comma around it, and read back; an apostrophe in one of them stops the repair, whose quotes are all alike."""
    said = F.to_json(F.struct(F.coalesce(F.col("text"), F.lit("")).alias("k")))
    answer = F.concat(F.lit("Sure: ```json\n"), F.regexp_replace(said, r"\}$", ",}"), F.lit("\n``` done"))
    found = table(spark, d, "conversations").select("conv_id", "turn", labeling.extract_json(answer).alias("json"))
    return found.select("conv_id", "turn", F.get_json_object("json", "$.k").alias("k"))


@query()
def llm_scorer(spark, d):
    return labeling.score(reviews(spark, d))


@query()
def llm_scorer_sql(spark, d):
    """The same scores, by the table function that labeling.register gives SQL."""
    labeling.register(spark)
    r = reviews(spark, d)
    name = f"asked_{uuid.uuid4().hex}"
    r.select("review_id", labeling.messages(r).alias("chat")).createOrReplaceTempView(name)
    return spark.sql(f"SELECT * FROM score_reviews(TABLE({name}))")


@query(f"WITH {_DECIDE} SELECT review_id, action, final, unnest(reasons) AS reason FROM decided")
def policy_reasons_sql(spark, d):
    """policy_reasons, by a table function in SQL text."""
    policy.register(spark)
    name = f"decided_{uuid.uuid4().hex}"
    _decided(spark, d).select("review_id", "action", "final", "reasons").createOrReplaceTempView(name)
    return spark.sql(f"SELECT * FROM decision_reasons(TABLE({name}))")


@query(f"WITH {R} SELECT review_id, concat('Category: ', category, chr(10), 'Rating: ', CAST(rating AS VARCHAR), chr(10), 'Review:', chr(10), trim(text)) AS content FROM reviews")
def chat_messages(spark, d):
    r = reviews(spark, d)
    return r.select("review_id", F.element_at(labeling.messages(r), -1)["content"].alias("content"))


@query()
def train_predict(spark, d):
    """Two heads trained on one split of the documents, scored on all of them."""
    r = reviews(spark, d)
    # Written once, without the texts: training and prediction both read it, and texts are searched once.
    f = materialize(features.features(r, AS_OF, groups=("text_form", "temporal_rating", "language"), carry=("review_id",)))
    truth = table(spark, d, "labels").select(F.col("doc_id").cast("string").alias("review_id"), F.col("quality").cast("double").alias("spam_low_quality"), F.col("toxic").cast("double").alias("relevancy_score"))
    known = f.join(truth, "review_id")
    fold = F.crc32(F.col("review_id").cast("binary")) % 5
    cfg = modeling.Training(exclude=("review_id", "gmap_id", "user_id", "text", "time", "rating", "age_days"), trees=10, leaves=8, rate=0.2)
    heads = modeling.train(known.where(fold > 0), known.where(fold == 0), cfg, ("spam_low_quality", "relevancy_score"))
    return modeling.predict(f, heads)


@query("SELECT count(*) AS rows, count(DISTINCT doc_id) AS ids, count(quality) AS labelled FROM documents LEFT JOIN labels USING (doc_id)")
def feature_summary(spark, d):
    """Counts that the stages log: rows, distinct ids, matches, fully labelled rows."""
    r = reviews(spark, d).join(table(spark, d, "labels").select(F.col("doc_id").cast("string").alias("review_id"), "quality"), "review_id", "left")
    return r.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("review_id").alias("ids"), F.count("quality").alias("labelled"))



# --- over time -------------------------------------------------------------------------------------

_PLACED = "placed AS (SELECT o_orderkey, o_custkey % 150 AS user_id, make_timestamp(1704067200000000 + (o_orderkey * 7919 % 2592000) * 1000000) AS ts FROM orders)"


def _placed(spark, d) -> DataFrame:
    """Orders as acts of the events' users, spread over the events' month."""
    at = F.timestamp_seconds(F.lit(1704067200) + F.col("o_orderkey") * 7919 % 2592000)
    return table(spark, d, "orders").select("o_orderkey", (F.col("o_custkey") % 150).alias("user_id"), at.alias("ts"))


@query(f"""WITH {_PLACED}, e AS (SELECT user_id, ts, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id, ts)
SELECT o_orderkey, coalesce(e.event_id, -1) AS event_id, e.event_type, coalesce(CAST(epoch_us(p.ts) - epoch_us(e.ts) AS BIGINT), -1) AS waited FROM placed p ASOF LEFT JOIN e ON p.user_id = e.user_id AND p.ts >= e.ts""")
def last_event_before(spark, d):
    """Each order with the latest event of its user at or before it, and the microseconds between; -1 without one."""
    events = table(spark, d, "events").withColumn("event_ts", F.col("ts"))
    got = temporal.as_of_join(_placed(spark, d), events, "user_id", "ts", "ts", ["event_id", "event_type", "event_ts"], ties=["event_id"])
    waited = F.unix_micros("ts") - F.unix_micros(F.col("event_ts").cast("timestamp"))
    return got.select("o_orderkey", F.coalesce("event_id", F.lit(-1)).alias("event_id"), "event_type", F.coalesce(waited, F.lit(-1)).alias("waited"))


@query(f"""WITH {_PLACED}, o AS (SELECT *, ts + INTERVAL 1 SECOND * (600 + o_orderkey % 97 * o_orderkey % 50000) AS until FROM placed)
SELECT o.o_orderkey, e.event_id FROM o JOIN events e ON o.user_id = e.user_id AND o.ts < e.ts + INTERVAL 1 SECOND * (1 + CAST(floor(value) AS BIGINT) * 20) AND e.ts < o.until""")
def events_during_orders(spark, d):
    """Events and orders of one user whose spans overlap: an order is open for up to half a day, an event lasts as its value says."""
    orders = _placed(spark, d).withColumn("until", F.timestamp_micros(F.unix_micros("ts") + (600 + F.col("o_orderkey") % 97 * F.col("o_orderkey") % 50000) * 1_000_000))
    start = F.col("ts").cast("timestamp")
    events = table(spark, d, "events").select("event_id", "user_id", start.alias("ts"), F.timestamp_micros(F.unix_micros(start) + (1 + F.floor("value") * 20) * 1_000_000).alias("until"))
    pairs = temporal.overlapping(orders, events, ("ts", "until"), ("ts", "until"), "user_id")
    return pairs.select(F.col("l.o_orderkey").alias("o_orderkey"), F.col("r.event_id").alias("event_id"))


@query("""SELECT event_id, CAST(count(*) OVER w AS BIGINT) AS n_day, CAST(sum((event_type = 'error')::INT) OVER w AS BIGINT) AS errors_day, round(max(value) OVER w, 9) AS top_day
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW)""")
def bursts_by_user(spark, d):
    """Each event with the number, errors and largest value of its user's events within the day before it."""
    made = {"n_day": F.count(F.lit(1)), "errors_day": F.sum((F.col("event_type") == "error").cast("long")), "top_day": F.max("value")}
    return rounded(temporal.rolling(table(spark, d, "events"), "user_id", "ts", 86400 * temporal.MICROS, made).select("event_id", *made))


_SESSIONS = """WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 2 HOUR THEN 0 ELSE 1 END AS new FROM events),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, CAST(epoch_us(min(ts)) AS BIGINT) AS start_us, CAST(epoch_us(max(ts)) AS BIGINT) AS end_us, count(*) AS n{more} FROM s GROUP BY user_id, k"""


@query(_SESSIONS.format(more=", CAST(count(DISTINCT event_type) AS BIGINT) AS kinds"))
def sessions_by_user(spark, d):
    """Runs of a user's events with no more than two hours between neighbours."""
    s = temporal.sessions(table(spark, d, "events"), "user_id", "ts", "2 hours", {"kinds": F.size(F.collect_set("event_type")).cast("long")})
    return s.select("user_id", F.unix_micros("start").alias("start_us"), F.unix_micros("end").alias("end_us"), "n", "kinds")


@query(_SESSIONS.format(more=""))
def streamed_sessions(spark, d):
    """The same sessions from a stream over the events, with state and timers; a marker after the last event closes all of them."""
    events = table(spark, d, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    last = events.agg(F.max("ts").alias("ts")).first()["ts"]
    live = spark.readStream.schema(table(spark, d, "events").schema).parquet(f"{d}/events.parquet*").select(*[F.col(c).cast(t).alias(c) for c, t in events.dtypes])
    if last is not None:
        marker = materialize(spark.range(1).select(F.lit(None).cast("bigint").alias("user_id"), (F.lit(last) + F.expr("INTERVAL 100 DAYS")).alias("ts")))
        live = live.unionByName(spark.readStream.schema(marker.schema).parquet(marker.inputFiles()[0].rsplit("/", 1)[0]))
    folder = new_path(spark)
    scoring.write(sessions.sessions(live, "user_id", "ts", 7200, "60 days"), f"{folder}/rows", f"{folder}/checkpoint").awaitTermination()
    done = spark.read.schema("user_id long, start timestamp, end timestamp, n long").parquet(f"{folder}/rows")
    return done.select("user_id", F.unix_micros("start").alias("start_us"), F.unix_micros("end").alias("end_us"), "n")


_PAGES = """pages_as_reviews AS (SELECT CAST(page_id AS VARCHAR) AS review_id, html AS text FROM pages)"""


@query(rf"""WITH {_PAGES} SELECT review_id, {", ".join(f"regexp_matches(text, '{p}') AS {k}" for k, p in _SHAPES.items())},
  {", ".join(f"CAST({_listed(k)} AS BIGINT) AS {k}" for k in patterns.LEXICONS)} FROM pages_as_reviews""")
def signals_of_pages(spark, d):
    """The twelve flags, and whether each lexicon has a hit, over the markup of pages, which holds links, numbers and symbols of all kinds."""
    t = table(spark, d, "pages").select(F.col("page_id").cast("string").alias("review_id"), F.col("html").alias("text"))
    made = patterns.promotion(F.col("text")) | patterns.nonvisit(F.col("text")) | patterns.relevancy(F.col("text"), [])
    hit = {k: F.least(made[f"{k}_hits"], F.lit(1)).cast("long") for k in patterns.LEXICONS}
    return t.select("review_id", *[made[k].alias(k) for k in _SHAPES], *[v.alias(k) for k, v in hit.items()])


# --- strata and sketches ---------------------------------------------------------------------------

_BINNED = "binned AS (SELECT *, CASE WHEN time < 883612800 THEN '<=1997' WHEN time < 946684800 THEN '1998-1999' ELSE '2000+' END AS period FROM pool)"


@query(f"""WITH {P}, {_BINNED} SELECT coalesce(rating, -1) AS rating, length_bucket, period, CAST(grouping(rating, length_bucket, period) AS INTEGER) AS level, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT gmap_id) AS BIGINT) AS members
FROM binned GROUP BY CUBE (rating, length_bucket, period)""")
def strata_cube(spark, d):
    """Rows and places of every stratum of the pool by rating, length and period, and of every total over some of these."""
    t = F.col("time")
    binned = pool(spark, d).withColumn("period", F.when(t < 883612800, "<=1997").when(t < 946684800, "1998-1999").otherwise("2000+"))
    return strata.cube(binned, ["rating", "length_bucket", "period"], "gmap_id").withColumn("rating", F.coalesce("rating", F.lit(-1)))


@query(f"""WITH {_DECIDE}, placed AS (SELECT d.*, gmap_id FROM decided d JOIN reviews USING (review_id))
SELECT final, action, CAST(grouping(final, action) AS INTEGER) AS level, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT gmap_id) AS BIGINT) AS members FROM placed GROUP BY ROLLUP (final, action)""")
def decisions_rollup(spark, d):
    """Decisions by outcome and action, with totals by outcome and over all, and the places that they concern."""
    return strata.cube(_decided(spark, d), ["final", "action"], "gmap_id", rollup=True)


@query("""SELECT event_type, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT user_id) AS BIGINT) AS annotators, true AS distinct_near, true AS cuts_near FROM events GROUP BY event_type""")
def sketched_cuts(spark, d):
    """Of each kind of event: annotators and cuts of the values, exactly and from daily sketches; near: whether those of the sketches are within their stated error."""
    e = table(spark, d, "events")
    days = materialize(sketches.daily(e, F.to_date("ts"), ["event_type"], F.col("value"), F.col("user_id")))
    all_days = sketches.merged(days, ["event_type"])
    shares = (0.05, 0.33, 0.5, 0.66, 0.95)
    guess = all_days.select("event_type", sketches.distinct(F.col("distinct")).alias("about"), *[sketches.quantile(F.col("quantiles"), q).alias(f"q{i}") for i, q in enumerate(shares)])
    exact = e.join(F.broadcast(guess), "event_type")  # one row a kind
    below = [F.avg((F.col("value") <= F.col(f"q{i}")).cast("double")) for i in range(len(shares))]
    tie = [F.avg((F.col("value") == F.col(f"q{i}")).cast("double")) for i in range(len(shares))]
    near = [(b - t - sketches.QUANTILE_ERROR <= q) & (b + sketches.QUANTILE_ERROR >= q) for b, t, q in zip(below, tie, shares, strict=True)]
    n = F.countDistinct("user_id")
    return exact.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), n.alias("annotators"), (F.abs(F.max("about") - n) <= F.greatest(F.lit(1.0), sketches.DISTINCT_ERROR * n)).alias("distinct_near"), (near[0] & near[1] & near[2] & near[3] & near[4]).alias("cuts_near"))
