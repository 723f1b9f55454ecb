"""Seeded sampling: caps, popularity tiers, proportional strata, floors, and the two packs built of them.

Order is by md5(seed | id), ties by id: the same in any partitioning and any
engine. Selections are tables of ids and strata only; the rows are joined once
at the end.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions import fields
from plumbline.functions.schema import require
from plumbline.operators.joins import keep_first
from plumbline.operators.ranges import placed
from plumbline.sources.scratch import materialize


def order_key(seed: int, id_key: str = "review_id") -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(id_key).cast("string")))


def random_sample(df: DataFrame, n: int, seed: int, id_key: str = "review_id") -> DataFrame:
    """n rows at most."""
    return df.orderBy(order_key(seed, id_key), id_key).limit(n)


def cap_per_key(df: DataFrame, key: str, most: int, seed: int, id_key: str = "review_id", keep_null_keys: bool = True) -> DataFrame:
    """At most `most` rows a key. Rows without a key stay, or go as in the reference."""
    w = Window.partitionBy(key).orderBy(order_key(seed, id_key), id_key)
    ranked = df.where(F.col(key).isNotNull()).withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= most).drop("__n")
    return ranked.unionByName(df.where(F.col(key).isNull())) if keep_null_keys else ranked


def popularity(df: DataFrame, key: str = "gmap_id") -> DataFrame:
    """df with pop (tail, mid, head): tertiles of rows by key, exact with linear interpolation."""
    sizes = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__size"))
    cut = sizes.agg(F.percentile("__size", F.array(F.lit(0.33), F.lit(0.66))).alias("q")).first()["q"] or [0.0, 0.0]
    tier = F.when(F.col("__size") <= cut[0], "tail").when(F.col("__size") <= cut[1], "mid").otherwise("head")
    return df.join(sizes.select(key, tier.alias("pop")), key, "left")


def quotas(strata: DataFrame, keys: list[str], n: int) -> DataFrame:
    """keys, count and quota: half-even shares of n, with the rest given to, or taken from, the largest strata.

    strata: keys and count. One row a stratum; the two windows run over it.
    """
    everything = Window.partitionBy()
    q = strata.withColumn("__total", F.sum("count").over(everything)).withColumn("quota", F.bround(F.col("count") * (F.lit(n) / F.col("__total"))).cast("long"))
    q = q.withColumn("__delta", F.lit(n) - F.sum("quota").over(everything))
    rank = F.row_number().over(Window.orderBy(F.desc("count"), *[F.col(k).asc_nulls_first() for k in keys]))
    return q.select(*keys, "count", (F.col("quota") + F.when(rank <= F.abs("__delta"), F.signum("__delta")).otherwise(0)).cast("long").alias("quota"))


def proportional_sample(pool: DataFrame, keys: list[str], n: int, seed: int, id_key: str = "review_id", top_up: bool = True) -> DataFrame:
    """n rows of the pool by proportional strata; all of it if it has no more, as quotas then cover each stratum. top_up fills what a stratum lacked from the rest."""
    n = max(0, n)
    if not n:
        return pool.limit(0)
    order = order_key(seed, id_key)
    strata = quotas(pool.groupBy(*keys).count(), keys, n)
    lacking = strata.agg(F.coalesce(F.sum(F.greatest(F.lit(0), F.col("quota") - F.col("count"))), F.lit(0)).alias("n")).first()["n"]
    q = strata.select(*[F.col(k).alias(f"__{k}") for k in keys], "quota")
    joined = pool.join(q, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]).select(*pool.columns, "quota")
    # Only ranges that begin below the quota are ranked; a quota is the same in all rows of a stratum.
    ranked = placed(joined, [*keys, "quota"], order, [id_key], None if top_up and lacking else F.col("__start") < F.col("quota"))
    if not top_up or not lacking:
        return ranked.where("__n <= quota").select(*pool.columns)
    # Rows in quota first, then the others by the order key.
    return ranked.orderBy(F.desc(F.col("__n") <= F.col("quota")), order, id_key).limit(n).select(*pool.columns)


@dataclass(frozen=True)
class Sampler:
    target: int = 100_000
    seed: int = 16
    max_per_place: int = 50
    max_per_user: int = 10
    floors: dict = field(default_factory=lambda: {"with_pics": 0.0, "with_resp": 0.0, "recent": 0.30})
    popularity: dict = field(default_factory=lambda: {"tail": 0.25, "mid": 0.50, "head": 0.25})
    region: str | None = "AK"


def half_even(x: float) -> int:
    return int(round(x))


STRATA = ["rating", "length_bucket", "year_bin"]


def reserve(pool: DataFrame, chosen: DataFrame | None, mask: Column, need: int, keys: list[str], seed: int, id_key: str = "review_id") -> DataFrame | None:
    """chosen with up to `need` more ids of the pool's unchosen rows under the mask."""
    if need <= 0:
        return chosen
    left = pool.where(mask) if chosen is None else pool.where(mask).join(chosen, id_key, "left_anti")
    more = materialize(proportional_sample(left, keys, need, seed, id_key).select(id_key))
    return more if chosen is None else chosen.unionByName(more)


def prepared_pool(df: DataFrame, cfg: Sampler, as_of: float) -> DataFrame:
    """Rows that may be sampled, with their strata and flags, after both caps."""
    require(df, ["rating", "text", "time", "gmap_id"])
    text = F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), r"^(?U)\s+|(?U)\s+$", "")
    df = df.where((text != "") & F.col("rating").isin(1, 2, 3, 4, 5))
    if cfg.region and "region" in df.columns:
        df = df.where(F.upper("region") == cfg.region)
    n = F.size(F.filter(F.split(F.col("text"), r"(?U)\s+"), lambda t: t != ""))
    present = lambda c: fields.filled(F.to_json(c) if dict(df.dtypes)[c][:5] in ("array", "struc") else F.col(c).cast("string")) if c in df.columns else F.lit(False)
    bucket = F.when(n <= 8, "short").when(F.length("text") >= 200, "long").otherwise("medium")
    pool = df.select("review_id", "gmap_id", "user_id", "rating", bucket.alias("length_bucket"), fields.year_bin(F.col("time")).alias("year_bin"), fields.is_recent(F.col("time"), as_of).alias("recent"), present("pics").alias("with_pics"), present("resp").alias("with_resp"))
    return cap_per_key(cap_per_key(pool, "gmap_id", cfg.max_per_place, cfg.seed), "user_id", cfg.max_per_user, cfg.seed)


def sample_ids(pool: DataFrame, cfg: Sampler) -> DataFrame:
    """review_id of the sample: floors, then popularity targets, then a proportional fill.

    Each step needs the one before, so the pool (keys and strata only) and the
    ids chosen so far are written as they grow; plans stay short.
    """
    pool = materialize(popularity(pool))
    if pool.count() <= cfg.target:
        return pool.select("review_id")
    chosen = None
    for flag in ("with_pics", "with_resp", "recent"):
        chosen = reserve(pool, chosen, F.col(flag), half_even(cfg.floors.get(flag, 0.0) * cfg.target), STRATA, cfg.seed)
    for tier, share in cfg.popularity.items():
        have = 0 if chosen is None else pool.where(F.col("pop") == tier).join(chosen, "review_id", "left_semi").count()
        chosen = reserve(pool, chosen, F.col("pop") == tier, half_even(share * cfg.target) - have, STRATA, cfg.seed)
    have = 0 if chosen is None else chosen.count()
    chosen = reserve(pool, chosen, F.lit(True), cfg.target - have, STRATA, cfg.seed)
    return random_sample(chosen, cfg.target, cfg.seed)


def sample_reviews(df: DataFrame, cfg: Sampler, as_of: float) -> DataFrame:
    """The sampled rows, with their own columns."""
    return df.join(sample_ids(prepared_pool(df, cfg, as_of), cfg), "review_id", "left_semi")


#: The buckets of the annotation pack, their flags, scores and sizes.
BUCKETS = {"ads": ("rule_ads_strong", "rule_ads_score", 150), "spam": ("rule_spam_strong", "rule_spam_score", 150), "irrelevant": ("rule_irrelevant_strong", "rule_irrelevant_score", 100), "rant_no_visit": ("rule_rant_strong", "rule_rant_score", 50), "none": ("rule_none", None, 50)}
GRID = ["rating", "length_bucket"]


def sample_bucket(pool: DataFrame, flag: str, score: str | None, n: int, recent: Column, recent_share: float, seed: int, fallback: bool = True) -> DataFrame:
    """Ids for one bucket: flagged rows, recent ones first up to their share, then others, then any, then the best scores."""
    strong = pool.where(F.col(flag) == 1)
    if strong.isEmpty():
        return pool.orderBy(F.desc(score), "review_id").limit(n).select("review_id") if fallback and score else pool.limit(0).select("review_id")
    ids = lambda df, k: proportional_sample(df, GRID, k, seed, top_up=False).select("review_id")
    first = materialize(ids(strong.where(recent), min(n, half_even(recent_share * n))))
    second = first.union(materialize(ids(strong.where(~recent), n - first.count())))
    third = second.union(materialize(random_sample(strong.join(second, "review_id", "left_anti"), n - second.count(), seed).select("review_id")))
    missing = n - third.count()
    if missing > 0 and fallback and score:
        return third.union(pool.join(third, "review_id", "left_anti").orderBy(F.desc(score), "review_id").limit(missing).select("review_id"))
    return third


def gold_pack(rules: DataFrame, as_of: float, sizes: dict | None = None, seed: int = 16, recent_share: float = 0.30, export=("review_id", "gmap_id", "user_id", "rating", "time", "text", "category"), ratings=(1, 2, 3, 4, 5), lengths=("short", "medium", "long"), fallback: bool = True, missing_is_recent: bool = False) -> DataFrame:
    """Rows for annotators: one sample a bucket, united by id, projected to the export fields."""
    require(rules, ["review_id", "rating", "length_bucket"])
    if {"gmap_id", "text"} <= set(rules.columns):
        rules = keep_first(rules, ["gmap_id", "text"], [F.col("review_id")])
    pool = rules.where(F.col("rating").isin(*ratings) & F.col("length_bucket").isin(*lengths))
    used = {"review_id", "age_days", "time", *GRID, *export, *[c for f, s, _ in BUCKETS.values() for c in (f, s) if c]}
    pool = materialize(pool.select(*[c for c in pool.columns if c in used]))
    recent = F.coalesce(F.col("age_days").between(-1 if missing_is_recent else 0, fields.RECENT_DAYS), F.lit(False)) if "age_days" in pool.columns else fields.is_recent(F.col("time"), as_of) if "time" in pool.columns else F.lit(False)
    ids = None
    for name, (flag, score, n) in BUCKETS.items():
        require(pool, [flag])
        some = sample_bucket(pool, flag, score, (sizes or {}).get(name, n), recent, recent_share, seed, fallback)
        ids = some if ids is None else ids.union(some)
    return pool.join(ids.distinct(), "review_id", "left_semi").select(*[c for c in export if c in pool.columns])
