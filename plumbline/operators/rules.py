"""Transparent rule scores and strong flags."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.patterns import FLAGS

#: The score at which a rule is strong, and the cutoffs inside the spam score.
STRONG = {"ads": 0.4, "spam": 0.6, "irrelevant": 0.5, "rant": 0.5}
CUTOFFS = {"emoji_count": 3, "punct_runs": 1, "elong_runs": 1, "text_dup_count_place": 2}


def _flag(c: Column) -> Column:
    return F.coalesce(c.cast("int"), F.lit(0))


def scores(df: DataFrame, cutoffs: dict = CUTOFFS) -> dict[str, Column]:
    """rule_ads_score, rule_spam_score, rule_irrelevant_score, rule_rant_score; a missing column counts as no signal."""
    has = lambda c: c in df.columns
    value = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if has(c) else F.lit(0.0)
    promo = [_flag(F.col(c)) for c in FLAGS if has(c)]
    ads = [*promo, *[F.least(value(c), F.lit(1.0)) for c in ("promo_hits", "contact_hits")]]
    spam = [_flag(F.col("length_bucket") == "short") if has("length_bucket") else F.lit(0), _flag(F.col("has_short_url")) if has("has_short_url") else F.lit(0)]
    spam += [(value(c) >= least).cast("int") for c, least in cutoffs.items()]
    irrelevant = value("offtopic_hits") > 0
    for c in df.columns:
        if c.startswith("mentions_"):
            irrelevant &= _flag(F.col(c)) == 0
    return {
        "rule_ads_score": (reduce(add, ads) / float(len(ads))).cast("double"),
        "rule_spam_score": (reduce(add, spam) / float(len(spam))).cast("double"),
        "rule_irrelevant_score": irrelevant.cast("double"),
        "rule_rant_score": (value("nonvisit_hits") > 0).cast("double"),
    }


def rules(df: DataFrame, strong: dict = STRONG, cutoffs: dict = CUTOFFS) -> DataFrame:
    """df with the four scores, the four strong flags and rule_none."""
    scored = df.withColumns(scores(df, cutoffs))
    flags = {f"rule_{k}_strong": (F.col(f"rule_{k}_score") >= v).cast("int") for k, v in strong.items()}
    return scored.withColumns(flags).withColumn("rule_none", (F.greatest(*[F.col(c) for c in flags]) == 0).cast("int"))
