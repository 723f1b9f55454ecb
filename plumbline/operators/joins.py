"""The joins of the stages: metadata, labels with their base, prediction blocks and rule priors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.fields import clip01, with_review_id
from plumbline.functions.schema import require


def keep_first(df: DataFrame, keys: list[str], order: list | None = None) -> DataFrame:
    """The first row of each key in the given order (default: all other columns, so that it doesn't depend on files)."""
    order = order or [F.col(f"`{c}`") for c, t in df.dtypes if c not in keys and not t.startswith("map")]
    w = Window.partitionBy(*keys).orderBy(*(order or [F.lit(1)]))
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def merge_metadata(reviews: DataFrame, meta: DataFrame | None, on: str = "gmap_id", keep: list[str] | None = None) -> DataFrame:
    """Reviews with the columns of one metadata row a place that they lack, and with ids.

    Spark broadcasts the metadata if its size allows, else both sides are
    shuffled on the place.
    """
    if meta is not None and on in meta.columns:
        new = [c for c in (keep or meta.columns) if c in meta.columns and c not in reviews.columns]
        reviews = reviews.join(keep_first(meta, [on]).select(on, *new), on, "left")
    return with_review_id(reviews)


def merge_with_base(base: DataFrame, silver: DataFrame, id_key: str = "review_id", how: str = "left") -> DataFrame:
    """Labels joined to their base rows: id, label columns, then the base's new columns; one row an id on either side."""
    require(base, [id_key])
    require(silver, [id_key])
    new = [c for c in base.columns if c not in silver.columns]
    return keep_first(silver, [id_key]).join(keep_first(base, [id_key]).select(id_key, *new), id_key, how)


def merge_predictions(blocks: list[DataFrame], id_key: str = "review_id") -> DataFrame:
    """Prediction blocks by target, joined fully on the id."""
    return reduce(lambda a, b: a.join(b, id_key, "full_outer"), blocks)


def predictions_for(base: DataFrame, preds: DataFrame, id_key: str = "review_id") -> DataFrame:
    return base.select(id_key).distinct().join(preds, id_key, "left")


#: The prior of a rule's flag for each label.
PRIORS = {"ads_promo": 0.90, "spam_low_quality": 0.85, "irrelevant": 0.80, "rant_no_visit": 0.80}
FLAG = {"ads_promo": "rule_ads_strong", "spam_low_quality": "rule_spam_strong", "irrelevant": "rule_irrelevant_strong", "rant_no_visit": "rule_rant_strong"}


def fuse_with_rules(scores: DataFrame, rules: DataFrame, mode: str = "prior_max", alpha: float = 0.7, priors: dict = PRIORS, id_key: str = "review_id") -> DataFrame:
    """Scores raised to the rule's prior (prior_max) or blended with it (blend) where its strong flag is set."""
    if mode not in ("prior_max", "blend"):
        raise ValueError(f"unknown fusion mode: {mode}")
    known = {k: p for k, p in priors.items() if k in scores.columns and FLAG[k] in rules.columns}
    if id_key not in rules.columns or not known:
        return scores
    flags = rules.groupBy(id_key).agg(*[F.max(FLAG[k]).alias(f"__{FLAG[k]}") for k in known])
    df = scores.join(flags, id_key, "left")
    for k, prior in known.items():
        p = F.coalesce(clip01(F.col(k)), F.lit(0.0))
        new = F.greatest(p, F.lit(prior)) if mode == "prior_max" else alpha * F.lit(prior) + (1 - alpha) * p
        df = df.withColumn(k, F.when(F.col(f"__{FLAG[k]}") == 1, new).otherwise(p))
    return df.select(*scores.columns)
