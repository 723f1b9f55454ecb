"""The feature stage: eight groups of columns, each of which can be switched off."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions import fields, patterns, text
from plumbline.functions.schema import require, safe_text
from plumbline.sources.scratch import materialize

CARRY = ("review_id", "gmap_id", "user_id", "time", "rating", "text", "pics", "resp")
GROUPS = ("text_form", "ad_promo", "nonvisit", "relevancy", "media_resp", "temporal_rating", "aggregates", "language")


HASHES = ("__h1", "__h2")
#: What rows are grouped by: reviews of a place, copies of a text at a place, reviews of a user.
KINDS = {"place": ("gmap_id",), "copies": ("gmap_id", *HASHES), "user": ("user_id",)}


def hashes(text: Column) -> dict[str, Column]:
    """Two 64-bit hashes of a text; null for a null one, so that they can be joined on by themselves."""
    return {"__h1": F.when(text.isNotNull(), F.xxhash64(text)), "__h2": F.when(text.isNotNull(), F.xxhash64(F.lit("second"), text))}


def totals_of(df: DataFrame, kind: str) -> DataFrame:
    """The aggregates of a kind (place, user or copies): its keys and n; for places and users the mean and std of the rating, where there is one."""
    key = KINDS[kind]
    rows = df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key]))
    made = [F.avg("rating").alias("mean"), F.stddev_samp("rating").alias("std")] if kind != "copies" and "rating" in df.columns else []
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), *made)


def group_windows(df: DataFrame, totals=totals_of) -> tuple[DataFrame, dict[str, Column]]:
    """df joined with its groups' aggregates, and the columns made of them: counts, means and deviations by place and by user.

    Aggregates are made by groupBy, with partial sums before the shuffle, and
    joined back, so a place or user with a large share of all rows is split over
    tasks. Texts are compared by two 64-bit hashes. Rows without a key get nulls
    (duplicates: 1). totals: (df, kind) -> the aggregates, by default those of
    df itself.
    """
    out: dict[str, Column] = {}
    rated = "rating" in df.columns
    if "text" in df.columns and "__h1" not in df.columns:
        df = df.withColumns(hashes(F.col("text")))
    for kind, key in KINDS.items():
        if not all(c in df.columns for c in key):
            continue
        groups = totals(df, kind).select(*[F.col(c).alias(f"__{kind}{i}") for i, c in enumerate(key)], F.col("n").alias(f"__{kind}_n"), *[F.col(c).alias(f"__{kind}_{c}") for c in ("mean", "std") if rated and kind != "copies"])
        on = reduce(lambda a, b: a & b, [df[c] == groups[f"__{kind}{i}"] for i, c in enumerate(key)])
        df = df.join(groups, on, "left").drop(*[f"__{kind}{i}" for i in range(len(key))])
        if kind == "copies":
            out["text_dup_count_place"] = F.coalesce(F.col("__copies_n"), F.lit(1))
            continue
        out[f"{kind}_review_count"] = F.col(f"__{kind}_n")
        if rated:
            out[f"{kind}_rating_mean"] = F.col(f"__{kind}_mean")
            out[f"{kind}_rating_std"] = F.coalesce(F.col(f"__{kind}_std"), F.lit(0.0))
            out[f"rating_dev_from_{kind}_mean"] = F.col("rating") - F.col(f"__{kind}_mean")
    return df, out


def features(df: DataFrame, as_of: float, groups=GROUPS, carry=CARRY, lexicons: dict = patterns.LEXICONS, short_tokens_max: int = 8, long_chars_min: int = 200, nonlatin_flag: float = 0.25) -> DataFrame:
    """The carried columns there are, and the groups' columns.

    Whatever is made of texts is made first. Where the aggregates are wanted and
    the text is not carried, these numbers and the texts' hashes are written
    once, and the joins of the aggregates read that table: texts are read once
    and never shuffled.
    """
    require(df, ["text"])
    kept = [c for c in carry if c in df.columns]
    made: dict[str, Column] = {}
    t = safe_text(F.col("text"))
    source = df
    if "text_form" in groups:
        source = source.withColumn("__tokens", text.token_stats(t))
        made |= text.text_form(t, F.col("__tokens"), short_tokens_max, long_chars_min)
    if "ad_promo" in groups:
        made |= patterns.promotion(t, lexicons)
    if "nonvisit" in groups:
        made |= patterns.nonvisit(t, lexicons)
    if "relevancy" in groups:
        made |= patterns.relevancy(t, df.columns, lexicons)
    if "media_resp" in groups:
        made |= fields.media(df)
    if "temporal_rating" in groups:
        made |= fields.temporal(df, as_of)
    names = list(made)
    if "language" in groups:
        made |= text.language(t, nonlatin_flag)
    if "aggregates" not in groups:
        return source.select(*kept, *[v.alias(k) for k, v in made.items()])
    keys = [c for c in ("gmap_id", "user_id", "rating") if c in df.columns and c not in kept]
    narrow = source.select(*kept, *keys, *[v.alias(k) for k, v in (made | hashes(F.col("text"))).items()])
    joined, found = group_windows(narrow if "text" in kept else materialize(narrow))
    return joined.select(*kept, *names, *[v.alias(k) for k, v in found.items()], *[k for k in made if k not in names])
