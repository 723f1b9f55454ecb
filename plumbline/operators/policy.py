"""Decisions from predicted scores: gates, the genuine score, reasons and counts. All expressions; no Python per row."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.schema import BINARY, CONTINUOUS, nan_to_null

LABELS = ("spam_low_quality", "ads_promo", "irrelevant", "rant_no_visit")


@dataclass(frozen=True)
class Policy:
    #: label -> (auto, review), in gate order.
    high: dict = field(default_factory=lambda: {k: (0.95, 0.80) for k in LABELS})
    #: score -> (auto_max, review_max), in gate order.
    low: dict = field(default_factory=lambda: {"visit_likelihood": (0.15, 0.35), "relevancy_score": (0.15, 0.35)})
    method: str = "geom_mean"
    genuine_min: float = 0.85
    review_min: float = 0.65


def genuine_score(method: str = "geom_mean", prefix: str = "pred_") -> Column:
    """Mean of how good each score is (the four bad ones inverted), null if any is missing."""
    unit = lambda c: F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))
    parts = [1.0 - F.col(f"{prefix}{k}") for k in BINARY] + [F.col(f"{prefix}{k}") for k in CONTINUOUS]
    known = reduce(lambda a, b: a & b, [p.isNotNull() for p in parts])
    if method == "min":
        return F.when(known, F.least(*map(unit, parts)))
    logs = [F.ln(F.when(unit(p) <= 0, F.lit(1e-6)).otherwise(unit(p))) for p in parts]
    return F.when(known, F.exp(reduce(lambda a, b: a + b, logs) / float(len(logs))))


def decide(preds: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """preds with action, final, genuine_score and reasons.

    A missing prediction passes every gate, and then fails the genuine score.
    """
    df = nan_to_null(preds).withColumn("genuine_score", genuine_score(policy.method))
    no = F.lit(False)
    gates = []
    for name, (auto, review) in policy.high.items():
        p = F.col(f"pred_{name}")
        gates.append((F.coalesce(p >= auto, no), F.coalesce(p >= review, no), f"{name}>={auto:.2f}", f"{name}>={review:.2f}"))
    for name, (auto, review) in policy.low.items():
        p = F.col(f"pred_{name}")
        gates.append((F.coalesce(p <= auto, no), F.coalesce(p <= review, no), f"{name}<={auto:.2f}", f"{name}<={review:.2f}"))
    reasons, removed, reviewed = [], no, no
    for auto, review, why_auto, why_review in gates:
        reasons.append(F.when(auto, F.lit(why_auto)).when(review & ~removed, F.lit(why_review)))
        removed, reviewed = removed | auto, reviewed | (review & ~auto)
    action = F.when(removed, "remove").when(reviewed, "review").otherwise("allow")
    g = F.col("genuine_score")
    allowed = F.when(g >= policy.genuine_min, "genuine").when(g >= policy.review_min, "review").otherwise("not_genuine")
    last = F.when(g >= policy.genuine_min, f"genuine_score>={policy.genuine_min:.2f}").when(g >= policy.review_min, f"genuine_score>={policy.review_min:.2f}").otherwise(f"genuine_score<{policy.review_min:.2f}")
    return df.withColumns({
        "action": action,
        "final": F.when(removed, "not_genuine").when(reviewed, "review").otherwise(allowed),
        "reasons": F.array_compact(F.array(*reasons, F.when(~removed & ~reviewed, last))),
    })


def decisions(base: DataFrame, preds: DataFrame, id_key: str = "review_id", carry=("gmap_id", "user_id", "time", "rating", "text"), policy: Policy = Policy()) -> DataFrame:
    """Every base row with its decision, also those without predictions."""
    cols = [f"pred_{k}" for k in (*BINARY, *CONTINUOUS)]
    joined = base.select(id_key, *[c for c in carry if c in base.columns]).join(preds.select(id_key, *cols), id_key, "left")
    kept = [c for c in carry if c in base.columns]
    return decide(joined, policy).select(id_key, "action", "final", "genuine_score", "reasons", *kept, *cols)


def counts(decided: DataFrame) -> DataFrame:
    return decided.groupBy("final", "action").agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "final", "action")


def reasons(decided: DataFrame, id_key: str = "review_id") -> DataFrame:
    """A row for each reason; a decision without any has one null row."""
    return decided.select(id_key, "action", "final", F.explode_outer("reasons").alias("reason"))


class _Reasons:
    """A row for each reason of a decision (review_id, action, final, reasons); one null row of a decision without any."""

    def eval(self, row):
        for reason in row["reasons"] or [None]:
            yield row["review_id"], row["action"], row["final"], reason


def register(spark) -> None:
    """SQL names: the table function decision_reasons(TABLE(t))."""
    spark.udtf.register("decision_reasons", F.udtf(_Reasons, returnType="review_id string, action string, final string, reason string"))


#: The fallback threshold of a head, and the bounds a binary head's threshold is held to.
DEFAULT_THRESHOLD, THRESHOLD_EDGE = 0.5, 1e-4


def head_thresholds(known: dict | None = None) -> dict:
    """A threshold for every head; those of binary heads are kept off 0 and 1."""
    out = {k: float((known or {}).get(k, DEFAULT_THRESHOLD)) for k in (*BINARY, *CONTINUOUS)}
    return out | {k: min(1 - THRESHOLD_EDGE, max(THRESHOLD_EDGE, out[k])) for k in BINARY}


def browse_policy(preds: DataFrame, thresholds: dict | None = None, prefix: str = "pred_") -> DataFrame:
    """The browser's rules: a flag for each head, relevant, visit_ok, genuine and hold (any flag)."""
    t = head_thresholds(thresholds)
    at = lambda k: F.coalesce(F.col(f"{prefix}{k}") >= t[k], F.lit(False))
    flags = {"flag_ads": at("ads_promo"), "flag_spam": at("spam_low_quality"), "flag_irrelevant": at("irrelevant"), "flag_rant": at("rant_no_visit")}
    df = nan_to_null(preds).withColumns(flags | {"relevant": at("relevancy_score") & ~at("irrelevant"), "visit_ok": at("visit_likelihood")})
    bad = F.col("flag_ads") | F.col("flag_spam") | F.col("flag_rant")
    return df.withColumns({"genuine": F.col("relevant") & ~bad & F.col("visit_ok"), "hold": bad | F.col("flag_irrelevant")})


def search(df: DataFrame, needle: str, column: str = "text") -> DataFrame:
    """Rows whose text has the exact substring; all rows if none has."""
    hits = df.where(F.col(column).contains(needle))
    return df if not needle or hits.isEmpty() else hits


def held_only(scored: DataFrame, thresholds: dict | None = None) -> DataFrame:
    """Rows the browser holds; a row without scores is dropped."""
    known = reduce(lambda a, b: a & b, [F.col(f"pred_{k}").isNotNull() for k in (*BINARY, *CONTINUOUS)])
    return browse_policy(scored.where(known), thresholds).where("hold")


def preview_summary(scored: DataFrame, order: list[str], most: int = 500, thresholds: dict | None = None) -> DataFrame:
    """n, hold_rate (null without rows), n_relevant, n_not_relevant over the first `most` rows in the given order."""
    first = browse_policy(scored.orderBy(*order).limit(most), thresholds)
    yes = lambda c: F.coalesce(F.sum(F.col(c).cast("long")), F.lit(0))
    return first.agg(F.count(F.lit(1)).alias("n"), F.try_divide(yes("hold"), F.count(F.lit(1))).alias("hold_rate"), yes("relevant").alias("n_relevant"), (F.count(F.lit(1)) - yes("relevant")).alias("n_not_relevant"))
