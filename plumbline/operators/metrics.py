"""Evaluation measures as aggregates: columns y (0 or 1) and p (a score).

Ranking measures group by distinct score first, so that ties count once and the
ordered window runs over score values. Scores are cut into ranges of about as
many distinct scores each; each range is a partition, with the sums of the
ranges above added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.sources.scratch import materialize

RANGES = 256


def _div(a: Column, b: Column) -> Column:
    return F.when(b != 0, a / b).otherwise(F.lit(0.0))


def confusion(df: DataFrame, threshold: float, keys: list[str] | None = None) -> DataFrame:
    """tp, fp, tn, fn, precision, recall, f1, accuracy, prevalence in one pass; p >= threshold is a positive."""
    n = lambda cond: F.coalesce(F.sum(cond.cast("long")), F.lit(0)).cast("long")
    y, hit = F.col("y") == 1, F.col("p") >= threshold
    df = df.groupBy(*(keys or [])).agg(n(y & hit).alias("tp"), n(~y & hit).alias("fp"), n(~y & ~hit).alias("tn"), n(y & ~hit).alias("fn"), F.avg("y").alias("prevalence"))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    precision, recall = _div(tp, tp + fp), _div(tp, tp + fn)
    return df.withColumns({"precision": precision, "recall": recall, "f1": _div(2 * precision * recall, precision + recall), "accuracy": _div(tp + F.col("tn"), tp + fp + F.col("tn") + fn)})


def brier(df: DataFrame) -> DataFrame:
    return df.agg(F.avg(F.pow(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("p"))) - F.col("y"), 2)).alias("brier"))


def curve(df: DataFrame) -> DataFrame:
    """One row a distinct score, with tp and fp at or above it, those at it (dtp, dfp), the totals (pos, neg) and rank (from 0, the highest score first).

    The sums of the score ranges above are a table of RANGES rows; the window
    inside a range holds that range's scores only.
    """
    points = materialize(df.groupBy("p").agg(F.sum("y").cast("long").alias("dtp"), F.sum(1 - F.col("y")).cast("long").alias("dfp")))
    pos, neg = points.agg(F.coalesce(F.sum("dtp"), F.lit(0)), F.coalesce(F.sum("dfp"), F.lit(0))).first()
    edges = sorted(set(points.where("p IS NOT NULL").approxQuantile("p", [k / RANGES for k in range(1, RANGES)], 0.25 / RANGES)))
    at = F.size(F.filter(F.array(*map(F.lit, edges)), lambda e: e <= F.col("p"))) if edges else F.lit(0)
    points = points.withColumn("__range", at)
    sums = points.groupBy("__range").agg(F.sum("dtp").alias("t"), F.sum("dfp").alias("f"), F.count(F.lit(1)).alias("n"))
    above = Window.orderBy(F.desc("__range")).rowsBetween(Window.unboundedPreceding, -1)  # over RANGES rows
    bases = sums.select("__range", *[F.coalesce(F.sum(x).over(above), F.lit(0)).alias(f"{x}0") for x in "tfn"])
    order = Window.partitionBy("__range").orderBy(F.desc("p"))
    inside = order.rowsBetween(Window.unboundedPreceding, 0)
    joined = points.withColumns({"t": F.sum("dtp").over(inside), "f": F.sum("dfp").over(inside), "n": F.row_number().over(order)}).join(F.broadcast(bases), "__range")  # RANGES rows at most
    return joined.select("p", "dtp", "dfp", (F.col("t0") + F.col("t")).cast("long").alias("tp"), (F.col("f0") + F.col("f")).cast("long").alias("fp"), F.lit(pos).cast("long").alias("pos"), F.lit(neg).cast("long").alias("neg"), (F.col("n0") + F.col("n") - 1).alias("rank"))


def ranking(df: DataFrame) -> DataFrame:
    """roc_auc (ties count half) and pr_auc (average precision, a step a distinct score); null if a class is missing."""
    c = curve(df)
    tp, dtp, fp, dfp = (F.col(x).cast("double") for x in ("tp", "dtp", "fp", "dfp"))
    area = F.sum(dfp * (tp - dtp / 2)) / F.max(F.col("pos").cast("double") * F.col("neg"))
    precision = F.sum(dtp * tp / (tp + fp)) / F.max(F.col("pos"))
    both = (F.max("pos") > 0) & (F.max("neg") > 0)
    return c.agg(F.when(both, area).alias("roc_auc"), F.when(both, precision).alias("pr_auc"))


def roc_points(df: DataFrame) -> DataFrame:
    c = curve(df)
    tp, fp = F.col("tp"), F.col("fp")
    return c.select("p", _div(fp, F.col("neg")).alias("fpr"), _div(tp, F.col("pos")).alias("tpr"), _div(tp, tp + fp).alias("precision"))


def histogram(df: DataFrame, bins: int = 20) -> DataFrame:
    """y, bin, n: equal bins over each class's own range of scores; the top edge belongs to the last bin."""
    edges = df.groupBy("y").agg(F.min("p").alias("lo"), F.max("p").alias("hi"))
    placed = df.join(F.broadcast(edges), "y")  # one row a class
    at = F.when(F.col("hi") > F.col("lo"), F.least(F.lit(bins - 1), F.floor((F.col("p") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins))).otherwise(F.lit(bins // 2))
    return placed.groupBy("y", at.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def calibration(df: DataFrame, bins: int = 10) -> DataFrame:
    """bin, n, confidence and rate; a score of exactly 1 is in no bin."""
    at = F.floor(F.col("p") * bins).cast("int")
    return df.withColumn("bin", at).where((F.col("bin") >= 0) & (F.col("bin") < bins)).groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.avg("p").alias("confidence"), F.avg("y").alias("rate"))


#: The coarse thresholds that are always tried, and how many distinct scores at most.
COARSE = tuple(round(0.05 * k, 2) for k in range(1, 20))
MOST_CANDIDATES = 512


def best_f1(df: DataFrame) -> DataFrame:
    """threshold and f1: the best of the coarse grid and of the distinct scores (evenly spaced ones if there are many); ties go to the lowest."""
    c = materialize(curve(df))
    n = c.count()
    scores = c
    if n > MOST_CANDIDATES:
        chosen = {n - 1 - k * (n - 1) // (MOST_CANDIDATES - 1) for k in range(MOST_CANDIDATES)}  # places from the lowest score, rounded down
        scores = c.where(F.col("rank").isin(sorted(chosen)))
    # A coarse threshold's counts are the sums at and above it.
    total = lambda k, t: F.coalesce(F.sum(F.when(F.col("p") >= t, F.col(k))), F.lit(0))
    coarse = c.agg(F.array(*[F.struct(F.lit(t).alias("threshold"), total("dtp", t).alias("tp"), total("dfp", t).alias("fp")) for t in COARSE]).alias("x")).select(F.inline("x"))
    tries = scores.select(F.col("p").alias("threshold"), "tp", "fp").union(coarse)
    pos = c.agg(F.coalesce(F.max("pos"), F.lit(0)).alias("n")).first()["n"]
    f1 = _div(2.0 * F.col("tp"), F.col("tp") + F.col("fp") + F.lit(float(pos)))
    return tries.select("threshold", f1.alias("f1")).orderBy(F.desc(F.round("f1", 12)), "threshold").limit(1)


def regression(df: DataFrame) -> DataFrame:
    """mae, rmse, r2 of prediction p against y."""
    e = F.col("p") - F.col("y")
    sse, n = F.sum(e * e), F.count(F.lit(1))
    sst = F.sum(F.col("y") * F.col("y")) - F.sum("y") * F.sum("y") / n
    return df.agg(F.avg(F.abs(e)).alias("mae"), F.sqrt(sse / n).alias("rmse"), F.when(sst > 0, 1 - sse / sst).alias("r2"))
