"""Binary targets, weights and leakage-free splits by group."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.fields import epoch_seconds, finite, number
from plumbline.functions.schema import BINARY, require
from plumbline.operators.joins import keep_first
from plumbline.operators.ranges import placed
from plumbline.sources.scratch import materialize

TINY = 4.9e-324
#: Rule flags that stand in for sparse labels.
PROXY = {"ads_promo": "rule_ads_strong", "spam_low_quality": "rule_spam_strong", "irrelevant": "rule_irrelevant_strong", "rant_no_visit": "rule_rant_strong"}


@dataclass(frozen=True)
class Split:
    prevalence: dict = field(default_factory=lambda: {"ads_promo": 5, "spam_low_quality": 5, "irrelevant": 5, "rant_no_visit": 3})
    min_per_split: dict = field(default_factory=lambda: {"val": 5, "test": 5})
    min_total: dict = field(default_factory=lambda: {"ads_promo": 40, "spam_low_quality": 40, "irrelevant": 40, "rant_no_visit": 15})
    use_rule_proxy: bool = True
    top_groups_on_sparse: bool = True
    genuine: bool = True
    weight: str = "1-entropy"
    holdout_percent: float = 0.0
    ratios: tuple = (0.70, 0.15, 0.15)
    seed: int = 16
    group: str = "gmap_id"
    missing_time_is_newest: bool = False


#: Ranges into which a column's values are counted at once.
RANGES = 4096


def quantile(values: DataFrame, q: float) -> float | None:
    """The exact quantile of column x (no nulls), linear between two values; None without rows.

    Values are counted in even ranges, and again in the range that holds the
    wanted place, until that range is one value. Each pass brings RANGES rows
    at most to the driver, and no task holds more.
    """
    n, low, high = values.agg(F.count(F.lit(1)), F.min("x"), F.max("x")).first()
    if not n:
        return None
    place = (n - 1) * q
    rank = int(place)
    skipped = 0
    while low < high:
        at = F.least(F.lit(RANGES - 1), F.floor((F.col("x") / 2 - low / 2) / (high / 2 - low / 2) * RANGES))
        inside = values.where(F.col("x").between(low, high)).groupBy(at.alias("r")).agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
        for r in sorted(inside.collect(), key=lambda r: r["lo"]):
            if skipped + r["n"] > rank:
                low, high = r["lo"], r["hi"]
                break
            skipped += r["n"]
    if place == rank:
        return low
    upto, after = values.agg(F.sum((F.col("x") <= low).cast("long")), F.min(F.when(F.col("x") > low, F.col("x")))).first()
    if upto > rank + 1:
        return low  # a weighted sum of two equal values may round to below them, and rows at the cut would be above it
    return min(after, max(low, (rank + 1 - place) * low + (place - rank) * after))


def cuts(df: DataFrame, prevalence: dict) -> dict[str, float]:
    """Label -> exact quantile of its score that leaves the wanted share above it; never 0 or less."""
    scores = materialize(df.select(*[finite(F.col(k)).alias(k) for k in prevalence]))
    found = {k: quantile(scores.select(F.col(k).alias("x")).where("x IS NOT NULL"), 1 - p / 100.0) for k, p in prevalence.items()}
    return {k: v if v is not None and v > 0 else TINY for k, v in found.items()}


def binarize(df: DataFrame, cut: dict[str, float], genuine: bool = True) -> DataFrame:
    """<label>_bin (strictly above the cut) and genuine_bin (relevant, and no label)."""
    df = df.withColumns({f"{k}_bin": (finite(F.col(k)) > F.lit(t)).cast("int") for k, t in cut.items()})
    clean = F.greatest(*[F.col(f"{k}_bin") for k in cut], F.lit(0)) == 0
    good = F.coalesce((number(F.col("relevancy_score")) >= 0.6) & clean, F.lit(False)).cast("int") if genuine and "relevancy_score" in df.columns else F.lit(0)
    return df.withColumn("genuine_bin", good)


def enforce_minimum(df: DataFrame, cfg: Split) -> DataFrame:
    """Sparse labels get more positives: first from rule flags, then by marking the best-scored groups whole."""
    total = lambda x: x.agg(*[F.coalesce(F.sum(f"{k}_bin"), F.lit(0)).alias(k) for k in cfg.prevalence]).first().asDict()
    have = total(df)
    short = [k for k in cfg.prevalence if have[k] < cfg.min_total.get(k, 0)]
    if cfg.use_rule_proxy and short:
        marked = {f"{k}_bin": F.when(F.coalesce(F.col(PROXY[k]).cast("int"), F.lit(0)) == 1, 1).otherwise(F.col(f"{k}_bin")) for k in short if PROXY[k] in df.columns}
        if marked:
            df = df.withColumns(marked)
            have = total(df)
    if cfg.top_groups_on_sparse:
        for k in cfg.prevalence:
            if (need := cfg.min_total.get(k, 0) - have[k]) > 0:
                df = mark_top_groups(df, k, need, cfg.group)
    return df


def mark_top_groups(df: DataFrame, label: str, n: int, group: str) -> DataFrame:
    """The n groups with the highest score of those without a positive become positive as a whole."""
    best = df.groupBy(group).agg(F.max(finite(F.col(label))).alias("s"), F.max(f"{label}_bin").alias("b")).where(F.col("b") == 0)
    top = best.orderBy(F.desc("s"), group).limit(n).select(F.col(group).alias("__g"), F.lit(1).alias("__top"))  # n rows
    joined = df.join(F.broadcast(top), df[group].eqNullSafe(top["__g"]), "left")
    return joined.withColumn(f"{label}_bin", F.greatest(F.col(f"{label}_bin"), F.coalesce("__top", F.lit(0)))).select(*df.columns)


def sample_weight(mode: str = "1-entropy", labels=BINARY) -> Column:
    """Confidence of the scores, within 0.05 and 1."""
    p = [finite(F.col(k)) for k in labels]
    if mode == "uniform":
        return F.lit(1.0)
    if mode == "max-violation":
        w = F.greatest(*p) if len(p) > 1 else p[0]
    else:
        p = [F.greatest(F.lit(0.0), F.least(F.lit(1.0), x)) + 1e-6 for x in p]
        total = sum(p[1:], p[0])
        entropy = sum((-(x / total) * F.ln(x / total) for x in p), F.lit(0.0))
        w = 1 - entropy / F.lit(max(_log(len(p)), 1e-12))
    return F.greatest(F.lit(0.05), F.least(F.lit(1.0), w))


def _log(k: int) -> float:
    import math

    return math.log(k)


def holdout_groups(df: DataFrame, percent: float, group: str, time: str = "time", missing_is_newest: bool = False) -> DataFrame:
    """The newest groups by their last time, at least one."""
    last = df.groupBy(group).agg(F.max(epoch_seconds(F.col(time))).alias("t"))
    k = max(1, int(round(percent / 100.0 * last.count())))
    order = F.desc_nulls_first("t") if missing_is_newest else F.desc_nulls_last("t")
    return last.orderBy(order, F.desc(group)).limit(k).select(group)


#: Means of scores up to this size are compared by exact sums, to 18 decimals.
EXACT = 10**6


def group_labels(df: DataFrame, group: str, labels=BINARY) -> DataFrame:
    """group and label: the label with most positives, ties by mean score, then by order; "genuine" without any.

    A group has one number of rows, so sums stand for means. They are decimal:
    sums of doubles differ in their last digits by the order of rows, so equal
    means would be told apart by it.
    """
    scores = {k: finite(F.col(k)) for k in labels}
    large = F.max(F.greatest(*[F.abs(x) for x in scores.values()], F.lit(0.0))) > EXACT
    exact = lambda x: F.when(~large, F.sum(F.when(F.abs(x) <= EXACT, x).cast("decimal(38,18)")))
    found = [F.struct(F.sum(f"{k}_bin").cast("long").alias("n"), exact(x).alias("exact"), F.when(large, F.avg(x)).alias("mean"), F.lit(-i).alias("order"), F.lit(k).alias("label")) for i, (k, x) in enumerate(scores.items())]
    best = F.array_max(F.array(*found))
    return df.groupBy(group).agg(best.alias("__b")).select(group, F.when(F.col("__b.n") > 0, F.col("__b.label")).otherwise("genuine").alias("label"))


def order_key(seed: int, c: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(c).cast("string"), F.lit(""))))


def assign(groups: DataFrame, ratios=(0.70, 0.15, 0.15), seed: int = 16, group: str = "gmap_id") -> DataFrame:
    """groups (group, label) with split: within a label, in hash order, the first shares go to train and val."""
    rows = placed(groups, ["label"], order_key(seed, group), [group])
    train, val = F.bround(F.col("__total") * ratios[0]), F.bround(F.col("__total") * ratios[1])
    return rows.withColumn("split", F.when(F.col("__n") <= train, "train").when(F.col("__n") <= train + val, "val").otherwise("test")).drop("__n", "__total")


def rebalance(table: DataFrame, labels=BINARY, min_per_split: dict | None = None, seed: int = 16, group: str = "gmap_id") -> DataFrame:
    """Whole positive groups move into val and test until each has enough positives of each label.

    table: group, split and <label>_bin sums, one row a group. Each move is one
    limit over that table: first from train, then from the other split; as many
    groups move as positives were missing, however many each of them has. The
    table is written after each move, so that plans stay short.
    """
    for target in ("val", "test"):
        for k in labels:
            have = table.where(F.col("split") == target).agg(F.coalesce(F.sum(f"{k}_bin"), F.lit(0)).alias("n")).first()["n"]
            want = (min_per_split or {}).get(target, 0) - have
            for donor in ("train", "test" if target == "val" else "val"):
                if want <= 0:
                    break
                moved = table.where((F.col("split") == donor) & (F.col(f"{k}_bin") > 0)).orderBy(order_key(seed, group), group).limit(int(want)).select(F.col(group).alias("__g"), F.lit(True).alias("__move"))
                moved = materialize(moved)
                want -= moved.count()
                joined = table.join(F.broadcast(moved), table[group].eqNullSafe(moved["__g"]), "left")  # at most min_per_split rows
                table = materialize(joined.withColumn("split", F.when(F.col("__move"), target).otherwise(F.col("split"))).select(*table.columns))
    return table


def split(df: DataFrame, cfg: Split = Split(), id_key: str = "review_id", text: str = "text") -> tuple[DataFrame, DataFrame, dict[str, float]]:
    """Rows with their targets, sample_weight and _split; the folds (id, group, _grp_label, _split); the cuts."""
    require(df, [id_key, cfg.group, *cfg.prevalence])
    if text in df.columns:
        df = df.where(F.trim(F.coalesce(F.col(text), F.lit(""))) != "")
    df = keep_first(df, [id_key])
    cut = cuts(df, cfg.prevalence)
    df = enforce_minimum(binarize(df, cut, cfg.genuine), cfg).withColumn("sample_weight", sample_weight(cfg.weight, tuple(cfg.prevalence)))
    labels = tuple(cfg.prevalence)
    groups = group_labels(df, cfg.group, labels)
    sums = df.groupBy(cfg.group).agg(*[F.sum(f"{k}_bin").cast("long").alias(f"{k}_bin") for k in labels])
    placed = assign(groups, cfg.ratios, cfg.seed, cfg.group)
    if cfg.holdout_percent > 0 and "time" in df.columns:
        held = holdout_groups(df, cfg.holdout_percent, cfg.group, missing_is_newest=cfg.missing_time_is_newest)
        rest = groups.join(held, cfg.group, "left_anti")
        placed = assign(rest, cfg.ratios, cfg.seed, cfg.group).unionByName(groups.join(held, cfg.group, "left_semi").withColumn("split", F.lit("test")))
    table = placed.join(sums, placed[cfg.group].eqNullSafe(sums[cfg.group])).select(placed[cfg.group], "label", "split", *[f"{k}_bin" for k in labels])
    table = materialize(table)
    table = rebalance(table, labels, cfg.min_per_split, cfg.seed, cfg.group).select(F.col(cfg.group).alias("__g"), F.col("label").alias("_grp_label"), F.col("split").alias("_split"))
    joined = df.join(table, df[cfg.group].eqNullSafe(table["__g"]), "left").drop("__g").withColumn("_split", F.coalesce("_split", F.lit("train")))
    return joined, joined.select(id_key, cfg.group, "_grp_label", "_split"), cut


def coverage(rows: DataFrame, labels=BINARY) -> DataFrame:
    """Rows and positives of each label by split."""
    return rows.groupBy("_split").agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"{k}_bin").cast("long").alias(k) for k in labels])
