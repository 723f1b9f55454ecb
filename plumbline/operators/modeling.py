"""Heads for the six targets: boosted trees, calibration, thresholds and scoring.

Trees grow leaf-wise (boosting.py), all targets in the same passes; booster
"level" trains MLlib's level-wise trees instead, one target after the other.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressor, IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.fields import finite, number
from plumbline.functions.schema import BINARY, CONTINUOUS
from plumbline.operators import boosting, metrics
from plumbline.sources.scratch import materialize

#: Label-derived columns of the splits; as inputs they would leak the targets.
LEAKY = tuple(f"{k}_bin" for k in (*BINARY, "genuine")) + ("sample_weight",)


@dataclass(frozen=True)
class Training:
    exclude: tuple = ("review_id", "gmap_id", "user_id", "text")
    include: tuple = ()
    thresholds: dict = field(default_factory=lambda: {"ads_promo": 0.6, "spam_low_quality": 0.6, "irrelevant": 0.9, "rant_no_visit": 0.6})
    tune: bool = False
    calibrate: str | None = "isotonic"
    booster: str = "leaf"
    trees: int = 800
    leaves: int = 31
    depth: int = 0  # 0: no bound; booster "level" then takes 5
    rate: float = 0.05
    patience: int = 50
    columns: float = 0.9
    subsample: float = 0.9  # of booster "level" only: without a bagging interval, leaf-wise boosting draws no rows
    min_rows: int = 20
    seed: int = 16

    @property
    def boosting(self) -> boosting.Boosting:
        return boosting.Boosting(self.trees, self.leaves, self.rate, self.patience, self.min_rows, self.columns, self.depth, self.seed)


def pick_features(df: DataFrame, cfg: Training = Training()) -> list[str]:
    """Numeric and boolean columns but targets, excluded and leaky ones; or those included by name."""
    if cfg.include:
        return [c for c in cfg.include if c in df.columns]
    banned = {*cfg.exclude, *BINARY, *CONTINUOUS, *LEAKY}
    found = [f.name for f in df.schema if isinstance(f.dataType, (T.NumericType, T.BooleanType)) and f.name not in banned and not f.name.startswith("_")]
    if not found:
        raise ValueError("no numeric features")
    return found


def cleaned(df: DataFrame, features: list[str]) -> list[Column]:
    """The features as numbers; missing, NaN and infinite values, and columns that df lacks, are 0."""
    return [finite(F.col(c).cast("double")) if c in df.columns else F.lit(0.0) for c in features]


def assembled(df: DataFrame, features: list[str]) -> DataFrame:
    """df with the features as the vector column features."""
    clean = df.withColumns({f"__f{i}": c for i, c in enumerate(cleaned(df, features))})
    return VectorAssembler(inputCols=[f"__f{i}" for i in range(len(features))], outputCol="features").transform(clean).drop(*[f"__f{i}" for i in range(len(features))])


@dataclass
class Head:
    target: str
    model: PipelineModel | boosting.Forest
    features: list[str]
    calibrator: object | None = None
    threshold: float = 0.5

    def raw(self, df: DataFrame, out: str) -> DataFrame:
        """df (with the array __x, or the vector features for booster "level") and the uncalibrated score."""
        if isinstance(self.model, boosting.Forest):
            return df.withColumn(out, self.model.column(F.col("__x")))
        scored = self.model.transform(df)
        if self.target in BINARY:
            return scored.withColumn(out, vector_to_array("probability")[1]).drop("rawPrediction", "probability", "prediction")
        return scored.withColumn(out, F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("prediction")))).drop("prediction")

    def score(self, df: DataFrame) -> DataFrame:
        out = f"pred_{self.target}"
        return self.calibrated(self.raw(df, "__raw")) if self.calibrator else self.raw(df, out)

    def calibrated(self, df: DataFrame) -> DataFrame:
        """df with its column __raw made the final score."""
        out = f"pred_{self.target}"
        if not self.calibrator:
            return df.withColumnRenamed("__raw", out)
        if isinstance(self.calibrator, tuple):
            a, b = self.calibrator
            return df.withColumn(out, 1 / (1 + F.exp(-(a * F.col("__raw") + b)))).drop("__raw")
        return self.calibrator.transform(df).withColumn(out, F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("__cal")))).drop("__raw", "__cal")

    def score_one(self, row: list[float]) -> float:
        """The score of one row of features, on the driver, without a Spark job."""
        if isinstance(self.model, boosting.Forest):
            raw = float(self.model.score(np.array([row]))[0])
        elif self.target in BINARY:
            raw = float(self.model.stages[-1].predictProbability(Vectors.dense(row))[1])
        else:
            raw = float(self.model.stages[-1].predict(Vectors.dense(row)))
        if isinstance(self.calibrator, tuple):
            a, b = self.calibrator
            raw = 1 / (1 + float(np.exp(-(a * raw + b))))
        elif self.calibrator is not None:
            raw = self.calibrator.predict(raw)
        return min(1.0, max(0.0, raw))


def balanced(df: DataFrame, label: str) -> DataFrame:
    """df with weight N / (2 * N of the row's class)."""
    n = {r[label]: r["count"] for r in df.groupBy(label).count().collect()}
    total = max(1, sum(n.values()))
    return df.withColumn("__w", F.when(F.col(label) == 1, total / (2.0 * n.get(1, total))).otherwise(total / (2.0 * n.get(0, total))))


def _both(train: DataFrame, val: DataFrame) -> DataFrame:
    return train.withColumn("__val", F.lit(False)).unionByName(val.withColumn("__val", F.lit(True)), allowMissingColumns=True)


def _finished(head: Head, scored: DataFrame, cfg: Training) -> Head:
    """The head with its calibrator and tuned threshold, from validation rows with __y and __raw."""
    seen = scored.agg(F.min("__y"), F.max("__y")).first()
    if cfg.calibrate and seen[0] != seen[1]:
        head.calibrator = calibrator(scored, cfg.calibrate)
    if cfg.tune and seen[0] is not None:
        head.threshold = float(metrics.best_f1(head.calibrated(scored).select(F.col("__y").alias("y"), F.col(f"pred_{head.target}").alias("p"))).first()["threshold"])
    return head


def train_leafwise(train: DataFrame, val: DataFrame, targets: list[str], features: list[str], cfg: Training = Training()) -> dict[str, Head]:
    """Heads of all targets, grown together: classifiers of score >= 0.5 with balanced classes, regressors of the score; those that can't be trained are left out.

    Classes are counted in one pass over the training rows, and all validation
    rows are scored once for the calibrators.
    """
    label = {k: (finite(F.col(k)) >= 0.5).cast("double") if k in BINARY else number(F.col(k)) for k in targets}
    both = materialize(_both(train, val).select("__val", *[c.alias(f"__f{i}") for i, c in enumerate(cleaned(train, features))], *[c.alias(f"__y{i}") for i, c in enumerate(label.values())]))
    counts = both.where("NOT __val").agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"__y{i}").alias(f"s{i}") for i in range(len(targets))]).first()

    def weight(i: int, k: str) -> Column:
        positive = counts[f"s{i}"] or 0.0
        if k not in BINARY or not 0 < positive < counts["n"]:
            return F.lit(1.0)
        return F.when(F.col(f"__y{i}") == 1, counts["n"] / (2 * positive)).otherwise(counts["n"] / (2 * (counts["n"] - positive)))

    inputs = [F.col(f"__f{i}") for i in range(len(features))]
    found = boosting.fit(both, inputs, [boosting.Target(k, F.col(f"__y{i}"), weight(i, k), k in BINARY) for i, k in enumerate(targets)], F.col("__val"), cfg.boosting)
    heads = {k: Head(k, found[k], features, threshold=cfg.thresholds.get(k, 0.5) if k in BINARY else 0.5) for k in targets if k in found}
    ends = [k for k in heads if k in BINARY and (cfg.calibrate or cfg.tune)]
    if ends:
        held = both.where("__val").withColumn("__x", F.array(*inputs))
        held = materialize(held.select(*[F.col(f"__y{targets.index(k)}") for k in ends], *[heads[k].model.column(F.col("__x")).alias(f"__raw{targets.index(k)}") for k in ends]))
        for k in ends:
            i = targets.index(k)
            _finished(heads[k], held.select(F.col(f"__y{i}").cast("int").alias("__y"), F.col(f"__raw{i}").alias("__raw")), cfg)
    return heads


def train_binary(train: DataFrame, val: DataFrame, target: str, features: list[str], cfg: Training = Training()) -> Head | None:
    """A classifier of score >= 0.5, weighted by class, stopped on val, calibrated on val; None if train has one class only."""
    if cfg.booster == "leaf":
        return train_leafwise(train, val, [target], features, cfg).get(target)
    y = (finite(F.col(target)) >= 0.5).cast("int")
    both = materialize(balanced(assembled(_both(train, val).withColumn("__y", y), features), "__y").select("features", "__y", "__val", "__w"))
    seen = both.where("NOT __val").agg(F.min("__y"), F.max("__y")).first()
    if seen[0] == seen[1]:
        return None
    gbt = GBTClassifier(labelCol="__y", weightCol="__w", maxIter=cfg.trees, maxDepth=cfg.depth or 5, stepSize=cfg.rate, subsamplingRate=cfg.subsample, minInstancesPerNode=cfg.min_rows, seed=cfg.seed)
    has_val = not both.where("__val").isEmpty()
    head = Head(target, Pipeline(stages=[gbt.setValidationIndicatorCol("__val") if has_val else gbt]).fit(both), features, threshold=cfg.thresholds.get(target, 0.5))
    return _finished(head, head.raw(both.where("__val"), "__raw"), cfg)


def calibrator(scored: DataFrame, method: str = "isotonic"):
    """An isotonic model, or the two numbers of a sigmoid, from __raw and __y."""
    if method == "isotonic":
        return IsotonicRegression(featuresCol="__raw", labelCol="__y", predictionCol="__cal").fit(scored)
    as_vector = VectorAssembler(inputCols=["__raw"], outputCol="__v")
    fitted = LogisticRegression(featuresCol="__v", labelCol="__y", maxIter=50).fit(as_vector.transform(scored))
    return float(fitted.coefficients[0]), float(fitted.intercept)


def train_regression(train: DataFrame, val: DataFrame, target: str, features: list[str], cfg: Training = Training()) -> Head | None:
    """A regressor of the score, stopped on val; None without rows to train on."""
    if cfg.booster == "leaf":
        return train_leafwise(train, val, [target], features, cfg).get(target)
    both = materialize(assembled(_both(train, val).withColumn("__y", number(F.col(target))).where("__y IS NOT NULL"), features).select("features", "__y", "__val"))
    if both.where("NOT __val").isEmpty():
        return None
    gbt = GBTRegressor(labelCol="__y", maxIter=cfg.trees, maxDepth=cfg.depth or 5, stepSize=cfg.rate, subsamplingRate=cfg.subsample, minInstancesPerNode=cfg.min_rows, seed=cfg.seed)
    return Head(target, Pipeline(stages=[gbt if both.where("__val").isEmpty() else gbt.setValidationIndicatorCol("__val")]).fit(both), features)


def train(train_: DataFrame, val: DataFrame, cfg: Training = Training(), targets=(*BINARY, *CONTINUOUS)) -> dict[str, Head]:
    features, known = pick_features(train_, cfg), [k for k in targets if k in train_.columns]
    if cfg.booster == "leaf":
        return train_leafwise(train_, val, known, features, cfg)
    heads = {k: (train_binary if k in BINARY else train_regression)(train_, val, k, features, cfg) for k in known}
    return {k: h for k, h in heads.items() if h}


def predict(df: DataFrame, heads: dict[str, Head], id_key: str = "review_id") -> DataFrame:
    """id and pred_<target>: the features are assembled once and all heads score the same rows, so nothing is joined."""
    if not heads:
        return df.select(id_key)
    features = next(iter(heads.values())).features
    leafwise = [isinstance(h.model, boosting.Forest) for h in heads.values()]
    out = df if all(leafwise) else assembled(df, features)
    out = out.select(id_key, *([] if all(leafwise) else ["features"]), *([F.array(*cleaned(df, features)).alias("__x")] if any(leafwise) else []))
    for head in heads.values():
        out = head.score(out)
    return out.select(id_key, *[f"pred_{k}" for k in heads])


def save(heads: dict[str, Head], path: str, spark) -> None:
    """A JSON line for each head in heads/, with its trees; for booster "level" a pipeline model each; an isotonic model where there is one."""
    rows = []
    for k, h in heads.items():
        forest = h.model.to_json() if isinstance(h.model, boosting.Forest) else None
        if forest is None:
            h.model.write().overwrite().save(f"{path}/{k}")
        isotonic = h.calibrator is not None and not isinstance(h.calibrator, tuple)
        if isotonic:
            h.calibrator.write().overwrite().save(f"{path}/{k}-calibrator")
        rows.append((json.dumps({"target": k, "features": h.features, "threshold": h.threshold, "sigmoid": h.calibrator if isinstance(h.calibrator, tuple) else None, "isotonic": isotonic, "forest": forest}),))
    spark.createDataFrame(rows, "value string").coalesce(1).write.mode("overwrite").text(f"{path}/heads")


def load(path: str, spark) -> dict[str, Head]:
    from pyspark.ml.regression import IsotonicRegressionModel

    out = {}
    for row in spark.read.text(f"{path}/heads").collect():
        x = json.loads(row.value)
        cal = IsotonicRegressionModel.load(f"{path}/{x['target']}-calibrator") if x["isotonic"] else tuple(x["sigmoid"]) if x["sigmoid"] else None
        model = boosting.Forest.from_json(x["forest"]) if x.get("forest") else PipelineModel.load(f"{path}/{x['target']}")
        out[x["target"]] = Head(x["target"], model, x["features"], cal, x["threshold"])
    return out


def predict_one(heads: dict[str, Head], row: dict, spark=None) -> dict[str, float]:
    """Scores of one review, given as a dict: target -> score within 0 and 1; features it lacks are 0. No Spark job."""
    def value(x) -> float:
        x = float(x) if isinstance(x, (int, float)) else 0.0
        return x if np.isfinite(x) else 0.0

    return {k: h.score_one([value(row.get(c)) for c in h.features]) for k, h in heads.items()}
