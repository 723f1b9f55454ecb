"""The nine stages, from raw dumps to decisions, on tables or on files; run() of each reads, computes and writes."""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.schema import BINARY, CONTINUOUS, REVIEW, documents_as_reviews
from plumbline.operators import annotation, features, joins, labeling, metrics, modeling, policy, rules, sampling, splitting
from plumbline.sources import config, io
from plumbline.sources.scratch import materialize


def collect(reviews: DataFrame, meta: DataFrame | None, as_of: float, cfg: sampling.Sampler = sampling.Sampler(), on: str = "gmap_id", keep: list[str] | None = None) -> DataFrame:
    """1. Sampled reviews with ids and metadata; the metadata is joined to the sample only, unless the region filter needs it."""
    from plumbline.functions.fields import with_review_id

    early = meta is not None and cfg.region and "region" in meta.columns and "region" not in reviews.columns
    pool = joins.merge_metadata(reviews, meta, on, keep) if early else with_review_id(reviews)
    picked = sampling.sample_reviews(pool, cfg, as_of)
    return picked if early or meta is None else joins.merge_metadata(picked, meta, on, keep)


def evaluate(base: DataFrame, preds: DataFrame, thresholds: dict, split: str = "test", id_key: str = "review_id", targets=BINARY) -> DataFrame:
    """8. One row a target: counts, precision, recall, f1, accuracy, roc_auc, pr_auc, brier."""
    both = materialize(base.select(id_key, *targets).join(joins.keep_first(preds.select(id_key, *[f"pred_{k}" for k in targets]), [id_key]), id_key).na.drop(subset=[f"pred_{k}" for k in targets]))
    out = None
    for k in targets:
        t = float(thresholds.get(k, 0.5))
        z = both.select((F.coalesce(F.col(k).try_cast("double"), F.lit(0.0)) >= t).cast("int").alias("y"), F.col(f"pred_{k}").alias("p"))
        row = metrics.confusion(z, t).join(metrics.ranking(z)).join(metrics.brier(z))  # one row each
        row = row.select(F.lit(split).alias("split"), F.lit(k).alias("target"), F.lit(t).alias("threshold"), "*")
        out = row if out is None else out.unionByName(row)
    return out


def report(summary: DataFrame) -> str:
    """The summary as Markdown; a row for each split and target."""
    cols = summary.columns
    line = lambda xs: "| " + " | ".join("" if x is None else f"{x:.4f}" if isinstance(x, float) else str(x) for x in xs) + " |"
    return "\n".join(["# Evaluation", "", line(cols), line("-" * len(cols)), *[line(r) for r in summary.collect()], ""])


@dataclass
class Paths:
    """Where the file-to-file run keeps its tables."""

    root: str
    sources: list[str] = field(default_factory=list)

    def __getattr__(self, name: str) -> str:
        if name.startswith("_"):
            raise AttributeError(name)
        return f"{self.root}/{name}.parquet"


@dataclass
class Run:
    """All stages over files. Each stage's table is written once and read by the next, so a lost executor costs one stage at most."""

    spark: SparkSession
    paths: Paths
    as_of: float = field(default_factory=time.time)
    sampler: sampling.Sampler = field(default_factory=sampling.Sampler)
    split_cfg: splitting.Split = field(default_factory=splitting.Split)
    training: modeling.Training = field(default_factory=modeling.Training)
    policy_cfg: policy.Policy = field(default_factory=policy.Policy)
    n_silver: int = 2000
    system_path: str | None = None
    shots_path: str | None = None
    debug: str | None = None

    def _keep(self, df: DataFrame, name: str) -> DataFrame:
        path = getattr(self.paths, name)
        io.write_any(df, path)
        return self.spark.read.parquet(path)

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(getattr(self.paths, name))

    def data_collection(self) -> DataFrame:
        reviews, meta = io.read_sources(self.spark, self.paths.sources, REVIEW)
        return self._keep(collect(reviews, meta, self.as_of, self.sampler), "sampled")

    def feature_engineering(self) -> DataFrame:
        return self._keep(features.features(self._read("sampled"), self.as_of, carry=(*features.CARRY, "name", "category")), "features")

    def rules_baseline(self) -> DataFrame:
        return self._keep(rules.rules(self._read("features")), "rules")

    def silver_labeling(self, make=lambda: labeling.heuristic, fuse: bool = False) -> DataFrame:
        base = self._read("rules")
        prompt = None
        if self.system_path:
            system, shots = config.prompts(self.system_path, self.shots_path)
            prompt = {"system": system, "shots": shots}
        labels = self._keep(labeling.silver(base, self.n_silver, self.sampler.seed, rules=base if fuse else None, make=make, prompt=prompt, debug=self.debug), "silver")
        return self._keep(joins.merge_with_base(base, labels), "silver_with_ids")

    def gold_build(self, **options) -> DataFrame:
        return self._keep(sampling.gold_pack(self._read("rules"), self.as_of, **options), "gold_pack")

    def gold_ingest(self, labels: DataFrame) -> DataFrame:
        return self._keep(annotation.ingest(self._read("gold_pack"), labels), "gold_merged")

    def dataset_split(self) -> dict[str, DataFrame]:
        rows, folds, cuts = splitting.split(self._read("silver_with_ids"), self.split_cfg)
        rows = self._keep(rows, "split")
        io.write_any(folds, f"{self.paths.root}/folds.csv")
        io.write_document(self.spark, cuts, f"{self.paths.root}/stratify_thresholds.json")
        return {k: self._keep(rows.where(F.col("_split") == k).drop(*[c for c in rows.columns if c.startswith("_")]), k) for k in ("train", "val", "test")}

    def model_training(self) -> dict[str, modeling.Head]:
        train, val, test = (self._read(k) for k in ("train", "val", "test"))
        heads = modeling.train(train, val, self.training)
        modeling.save(heads, f"{self.paths.root}/models", self.spark)
        io.write_document(self.spark, {k: h.threshold for k, h in heads.items() if k in BINARY}, f"{self.paths.root}/thresholds.json")
        for name, df in (("val", val), ("test", test)):
            self._keep(joins.predictions_for(df, modeling.predict(df, heads)), f"{name}_preds")
        return heads

    def evaluation(self) -> DataFrame:
        thresholds = io.read_document(self.spark, f"{self.paths.root}/thresholds.json", {})
        known = [k for k in BINARY if f"pred_{k}" in self._read("test_preds").columns]
        parts = [evaluate(self._read(s), self._read(f"{s}_preds"), thresholds, s, targets=known) for s in ("test", "val")]
        summary = self._keep(parts[0].unionByName(parts[1]), "summary")
        io.write_any(summary, f"{self.paths.root}/summary.csv", single=True)
        io.write_document(self.spark, report(summary), f"{self.paths.root}/report.md")
        return summary

    def policy_enforcement(self, split: str = "test") -> DataFrame:
        preds = self._read(f"{split}_preds")
        missing = {f"pred_{k}": F.lit(None).cast("double") for k in (*BINARY, *CONTINUOUS) if f"pred_{k}" not in preds.columns}
        decided = self._keep(policy.decisions(self._read(split), preds.withColumns(missing), policy=self.policy_cfg), "decisions")
        io.write_any(policy.counts(decided), f"{self.paths.root}/counts.csv", single=True)
        io.write_any(policy.reasons(decided), f"{self.paths.root}/reasons.csv")
        return decided

    def all(self) -> DataFrame:
        self.data_collection()
        self.feature_engineering()
        self.rules_baseline()
        self.silver_labeling()
        self.gold_build()
        self.dataset_split()
        self.model_training()
        self.evaluation()
        return self.policy_enforcement()


def demo(spark: SparkSession, root: str, n: int = 1) -> dict[str, DataFrame | None]:
    """A look at what a run left: test rows of the summary, decision counts and the first decisions; None for what is missing."""
    summary, counts, decided = (io.try_read(spark, f"{root}/{x}") for x in ("summary.csv", "counts.csv", "decisions.parquet"))
    return {"summary": summary.where("split = 'test'") if summary else None, "counts": counts, "decisions": decided.limit(n) if decided else None}


def documents_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stages 2 and 3 over the documents table."""
    return rules.rules(features.features(documents_as_reviews(spark.read.parquet(f"{sf_dir}/documents.parquet")), 1735689600))
