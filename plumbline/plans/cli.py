"""spark-submit entry: python -m plumbline.plans.cli STAGE --config run.yaml

The YAML has root, sources and, by section, the options of the stages.
"""

from __future__ import annotations

import argparse
import logging

from plumbline.sources import config

STAGES = ("data_collection", "feature_engineering", "rules_baseline", "silver_labeling", "gold_build", "gold_ingest", "dataset_split", "model_training", "evaluation", "policy_enforcement", "all")


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("stage", choices=STAGES)
    parser.add_argument("--config", required=True)
    parser.add_argument("--labels", help="human labels, for gold_ingest")
    parser.add_argument("--log-level", default="INFO")
    parser.add_argument("--dry-run", action="store_true", help="show the sample's plan, write nothing")
    args = parser.parse_args(argv)
    logging.basicConfig(level=args.log_level, format="%(asctime)s %(levelname)s %(name)s %(message)s")
    log = logging.getLogger("plumbline")
    cfg = config.load(args.config, ("root",))

    from pyspark.sql import SparkSession

    from plumbline.functions.schema import REVIEW
    from plumbline.operators import modeling, policy, sampling, splitting
    from plumbline.plans.pipelines import Paths, Run, collect
    from plumbline.sources import io

    spark = SparkSession.builder.appName(f"plumbline-{args.stage}").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    options = {"sampler": sampling.Sampler(**cfg.get("sampler", {})), "split_cfg": splitting.Split(**cfg.get("split", {})), "training": modeling.Training(**cfg.get("training", {})), "policy_cfg": policy.Policy(**cfg.get("policy", {}))}
    options |= {k: cfg[k] for k in ("as_of", "n_silver") if k in cfg}
    run = Run(spark, Paths(cfg["root"], cfg.get("sources", [])), **options)
    if args.dry_run:
        reviews, meta = io.read_sources(spark, run.paths.sources, REVIEW)
        collect(reviews, meta, run.as_of, run.sampler).explain("formatted")
        return 0
    log.info("stage %s, tables in %s", args.stage, cfg["root"])
    if args.stage == "gold_ingest":
        run.gold_ingest(io.read_any(spark, args.labels))
    else:
        getattr(run, args.stage)()
    log.info("stage %s done", args.stage)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
