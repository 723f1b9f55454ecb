"""Human labels: votes by id, joined to the pack."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.fields import number
from plumbline.functions.schema import BINARY, CONTINUOUS, require


def majority(labels: DataFrame, id_key: str = "review_id", flags=BINARY, scores=CONTINUOUS, annotator: str = "annotator_id") -> DataFrame:
    """One row an id: majority of each flag (a tie is 1), mean of each score, n_annot distinct annotators."""
    require(labels, [id_key, *flags, *scores])
    vote = lambda c: F.coalesce(F.col(c).cast("int"), F.lit(0))
    flag = [F.when(2 * F.sum(vote(c)) >= F.count(F.lit(1)), 1).otherwise(0).alias(c) for c in flags]
    score = [F.avg(number(F.col(c))).alias(c) for c in scores]
    n = F.countDistinct(annotator) if annotator in labels.columns else F.count(F.lit(1))
    return labels.groupBy(id_key).agg(*flag, *score, n.alias("n_annot"))


def ingest(pack: DataFrame, labels: DataFrame, id_key: str = "review_id") -> DataFrame:
    """The pack with the aggregated labels; rows without labels stay."""
    merged = majority(labels, id_key)
    return pack.drop(*[c for c in merged.columns if c != id_key]).join(merged, id_key, "left")
