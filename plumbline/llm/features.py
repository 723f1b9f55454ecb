"""Labelled training samples and text features that the two classifiers share."""

from __future__ import annotations

import re
import zlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import materialize

SPLIT = re.compile(r"[^\W_]+")
#: Bytes of features, by the estimate of the model that makes them, that reach the driver at most.
MOST_BYTES = 32 << 20


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo folds."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def training_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, most: int) -> DataFrame:
    """text and y of at most `most` labelled documents outside the held-out fold, in equal parts by label where there are enough.

    The sample is the first by a hash of doc_id, so it is the same in every
    run; of several labels or texts of one id the largest counts, so no more
    than `most` rows result however often an id is repeated. weight makes the
    sample stand for all labelled rows.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).where(fold(F.col("doc_id"), folds) != held_out)
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    n = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    order = [F.xxhash64(F.lit(label), F.col("doc_id")), F.col("doc_id")]
    half = [known.where(F.col("y") == y).orderBy(*order).limit(min(n.get(y, 0), most // 2)) for y in (0, 1)]
    picked = half[0].union(half[1]).withColumn("weight", F.when(F.col("y") == 0, max(1.0, n.get(0, 0) / (most // 2))).otherwise(max(1.0, n.get(1, 0) / (most // 2))))
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ids = F.broadcast(picked)  # `most` rows at most
    return texts.join(ids, "doc_id").groupBy("doc_id", "y", "weight").agg(F.max("text").alias("text"))


def bounded(features: DataFrame, most_bytes: int = MOST_BYTES) -> DataFrame:
    """The rows of a training sample (doc_id, y, size in bytes, features), in hash order within each label, up to half of most_bytes for each.

    One running sum over the ids and sizes of the sample, whose rows are bounded
    already. A row that would pass the bound, and all after it, are left out.
    """
    rows = materialize(features)
    order = Window.partitionBy("y").orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    taken = rows.select("doc_id", "y", F.sum("size").over(order).alias("__upto")).where(F.col("__upto") <= most_bytes // 2)
    return rows.join(F.broadcast(taken), ["doc_id", "y"], "left_semi")


def bucket(word: str, bits: int) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) >> (32 - bits)
