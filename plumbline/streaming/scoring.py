"""Rule scoring on a stream of reviews. An extension: the batch stages that need no group work unchanged on streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.fields import epoch_seconds
from plumbline.operators import features, rules

#: Group windows and whole-table samples need all rows, so they have no streaming form.
STATELESS = tuple(g for g in features.GROUPS if g != "aggregates")


def read(spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "json", per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).format(fmt).load(folder)


def score(stream: DataFrame, as_of: float) -> DataFrame:
    """Features and rule scores of each review as it comes."""
    return rules.rules(features.features(stream, as_of, groups=STATELESS))


def flagged_counts(stream: DataFrame, as_of: float, window: str = "1 day", late: str = "2 days") -> DataFrame:
    """Flagged reviews by place and event-time window; rows later than the watermark are left out."""
    scored = score(stream, as_of).withColumn("ts", F.timestamp_seconds(epoch_seconds(F.col("time"))))
    flags = [F.sum(F.col(f"rule_{k}_strong").cast("long")).alias(k) for k in rules.STRONG]
    return scored.withWatermark("ts", late).groupBy(F.window("ts", window), "gmap_id").agg(F.count(F.lit(1)).alias("n"), *flags)


def write(df: DataFrame, folder: str, checkpoint: str, mode: str = "append", trigger: str | None = None):
    """A Parquet sink that survives restarts from its checkpoint; without a trigger interval it takes what there is and stops."""
    w = df.writeStream.format("parquet").outputMode(mode).option("path", folder).option("checkpointLocation", checkpoint)
    return (w.trigger(processingTime=trigger) if trigger else w.trigger(availableNow=True)).start()
