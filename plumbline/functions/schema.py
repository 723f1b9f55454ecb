"""Canonical schemas, typed defaults for optional columns, and views of tables as reviews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

REVIEW = T.StructType([
    T.StructField("gmap_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("time", T.LongType()),
    T.StructField("rating", T.IntegerType()),
    T.StructField("text", T.StringType()),
    T.StructField("pics", T.ArrayType(T.StructType([T.StructField("url", T.ArrayType(T.StringType()))]))),
    T.StructField("resp", T.StructType([T.StructField("time", T.LongType()), T.StructField("text", T.StringType())])),
    T.StructField("region", T.StringType()),
])
BINARY = ("ads_promo", "spam_low_quality", "irrelevant", "rant_no_visit")
CONTINUOUS = ("relevancy_score", "visit_likelihood")
#: The order in which labelling writes the scores.
SCORES = ("ads_promo", "irrelevant", "rant_no_visit", "spam_low_quality", "relevancy_score", "visit_likelihood")
SILVER = T.StructType([T.StructField("review_id", T.StringType())] + [T.StructField(c, T.DoubleType()) for c in SCORES])


def with_defaults(df: DataFrame, schema: T.StructType = REVIEW) -> DataFrame:
    """df with each column of the schema that it lacks, as typed nulls."""
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in df.columns})


def nan_to_null(df: DataFrame) -> DataFrame:
    """Null instead of NaN in float columns: NaN compares as the largest value, null as unknown."""
    return df.withColumns({c: F.nullif(F.col(f"`{c}`"), F.lit(float("nan")).cast(t)) for c, t in df.dtypes if t in ("double", "float")})


def require(df: DataFrame, columns) -> None:
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def documents_as_reviews(docs: DataFrame) -> DataFrame:
    """The documents table in the role of reviews: a source is a place, a language a category."""
    n = F.col("doc_id")
    return docs.select(
        n.cast("string").alias("review_id"),
        F.col("source").alias("gmap_id"),
        (n % 97).cast("string").alias("user_id"),
        (F.lit(1483228800) + n * 86400).cast("long").alias("time"),
        (1 + n % 5).cast("int").alias("rating"),
        "text",
        F.col("lang").alias("category"),
    )


def orders_as_reviews(orders: DataFrame) -> DataFrame:
    """The orders table in the role of a pool to sample: customers are places."""
    return orders.select(
        F.col("o_orderkey").cast("string").alias("review_id"),
        F.col("o_custkey").cast("string").alias("gmap_id"),
        (F.col("o_orderkey") % 997).cast("string").alias("user_id"),
        F.unix_timestamp("o_orderdate").alias("time"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("rating"),
        F.element_at(F.create_map(F.lit("O"), F.lit("short"), F.lit("F"), F.lit("medium"), F.lit("P"), F.lit("long")), F.col("o_orderstatus")).alias("length_bucket"),
    )


def safe_text(c: Column) -> Column:
    """A value as text; a null reads "None", as the reference has it."""
    return F.coalesce(c.cast("string"), F.lit("None"))


def let(value: Column, body) -> Column:
    """body(value), with value evaluated once a row."""
    return F.transform(F.array(value), body)[0]
