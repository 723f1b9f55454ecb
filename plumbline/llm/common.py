"""Pieces that several operators share: table access, scratch tables and column helpers."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.sources.scratch import delete, materialize, new_path, tidy

__all__ = ["WORD", "bucket_order", "bucketed", "join_back", "joined", "let", "materialize", "quoted", "table", "text_of"]

#: A word: any run of characters without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(column: str) -> str:
    """A column's name as it is written in expressions, whatever is in it."""
    return "`" + column.replace("`", "``") + "`"


def let(value: Column, body) -> Column:
    """body(value), with value evaluated once a row even if body uses it inside lambdas."""
    return F.transform(F.array(value), body)[0]


def text_of(df: DataFrame, column: str = "text") -> Column:
    """The text, a null one as the empty text."""
    return F.coalesce(df[column].cast("string"), F.lit(""))


def joined(spans: Column, kinds: tuple[str, ...]) -> Column:
    """kind:start:end of spans by start, then kind as listed, comma-joined."""
    rank = lambda s: F.array_position(F.array(*[F.lit(k) for k in kinds]), s["kind"]).cast("int")
    ordered = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), rank(s).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


@contextmanager
def bucket_order(spark: SparkSession) -> Iterator[None]:
    """Plans made inside take buckets of one file each as sorted, as bucketed() writes them."""
    key = "spark.sql.legacy.bucketedTableScan.outputOrdering"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def bucketed(df: DataFrame, key: str) -> tuple[DataFrame, Callable[[], None]]:
    """df written once to the shared folder, bucketed and sorted by key, so that later joins and groupings by key read it in place.

    Also returns a function that drops the table and its files.
    """
    spark = df.sparkSession
    name = f"plumbline_{uuid.uuid4().hex}"
    path = new_path(spark, name)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with tidy(spark):
        df.write.format("parquet").option("parquet.dictionary.page.size", str(8 << 20)).bucketBy(n, key).sortBy(key).option("path", path).saveAsTable(name)

    def drop() -> None:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        delete(spark, path)

    return spark.table(name), drop


#: A key that holds more than one row in so many is joined on its own; there can be no more such keys than this.
HOT_SHARE = 2048


def join_back(rows: DataFrame, groups: DataFrame, keys: list[str], weight: str) -> DataFrame:
    """rows left-joined with groups on keys (nulls equal), without the column weight: how many of the rows each group stands for.

    The groups of more than one row in HOT_SHARE, at most HOT_SHARE of them, are
    sent to every task; no task gets all rows of such a key. The others are
    joined by a shuffle, in which no key has more than that share.
    """
    stored = materialize(groups)
    total = stored.agg(F.sum(weight)).first()[0] or 0
    at = [f"__key{i}" for i in range(len(keys))]
    renamed = stored.select(*[F.col(k).alias(a) for k, a in zip(keys, at, strict=True)], *[c for c in stored.columns if c not in keys])
    made = [c for c in stored.columns if c not in keys and c != weight]
    hot = renamed.where(F.col(weight) * HOT_SHARE > F.lit(total).cast("long")).drop(weight)
    rest = renamed.where(F.col(weight) * HOT_SHARE <= F.lit(total).cast("long")).drop(weight)
    on = lambda g: [rows[k].eqNullSafe(g[a]) for k, a in zip(keys, at, strict=True)]
    marked = rows.join(F.broadcast(hot.withColumn("__hot", F.lit(True))), on(hot), "left").drop(*at)  # HOT_SHARE rows at most
    done = marked.where("__hot").drop("__hot")
    others = marked.where("__hot IS NULL").drop("__hot", *made)
    on = [F.col(k).eqNullSafe(F.col(a)) for k, a in zip(keys, at, strict=True)]
    return done.unionByName(others.join(rest, on, "left").drop(*at))
