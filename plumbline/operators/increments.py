"""Group aggregates that grow by increments: a new day's reviews never make the old ones be read again.

Each increment is aggregated once, to a run: a table of keys with a count, and
for ratings a count, a mean and a sum of squared deviations. Runs are merged
pairwise (Chan's formula), so counts are exact and moments keep their digits
however many increments there are. Runs of one level are merged into one of the
next as soon as there are `fan`, so a key's row is written some log(increments)
times, and a lookup meets few runs.

A manifest names the runs that count. It is written last, under a new number, so
a job that dies leaves the state as it was, and adding an increment of a known
name again changes nothing.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.features import KINDS, group_windows, hashes
from plumbline.sources import io
from plumbline.sources.scratch import delete, move, tidy

MOMENTS = "struct<m:bigint,mean:double,m2:double>"


def partial(df: DataFrame, kind: str) -> DataFrame:
    """The keys of a kind with n, and of ratings r: how many, their mean and their sum of squared deviations."""
    key = KINDS[kind]
    rows = df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key]))
    if kind == "copies":
        return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    x = F.col("rating").cast("double") if "rating" in df.columns else F.lit(None).cast("double")
    moments = F.struct(F.count(x).alias("m"), F.coalesce(F.avg(x), F.lit(0.0)).alias("mean"), F.coalesce(F.var_pop(x) * F.count(x), F.lit(0.0)).alias("m2"))
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), moments.cast(MOMENTS).alias("r"))


def _add(a: Column, b: Column) -> Column:
    """The moments of two sets of numbers together."""
    m, delta = a["m"] + b["m"], b["mean"] - a["mean"]
    share = F.when(m > 0, b["m"] / m).otherwise(F.lit(0.0))
    return F.struct(m.alias("m"), (a["mean"] + delta * share).alias("mean"), (a["m2"] + b["m2"] + delta * delta * a["m"] * share).alias("m2")).cast(MOMENTS)


def merged(runs: list[DataFrame], kind: str) -> DataFrame:
    """One run for several; of each run a key has one row, so what is gathered for a key is bounded by their number."""
    if len(runs) == 1:
        return runs[0]
    numbered = reduce(DataFrame.unionByName, [r.withColumn("run", F.lit(i)) for i, r in enumerate(runs)])
    total = F.sum("n").alias("n")
    if kind == "copies":
        return numbered.groupBy(*KINDS[kind]).agg(total)
    rows = F.sort_array(F.collect_list(F.struct("run", "r")))  # in the order of runs, so sums don't depend on partitions
    zero = F.struct(F.lit(0).cast("bigint").alias("m"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2")).cast(MOMENTS)
    return numbered.groupBy(*KINDS[kind]).agg(total, rows.alias("rows")).select(*KINDS[kind], "n", F.aggregate("rows", zero, lambda acc, x: _add(acc, x["r"])).alias("r"))


@dataclass
class Book:
    """The state under a folder."""

    spark: SparkSession
    root: str
    fan: int = 8

    def manifest(self) -> dict:
        numbers = sorted(int(p.rsplit("-", 1)[1].split(".")[0]) for p in io.expand(self.spark, f"{self.root}/manifest-*.json"))
        return io.read_document(self.spark, f"{self.root}/manifest-{numbers[-1]:09d}.json") if numbers else {"number": 0, "added": [], "runs": {k: [] for k in KINDS}}

    def _write(self, df: DataFrame, kind: str, level: int) -> dict:
        path = f"{self.root}/{kind}-{level}-{uuid.uuid4().hex}"
        with tidy(self.spark):
            df.write.parquet(path)
        return {"level": level, "path": path}

    def _run(self, run: dict) -> DataFrame:
        return self.spark.read.parquet(run["path"])

    def add(self, reviews: DataFrame, name: str) -> bool:
        """Adds an increment; False if one of this name is there already."""
        book = self.manifest()
        if name in book["added"]:
            return False
        if "text" in reviews.columns:
            reviews = reviews.withColumns(hashes(F.col("text")))
        for kind, key in KINDS.items():
            if all(c in reviews.columns for c in key):
                runs = [*book["runs"][kind], self._write(partial(reviews, kind), kind, 0)]
                level = 0
                while len(same := [r for r in runs if r["level"] == level]) >= self.fan:
                    runs = [r for r in runs if r["level"] != level] + [self._write(merged([self._run(r) for r in same], kind), kind, level + 1)]
                    level += 1
                book["runs"][kind] = runs
        book |= {"number": book["number"] + 1, "added": [*book["added"], name]}
        # Under another name first, so that a manifest is whole as soon as there is one.
        draft = io.write_document(self.spark, book, f"{self.root}/draft-{uuid.uuid4().hex}.json")
        move(self.spark, draft, f"{self.root}/manifest-{book['number']:09d}.json")
        return True

    def totals(self, kind: str, keys: DataFrame | None = None) -> DataFrame | None:
        """The aggregates of a kind over all increments: keys, n, mean and std; keys: only those, each run being cut to them before runs are merged."""
        runs = [self._run(r) for r in self.manifest()["runs"][kind]]
        if not runs:
            return None
        if keys is not None:
            wanted = keys.select(*KINDS[kind]).distinct()
            runs = [r.join(wanted, list(KINDS[kind]), "left_semi") for r in runs]
        out = merged(runs, kind)
        if kind == "copies":
            return out
        m = F.col("r.m")
        return out.select(*KINDS[kind], "n", F.when(m > 0, F.col("r.mean")).alias("mean"), F.when(m > 1, F.sqrt(F.col("r.m2") / (m - 1))).alias("std"))

    def windows(self, reviews: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
        """group_windows of reviews over all that was added; of those in no increment the copies count 1, the others are null."""
        def totals(df: DataFrame, kind: str) -> DataFrame:
            found = self.totals(kind, df)
            if found is None:
                found = partial(df.limit(0), kind).select(*KINDS[kind], "n", F.lit(None).cast("double").alias("mean"), F.lit(None).cast("double").alias("std"))
            return found

        return group_windows(reviews, totals)

    def vacuum(self) -> int:
        """Deletes runs that the newest manifest doesn't name, and older manifests; for when no reader is left on them. How many folders went."""
        book = self.manifest()
        keep = {r["path"].rsplit("/", 1)[1] for runs in book["runs"].values() for r in runs} | {f"manifest-{book['number']:09d}.json"}
        gone = [p for p in io.expand(self.spark, f"{self.root}/*") if p.rsplit("/", 1)[1] not in keep]
        for p in gone:
            delete(self.spark, p)
        return len(gone)
