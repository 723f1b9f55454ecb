"""Vector code compression: product codes from weighted Lloyd rounds over distinct parts (operator 13).

Components become integers, vectors are cut into four parts, and equal parts of
one position become one row with a weight. Lloyd's rounds see these distinct
rows only, and sum in integers, so results are the same in any partitioning.
Each task sends its sums by position and entry; what reaches the driver is the
codebooks, PARTS * ENTRIES rows of a part's length. Codes and errors of the
distinct rows are then joined back to the vectors by common.join_back: a part
that many vectors share is one row on one side, and on the other side is sent
to no single task.

Edge cases: vectors that are null, or hold a null or a non-finite component, are
left out, as are those whose length is not that of the kept vector with the
smallest id, or not a multiple of four. Integer components beyond 2 ** LARGEST
(components from 131,072 on) are held there, so that squared distances fit into
a long. Rows without an id come last in the order of ids; of equal ids the
smaller vector comes first. With fewer than 256 vectors a codebook has as many
entries. Equal rows are coded row by row. An empty table gives no rows. Other
columns don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import join_back, materialize

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Integer components are held within 2 to this power.
LARGEST = 26


def integers(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, label and v, an array of integers, of the vectors that are kept."""
    rows = vectors.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{label}`").alias("label"), F.col(f"`{embedding}`").cast("array<double>").alias("x"))
    bad = F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    most = float(1 << LARGEST)
    whole = F.transform("x", lambda c: F.floor(F.least(F.lit(most), F.greatest(F.lit(-most), c * SCALE))).cast("int"))
    return rows.where(F.col("x").isNotNull() & ~bad).select("vec_id", "label", whole.alias("v"))


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest row of book and its squared distance, for each row of x; the lower index at a tie. Exact.

    Floats hold all sums exactly as long as they stay below 2 ** 53; larger
    components are compared in integers.
    """
    codes, errors = np.empty(len(x), np.int64), np.empty(len(x), np.int64)
    for a in range(0, len(x), 4096):
        block = x[a : a + 4096]
        largest = max(int(np.abs(block).max(initial=0)), int(np.abs(book).max(initial=0)))
        if 4 * largest**2 * max(1, x.shape[1]) < 2**53:
            b, c = block.astype(float), book.astype(float)
            d = (b * b).sum(1)[:, None] - 2 * (b @ c.T) + (c * c).sum(1)
        else:
            d = np.zeros((len(block), len(book)), np.int64)
            for j in range(x.shape[1]):
                d += (block[:, j, None] - book[None, :, j]) ** 2
        best = d.argmin(1)
        codes[a : a + 4096], errors[a : a + 4096] = best, d[np.arange(len(block)), best].astype(np.int64)
    return codes, errors


def _matrix(parts: pd.Series, width: int) -> np.ndarray:
    return np.stack(parts.to_list()).astype(np.int64) if len(parts) and width else np.zeros((len(parts), width), np.int64)


def lloyd(distinct: DataFrame, books: list[np.ndarray], rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebooks (an array of integers for each position) after the rounds over distinct (position, part, n)."""
    spark, width = distinct.sparkSession, books[0].shape[1]
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(books)  # PARTS * ENTRIES rows at most

        def sums(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            books = sent.value
            total = [np.zeros((len(b), width + 1), np.int64) for b in books]
            for batch in batches:
                for p, rows in batch.groupby("position"):
                    x, n = _matrix(rows["part"], width), rows["n"].to_numpy(np.int64)
                    codes, _ = nearest(x, books[p])
                    np.add.at(total[p], codes, np.hstack([x * n[:, None], n[:, None]]))
            for p, t in enumerate(total):
                used = np.flatnonzero(t[:, -1])
                for at in range(width + 1):
                    yield pd.DataFrame({"position": p, "entry": used, "at": at, "total": t[used, at]})

        # Sums over rows that may number billions are added up as decimals.
        found = distinct.mapInPandas(sums, "position int, entry int, at int, total long").groupBy("position", "entry", "at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
        made = {(r.position, r.entry, r["at"]): int(r.total) for r in found.collect()}  # PARTS * ENTRIES * (width + 1) rows at most
        books = [np.array([[made[p, e, j] // made[p, e, width] for j in range(width)] if (p, e, width) in made else b[e] for e in range(len(b))], np.int64).reshape(b.shape) for p, b in enumerate(books)]
        sent.unpersist()
    return books


def digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(int(x)) for b in books for x in b.reshape(-1)).encode()).hexdigest()


def encode(vectors: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """vec_id, label, codes (array of PARTS integers) and error of every kept vector; and the codebooks."""
    kept = integers(vectors)
    order = [F.col("vec_id").asc_nulls_last(), F.col("v")]
    first = kept.select("vec_id", "v").orderBy(*order).limit(1).first()
    dim = len(first.v) if first and len(first.v) % PARTS == 0 else 0
    width = dim // PARTS
    # Row numbers are taken from a written table, so they don't change when a task is run again.
    kept = materialize(kept.where((F.size("v") == dim) & F.lit(dim > 0)).withColumn("row", F.monotonically_increasing_id()))
    starts = [r.v for r in kept.select("vec_id", "v").orderBy(*order).limit(entries).collect()]  # `entries` rows
    if not starts:
        return kept.select("vec_id", "label", F.array(*[F.lit(0)] * PARTS).alias("codes"), F.lit(0).cast("long").alias("error")).limit(0), [np.zeros((0, 0), np.int64)] * PARTS
    whole = np.array(starts, np.int64)
    books = [whole[:, p * width : (p + 1) * width] for p in range(PARTS)]
    parts = kept.select("row", F.posexplode(F.array(*[F.slice("v", p * width + 1, width) for p in range(PARTS)])).alias("position", "part"))
    distinct = materialize(parts.groupBy("position", "part").agg(F.count(F.lit(1)).alias("n")))
    books = lloyd(distinct, books, rounds)
    sent = kept.sparkSession.sparkContext.broadcast(books)

    def final(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch.assign(code=0, err=0)
            for p in batch["position"].unique():
                at = (batch["position"] == p).to_numpy()
                codes, errors = nearest(_matrix(batch.loc[at, "part"], width), sent.value[p])
                batch.loc[at, "code"], batch.loc[at, "err"] = codes, errors
            yield batch[["position", "part", "n", "code", "err"]]

    coded = distinct.mapInPandas(final, "position int, part array<int>, n long, code int, err long")
    joined = join_back(parts, coded, ["position", "part"], "n")
    found = joined.groupBy("row").agg(*[F.max(F.when(F.col("position") == p, F.col("code"))).alias(f"c{p}") for p in range(PARTS)], F.sum("err").alias("error"))
    each = kept.select("row", "vec_id", "label").join(found, "row")
    return each.select("vec_id", "label", F.array(*[f"c{p}" for p in range(PARTS)]).alias("codes"), "error"), books


def op13(vectors: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every kept vector."""
    coded, books = encode(vectors)
    coded = materialize(coded)
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("__rows"))
    code = F.concat(*[F.lpad(F.lower(F.hex(F.col("codes")[p].cast("long"))), 2, "0") for p in range(PARTS)])
    return join_back(coded, sums, ["label"], "__rows").select("vec_id", code.alias("code"), "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _oracle() -> str:
    """The same in DuckDB: every round joins each distinct part with its position's codebook and keeps the nearest entry."""
    sql = f"""WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT row, vec_id, p, v[p * (len(v) // {PARTS}) + 1 : (p + 1) * (len(v) // {PARTS})] AS part FROM kept, (SELECT unnest(range({PARTS})) AS p)
), uniq AS MATERIALIZED (
  SELECT p, part, count(*) AS n FROM parts GROUP BY p, part
), book0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, part AS c FROM parts QUALIFY e < {ENTRIES}
)"""
    near = """SELECT p, part, n, arg_min(e, (d, e)) AS e, min(d) AS d FROM (
    SELECT u.p, u.part, u.n, b.e, CAST(list_sum(list_transform(list_zip(u.part, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d FROM uniq u JOIN {book} b ON u.p = b.p
  ) GROUP BY p, part, n"""
    for k in range(1, ROUNDS + 1):
        sql += f""", near{k} AS MATERIALIZED ({near.format(book=f"book{k - 1}")}
), mean{k} AS MATERIALIZED (
  SELECT p, e, list(m ORDER BY j) AS c FROM (
    SELECT p, e, j, CAST(floor(sum(part[j] * n) / CAST(sum(n) AS DOUBLE)) AS BIGINT) AS m FROM near{k}, (SELECT unnest(range(1, (SELECT max(len(part)) + 1 FROM uniq))) AS j) GROUP BY p, e, j
  ) GROUP BY p, e
), book{k} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM book{k - 1} b LEFT JOIN mean{k} m ON b.p = m.p AND b.e = m.e
)"""
    last = f"book{ROUNDS}"
    return sql + f""", fin AS MATERIALIZED ({near.format(book=last)}
), coded AS (
  SELECT row, string_agg(printf('%02x', f.e), '' ORDER BY f.p) AS code, CAST(sum(f.d) AS BIGINT) AS error FROM parts s JOIN fin f ON s.p = f.p AND s.part = f.part GROUP BY row
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM {last}) AS codebooks_sha256
FROM kept JOIN coded USING (row)"""


ORACLE = _oracle()
