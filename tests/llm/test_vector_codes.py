"""Operator 13 against a plain version, on ties, nulls, non-finite and unequal vectors, repeated rows."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, entries=256, rounds=4):
    whole = lambda v: [int(np.floor(1024 * float(np.float32(x)))) for x in v]
    kept = [(i, whole(v), lab) for i, v, lab in rows if v is not None and all(x is not None and np.isfinite(np.float32(x)) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    dim = len(kept[0][1])
    kept = [r for r in kept if len(r[1]) == dim]
    w = dim // 4
    books = [[r[1][p * w : (p + 1) * w] for r in kept[:entries]] for p in range(4)]

    def assign(part, book):
        d = [sum((a - b) ** 2 for a, b in zip(part, c, strict=True)) for c in book]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        for p in range(4):
            groups = {}
            for r in kept:
                part = r[1][p * w : (p + 1) * w]
                groups.setdefault(assign(part, books[p])[0], []).append(part)
            for e, g in groups.items():
                books[p][e] = [sum(c) // len(g) for c in zip(*g, strict=True)]
    out, labels = [], {}
    for i, v, lab in kept:
        found = [assign(v[p * w : (p + 1) * w], books[p]) for p in range(4)]
        out.append((i, "".join(f"{c:02x}" for c, _ in found), sum(e for _, e in found), lab))
        labels[lab] = labels.get(lab, 0) + out[-1][2]
    sha = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return sorted(((i, c, e, labels[lab], sha) for i, c, e, lab in out), key=str)


def made(n, dim, seed):
    rng = random.Random(seed)
    rows = [(i, [rng.choice([-1.0, -0.3, 0.0, 0.25, rng.gauss(0, 1)]) for _ in range(dim)], rng.choice([0, 1, None])) for i in range(n)]
    same = rows[3][1]
    rows += [(1000 + i, same, 2) for i in range(40)]  # one very common vector
    return rows


ODD = [(-1, None, 0), (-2, [1.0, None] * 4, 0), (-3, [float("nan")] * 8, 1), (-4, [float("inf")] * 8, 1), (-5, [float("-inf")] + [0.0] * 7, None), (5000, [0.5] * 4, 1), (5001, [], 1), (None, [0.1] * 8, None), (7, [0.2] * 8, 0), (7, [0.2] * 8, 0)]


@pytest.mark.parametrize("n", [30, 400])
def test_equals_a_plain_version(spark, n):
    rows = made(n, 8, n) + ODD
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"a.b": F.lit(1), "row": F.lit(2), "Code": F.lit("x"), "v": F.lit(1)})
    assert sorted(map(tuple, vector_codes.op13(df.repartition(3)).collect()), key=str) == plain([r for r in rows if r[1] is None or len(r[1]) == 8])


def test_empty_and_odd_lengths(spark):
    df = spark.createDataFrame(ODD[:5], SCHEMA)
    want = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert vector_codes.op13(df).columns == want and vector_codes.op13(df).count() == 0
    assert vector_codes.op13(df.limit(0)).count() == 0
    assert vector_codes.op13(spark.createDataFrame([(1, [0.5] * 6, 1)], SCHEMA)).count() == 0


def test_large_components(spark):
    rows = [(1, [3e38, -3e38, 70000.0, 1.0], 1), (2, [1.0, 2.0, -70000.5, 1.0], 1), (3, [0.0, 0.0, 0.0, 0.0], 1)]
    got = {r.vec_id: r for r in vector_codes.op13(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [got[i].code for i in (1, 2, 3)] == ["00000000", "01010100", "02020202"] and got[1].error == 0  # equal last parts: the lower index


def test_nearest_is_exact():
    rng = np.random.default_rng(1)
    for top in (50, 1 << 26):
        x, book = rng.integers(-top, top, (300, 5)), rng.integers(-top, top, (40, 5))
        book[7] = book[3]
        codes, errors = vector_codes.nearest(x, book)
        d = [[sum((int(a) - int(b)) ** 2 for a, b in zip(r, c, strict=True)) for c in book] for r in x]
        assert codes.tolist() == [r.index(min(r)) for r in d] and errors.tolist() == [min(r) for r in d]
