"""Random tokens of one case are found; ordinary ones of the same alphabets are not."""

import random

from plumbline.llm import secrets

KINDS = {"hex32": ("0123456789ABCDEF", 32), "hex40": ("0123456789ABCDEF", 40), "base32": ("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 32)}
KEY = "9233A8ECF7C5B09FE5949719B6B82BC439E9329B"
ORDINARY = [
    "INTERNATIONALISATIONANDLOCALISATION", "THEQUICKBROWNFOXJUMPSOVERTHELAZYDOG", "20240131120000202402011200", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "DEADBEEFDEADBEEFDEADBEEFDEADBEEF", "00000000000000000000FFFF", "CHAPTER2SECTION3PARAGRAPH45OFTHEAGREEMENT", "december2024quarterlyreportfinalversion2",
]


def found(spark, tokens):
    df = spark.createDataFrame([(i, f"x {t} y") for i, t in enumerate(tokens)], "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in secrets.op1(df).collect()}
    return [f"random:2:{2 + len(t)}" in spans[i] for i, t in enumerate(tokens)]


def test_random_tokens_of_one_case(spark):
    rng = random.Random(3)
    tokens = {k: ["".join(rng.choice(a) for _ in range(n)) for _ in range(100)] for k, (a, n) in KINDS.items()}
    flat = [t for g in tokens.values() for t in g]
    got = found(spark, [*flat, KEY, *ORDINARY])
    for k, name in enumerate(tokens):
        assert sum(got[100 * k : 100 * k + 100]) >= 90, name
    assert got[300] and not any(got[301:])


def test_ordinary_tokens_alone(spark):
    assert not any(found(spark, ORDINARY))
