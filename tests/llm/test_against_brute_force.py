"""Each operator against a plain version, over a driver table."""

import brute
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text, r.source) for r in docs.collect()]


def test_secrets(docs, rows):
    from plumbline.llm import secrets

    got = {r.doc_id: r for r in secrets.op1(docs).collect()}
    assert len(got) == len(rows)
    for d, t, _ in rows:
        spans = brute.secrets(t)
        assert got[d].base_sha256 == brute.digest(spans)
        assert (got[d].n_assign, got[d].n_access, got[d].n_hex) == tuple(sum(s[3] == k for s in spans) for k in ("assign", "access", "hex"))


def test_pii(docs, rows):
    from plumbline.llm import pii

    got = {r.doc_id: r for r in pii.op3(docs).collect()}
    for d, t, _ in rows:
        spans = brute.private(t)
        assert got[d].base_sha256 == brute.digest(spans)
        assert (got[d].n_email, got[d].n_ip, got[d].n_card, got[d].n_phone) == tuple(sum(s[3] == k for s in spans) for k in ("email", "ip", "card", "phone"))


def test_decontamination(spark, docs, rows):
    from plumbline.llm import decontamination

    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    want = brute.contaminated([(d, t) for d, t, _ in rows], [(r.item_id, r.text) for r in bench.collect()])
    got = decontamination.op5(docs, bench).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert any(w[5] for w in want)


def test_decontamination_in_blocks(spark, docs, monkeypatch):
    from plumbline.llm import decontamination

    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    one = sorted(map(tuple, decontamination.op5(docs, bench).collect()))
    monkeypatch.setattr(decontamination.item_blocks, "__defaults__", (1500,))
    assert sorted(map(tuple, decontamination.op5(docs, bench).collect())) == one


def test_mixing(docs, rows):
    from plumbline.llm import mixing

    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + brute.size(t)
    want = brute.targets(sizes)
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    taken = {}
    for r in got:
        assert abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source]) and r.source_size == sizes[r.source]
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, n in taken.items():
        assert abs(n - want[s]) <= 1
    assert sorted(map(tuple, mixing.mix(docs).collect())) == sorted(map(tuple, got))


def test_simhash(docs, rows):
    from plumbline.llm import simhash

    fps = [(d, brute.fingerprint(t)) for d, t, _ in rows]
    least = brute.components(fps, lambda a, b: (a ^ b).bit_count() <= 3)
    want = {(d, f"{fp:016x}", c) for (d, fp), c in zip(fps, least, strict=True)}
    assert set(map(tuple, simhash.op9(docs).select("doc_id", "fingerprint", "component_id").collect())) == want


def test_line_dedup(docs, rows):
    from plumbline.llm import line_dedup

    rows = sorted((d, t) for d, t, _ in rows)
    want = brute.removed_lines(rows)
    got = {r.doc_id: r for r in line_dedup.op10(docs).collect()}
    for k, (d, t) in enumerate(rows):
        assert got[d].n_lines == len(t.split("\n"))
        assert got[d].removed_lines == ",".join(map(str, want[k]))
    assert sum(map(len, want.values())) > 0
