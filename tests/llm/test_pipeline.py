"""corpus_pipeline.run against plain versions of its stages, one after the other."""

import brute
import duckdb

import corpus_pipeline
from plumbline.llm import quality_rules

SF = "/root/testdata/sf0.001"


def test_all_stages(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    good = {r[0] for r in con.execute(f"SELECT doc_id FROM ({quality_rules.ORACLE}) WHERE kept").fetchall()}
    docs = sorted((r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if r.doc_id in good)
    gone = brute.removed_lines([(d, t) for d, t, _ in docs])
    docs = [(d, "\n".join(x for i, x in enumerate(t.split("\n")) if i not in set(gone[k])), s) for k, (d, t, s) in enumerate(docs)]
    least = brute.components([(d, brute.fingerprint(t)) for d, t, _ in docs], lambda a, b: (a ^ b).bit_count() <= 3)
    docs = [x for x, c in zip(docs, least, strict=True) if x[0] == c]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = {r[0] for r in brute.contaminated([(d, t) for d, t, _ in docs], items) if r[5]}
    docs = [x for x in docs if x[0] not in bad]
    sizes = {}
    for _, t, s in docs:
        sizes[s] = sizes.get(s, 0) + brute.size(t)
    target = brute.targets(sizes)
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r.doc_id, r.source, r.size, r.source_size) for r in got) == [(d, s, brute.size(t), sizes[s]) for d, t, s in docs]
    taken = {}
    for r in got:
        assert abs(r.target - target[r.source]) < 1e-6 * target[r.source] and 0 <= r.taken <= 2 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(abs(taken[s] - target[s]) <= 1 for s in sizes)
    assert 0 < len(docs) < 200 and bad and any(gone.values())
