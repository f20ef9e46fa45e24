"""What the near-dedup stage writes halfway stays in proportion to the documents."""

import numpy as np
import pyarrow as pa

from dqlake.llm import simhash


def shared_shingles(n):
    """Texts in pairs that share a rare passage of nine words and nothing else; they are not similar."""
    return [(i, " ".join([f"p{i // 2}x{k}" for k in range(9)] + [f"t{i}x{k}" for k in range(16)])) for i in range(n)]


def test_halfway_tables_hold_a_fraction_of_the_entries(spark, monkeypatch):
    made, n = [], 120
    write = simhash.stage

    def stage(df, label):
        out = write(df, label)
        made.append((label, out.columns, out.count()))
        return out

    monkeypatch.setattr(simhash, "stage", stage)
    rows = shared_shingles(n) + [(n, shared_shingles(1)[0][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.similar_documents(docs).collect()}
    assert got == {i: i for i in range(n)} | {n: 0}
    # a fingerprint was stored for each of 41 partitions once, and the sets of all that share a shingle
    assert max(rows for _, columns, rows in made if "fp" in columns) <= 12 * n
    assert sum(rows for label, _, rows in made if label == "link-sets") <= n // 10


def test_rounds_hold_all_partitions_once():
    assert simhash.rounds([3, 3, 3, 9, 1, 1], 6) == [[0, 1], [2], [3], [4, 5]]
    assert simhash.rounds([0, 0], 0) == [[0, 1]]


def test_rounds_lose_no_link(spark, monkeypatch):
    r = np.random.default_rng(3)
    base = r.integers(0, 2**63, 12, dtype=np.uint64)
    fps = sorted({int(b) ^ sum(1 << int(x) for x in r.choice(64, r.integers(0, 5), replace=False)) for b in base for _ in range(20)})
    nodes = spark.createDataFrame([(i, bytearray(f.to_bytes(8, "big"))) for i, f in enumerate(fps)], "node long, fp binary")
    from dqlake.llm.graph import components

    from test_llm_queries import roots

    want = roots(range(len(fps)), [(a, b) for a in range(len(fps)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 3])
    for size in (1, 100, 10**6):
        monkeypatch.setattr(simhash, "ROUND", size)
        tree = {x.node: x.component for x in components(simhash.links(nodes, 64, 3, 4, 3, 3, 7)).collect()}
        assert {i: tree.get(i, i) for i in want} == want


def test_parities_rule_out_no_similar_pair():
    r, rows, alike = np.random.default_rng(1), [], []
    for _ in range(400):
        n, m = int(r.integers(1, 300)), int(r.integers(0, 60))
        a = np.unique(r.integers(0, 2**63, n, dtype=np.uint64))
        b = np.unique(np.r_[a[:max(1, len(a) - m // 2)], r.integers(0, 2**63, m, dtype=np.uint64)])
        both = len(np.intersect1d(a, b))
        alike.append(both / (len(a) + len(b) - both))
        rows.append((len(rows), -len(rows), len(a), len(b), simhash.parities(a), simhash.parities(b)))
    names = ["a", "b", "a_size", "b_size", "a_bits", "b_bits"]
    batch = pa.RecordBatch.from_pylist([dict(zip(names, x, strict=True)) for x in rows])
    (kept,) = simhash.may_be_similar(0.8)(iter([batch]))
    kept = set(kept.column("a").to_pylist())
    assert {i for i, j in enumerate(alike) if j >= 0.8 - 1e-9} <= kept
    assert sum(j < 0.5 for j in alike) > 50 and not kept & {i for i, (j, x) in enumerate(zip(alike, rows, strict=True)) if j < 0.5 and x[2] > 40}
