"""The registered queries over whole small tables: against their SQL twins, or against brute force."""

import hashlib
import math
import sys
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest
import xxhash

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from dqlake.llm import registry  # noqa: E402

SF = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in SF.glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


@pytest.fixture(scope="module")
def texts(duck):
    return dict(duck.execute("SELECT doc_id, text FROM documents").fetchall())


def value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted((tuple(value(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_sql_twins(spark, duck, name):
    df = registry.QUERIES[name](spark, str(SF))
    got = table(df.columns, df.collect())
    rel = duck.execute(registry.ORACLE_SQL[name])
    assert got == table([d[0] for d in rel.description], rel.fetchall())


def test_every_operator_has_one_query():
    assert sorted(int(n.split("_")[0][2:]) for n in registry.QUERIES) == list(range(1, 14))


def test_op1_gives_every_text_back(spark, texts):
    rows = registry.QUERIES["op1_sentencepiece"](spark, str(SF)).collect()
    assert len(rows) == len(texts) and all(r.lossless for r in rows)
    assert {r.doc_id: r.decoded_sha256 for r in rows} == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in texts.items()}


def brute_repeats(docs, width=50):
    seen, out = {}, {}
    for i, text in sorted(docs.items()):
        data = (text or "").encode()
        gone, new = bytearray(len(data)), set()
        for s in range(len(data) - width + 1):
            w = data[s:s + width]
            if w in seen:
                gone[s:s + width] = b"\1" * width
            else:
                new.add(w)
        for w in new:
            seen[w] = i
        spans = sum(1 for j in range(len(gone)) if gone[j] and (not j or not gone[j - 1]))
        kept = bytes(c for c, g in zip(data, gone) if not g)
        out[i] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def test_op4_removes_what_brute_force_removes(spark, texts):
    rows = registry.QUERIES["op4_suffix_dedup"](spark, str(SF)).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == brute_repeats(texts)


def roots(ids, links):
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    return {i: find(i) for i in ids}


def brute_fingerprint(text):
    words = text.encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_op9_components_by_brute_force(spark, texts):
    fps = {i: brute_fingerprint(t) for i, t in texts.items()}
    ids = sorted(fps)
    want = roots(ids, [(a, b) for a in ids for b in ids if a < b and (fps[a] ^ fps[b]).bit_count() <= 3])
    rows = registry.QUERIES["op9_simhash"](spark, str(SF)).collect()
    assert {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in rows} == {i: (fps[i], want[i]) for i in ids}


def test_op10_links_by_brute_force(spark, duck):
    rows = duck.execute("SELECT vec_id, embedding, label FROM embeddings").fetchall()
    ids, label = np.array([r[0] for r in rows]), np.array([r[2] for r in rows])
    x = np.array([r[1] for r in rows], dtype=float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = (x @ x.T >= 0.98) & (label[:, None] == label[None, :]) & ~np.eye(len(x), dtype=bool)
    want = roots(ids.tolist(), [(int(ids[a]), int(ids[b])) for a, b in zip(*np.nonzero(near))])
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in registry.QUERIES["op10_hnsw"](spark, str(SF)).collect()}
    assert got == {int(i): (int(n), want[int(i)], want[int(i)] == i) for i, n in zip(ids, near.sum(axis=1))}


@pytest.mark.parametrize("name, modulus, out", [("op3_toxicity", 4, 2), ("op7_quality", 5, 0)])
def test_scores_cover_all_documents(spark, texts, name, modulus, out):
    import zlib

    rows = registry.QUERIES[name](spark, str(SF)).collect()
    assert {r.doc_id: r.held_out for r in rows} == {i: zlib.crc32(str(i).encode()) % modulus == out for i in texts}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_the_pipeline_stage_by_stage(spark):
    """Each stage on what its predecessor kept: columns, and its effect by a plain reckoning."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    before = {r.doc_id: r for r in docs.collect()}
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, str(SF)).toArrow())
        rows = docs.collect()
        if name == "toxicity":
            assert {r.doc_id for r in rows} <= set(before) and len(rows) >= 0.8 * len(before)
        if name == "line dedup":
            keys = Counter(k for r in kept.values() for k in {line_key(x) for x in r.text.split("\n")} if len(k) >= 20)
            last = {}
            for r in kept.values():
                for x in r.text.split("\n"):
                    last[line_key(x)] = max(last.get(line_key(x), -1), r.doc_id)
            for r in rows:
                want = [x for x in kept[r.doc_id].text.split("\n") if not (keys[line_key(x)] >= 3 and last[line_key(x)] != r.doc_id)]
                assert r.text == "\n".join(want) and r.n_chars == len(r.text)
        if name == "near-dedup":
            ids = sorted(kept)
            shingles = {i: shingle_set(kept[i].text) for i in ids}
            stay = {r.doc_id for r in rows}
            group = {i: [j for j in ids if len(shingles[i] & shingles[j]) >= 0.9 * len(shingles[i] | shingles[j])] for i in ids}
            assert all(i in stay or any(j < i for j in ids if len(shingles[i] & shingles[j]) >= 0.5 * len(shingles[i] | shingles[j])) for i in ids)
            assert all(len([j for j in group[i] if j in stay]) <= 1 for i in ids)
        if name == "mixing":
            per = Counter(r.source for r in rows)
            sources = Counter(r.source for r in kept.values())
            expected = len(kept) / len(sources)
            assert set(per) <= set(sources) and all(abs(n - expected) <= 6 * expected ** 0.5 for n in per.values())
        if name == "pieces":
            from dqlake.llm.pieces import decode

            assert docs.columns == [*columns, "ids"]
            texts = {r.doc_id: r.text for r in kept_rows}
            assert all(r.back == texts[r.doc_id] for r in decode(docs, text_col="back").collect())
        else:
            assert docs.columns == columns
        kept, kept_rows = {r.doc_id: r for r in rows}, rows


def line_key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


def shingle_set(text):
    words = text.encode().lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}
