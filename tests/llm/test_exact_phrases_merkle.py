"""Exact dedup, phrase mining and the Merkle manifest against brute force: odd rows, forced collisions, many passes, small trees."""

import hashlib
import zlib
from collections import Counter
from itertools import pairwise
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dqlake.llm import exact, fuse, merkle, phrases

LONG = "lorem ipsum dolor " * 20_000
ODD = [(1, "a b  c"), (2, None), (3, ""), (None, "a b c"), (4, LONG), (4, LONG), (5, " \n \t"), (6, "\x00▁ é😀\n"), (7, " "), (None, "only"), (None, "only"), (8, "a\nb c"), (-9, "a b c")]
WIDE = "doc_id long, text string, lang string, source string, n_chars long, digest string, tree int, rank string, n string, _part int, _first string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s" if k % 3 else None, k, "d", 1, "r", "n", 0, "f") for k, (i, t) in enumerate(ODD)]
    return spark.createDataFrame(rows, WIDE).repartition(3)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 40, 2048, 30_000])
def test_fuse_filters_hold_their_keys_and_let_few_others_through(n):
    r = np.random.default_rng(n)
    keys, others = r.integers(0, 2**63, n).astype(np.uint64), r.integers(2**63, 2**64 - 1, 20_000, dtype=np.uint64)
    built = fuse.build(np.concatenate([keys, keys[: n // 2]]))
    assert fuse.contains(built, keys).all() and fuse.contains(built, others).mean() < 0.01
    assert len(built) <= 1.6 * n + 64


def brute_equal(rows):
    import re

    texts = [re.sub(r"[\x20\x09-\x0d]+", " ", t or "") for _, t in rows]
    groups = {}
    for (i, _), t in zip(rows, texts):
        groups.setdefault(t, []).append(i)
    keep = {t: min((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return Counter((i, keep[t], len(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for (i, _), t in zip(rows, texts)), len(groups)


def weak(text):
    """A digest that most texts share, so that only their bytes tell them apart."""
    return exact.md5(F.substring(text, 1, 1))


@pytest.mark.parametrize("digest", [exact.md5, weak])
def test_exact_dedup_of_odd_rows(docs, digest):
    rows = exact.equal_texts(docs, digest=digest, bucket=2).collect()
    want, groups = brute_equal(ODD)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows) == want
    kept = [r for r in rows if r.kept]
    assert len(kept) == groups == len({r.text_sha256 for r in kept}) and all(r.doc_id == r.keep_id for r in kept)
    assert exact.equal_texts(docs.limit(0)).count() == 0


def test_exact_dedup_over_many_batches_with_a_hot_text(spark):
    rows = [(i, "the same text" if i % 3 == 0 else f"text {i % 40}") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want, _ = brute_equal(rows)
    for batches in (1, 5):
        got = exact.equal_texts(df, batches=batches, bucket=8, digest=weak).collect()
        assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want and sum(r.kept for r in got) == 41


def test_screen_keeps_every_stored_digest(spark):
    old = spark.range(3000).select(F.col("id"), exact.md5(F.col("id").cast("string")).alias("digest"), F.col("id").cast("string").alias("text"))
    snapshot, known = exact.ingest(old, [], bucket=100)
    assert known.count() == 0 and snapshot.buckets == 30
    asked = spark.range(2000, 12_000).select(exact.md5(F.col("id").cast("string")).alias("digest"), F.col("id").alias("entry"))
    hits = {r.entry for r in exact.screen(asked, snapshot).collect()}
    assert set(range(2000, 3000)) <= hits and len(hits) < 1200


def brute_phrases(rows, min_count, longest=5):
    import re

    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            f.update((lang, tuple(words[i:i + k])) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    often = {p: c for p, c in f.items() if c >= min_count}
    out = {}
    for (lang, w), a in often.items():
        if len(w) < 2:
            continue
        inside = any(len(v) > len(w) and m == lang and c >= a and any(v[i:i + len(w)] == w for i in range(len(v))) for (m, v), c in often.items())
        if inside:
            continue
        score, _, left, right = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right))
    return {(lang, r + 1, p.decode(), -a, left, right, n[lang], -s) for lang, found in out.items() for r, (s, a, p, left, right) in enumerate(sorted(found))}


@pytest.mark.parametrize("bits, sample, chunk", [(26, 8, 10**6), (15, 1, 10**6), (16, 5, 50), (18, 10**6, 200)])
def test_phrases_by_brute_force(spark, monkeypatch, bits, sample, chunk):
    """A full bitmap, a sample of everything and one of nothing: the counts stay exact."""
    monkeypatch.setattr(phrases, "CHUNK", chunk)
    monkeypatch.setattr(phrases, "SLICE", 64)
    r = np.random.default_rng(3)
    rows = [(None if i % 7 == 0 else "en" if i % 3 else "", " ".join(np.array(["Of", "THE", "a", "é", "thé,", "b.", "x\n", "\t", "zz", "\x1c"])[r.zipf(1.4, 60) % 10])) for i in range(60)]
    rows += [("en", None), ("en", ""), (None, " \n.;"), ("en", "aa " * 300), ("en", "one two three four five six\r")] + [("en", "one two three four five six")] * 9
    df = spark.createDataFrame([(*x, 1, "k") for x in rows], "lang string, text string, k int, phrase string").repartition(4)
    got = [tuple(x) for x in phrases.collocations(df, min_count=5, sample=sample, bits=bits).collect()]
    assert set(got) == brute_phrases(rows, 5) and len(got) == len(set(got))
    assert phrases.collocations(df.limit(0)).count() == 0


@pytest.mark.parametrize("held, once", [(10**6, True), (6, False)])
def test_a_task_passes_a_phrase_on_once_for_all_its_chunks(monkeypatch, held, once):
    """The rows of the pass over texts follow the distinct phrases of a task, not its chunks; beyond the limit they stay exact."""
    monkeypatch.setattr(phrases, "CHUNK", 20)
    monkeypatch.setattr(phrases, "HELD", held, raising=False)
    sent = SimpleNamespace(value=b"\xff" * 64)
    docs = SimpleNamespace(sparkSession=SimpleNamespace(sparkContext=SimpleNamespace(broadcast=lambda _: sent)), mapInArrow=lambda run, _: made.append(run) or docs)
    docs.groupBy = lambda *_: SimpleNamespace(agg=lambda _: None)
    made, texts = [], ["A b c. a b d", "a b c", "", "é a b c"]
    monkeypatch.setattr(phrases.F, "sum", lambda _: SimpleNamespace(alias=lambda _: None))
    phrases.count_texts(docs, sent.value, 5)
    batch = pa.RecordBatch.from_pydict({"lang": ["en", "de", "en", "en"], "text": texts})
    rows = [tuple(r.values()) for b in made[0](iter([batch] * 30)) for r in b.to_pylist()]
    want = Counter()
    for lang, pieces in [("en", ["a b c", "a b d"]), ("de", ["a b c"]), ("en", ["é a b c"])]:
        for w in map(str.split, pieces):
            want[lang, 0, ""] += 30 * len(w)
            for k in range(1, 6):
                for i in range(len(w) - k + 1):
                    want[lang, k, " ".join(w[i:i + k])] += 30
    got = Counter()
    for lang, k, phrase, f in rows:
        got[lang, k, phrase] += f
    assert got == want and (len(rows) == len(want)) is once


def test_the_pass_over_texts_makes_rows_for_what_the_sample_missed_only(spark, monkeypatch):
    """Proposed phrases get their texts in the pass that counts them; a word in few rows is missed, with all that holds it."""
    passes, count_texts = [], phrases.count_texts
    monkeypatch.setattr(phrases, "count_texts", lambda *x: passes.append(count_texts(*x)) or passes[-1])
    rows = [("en", f"a b c a b c d e f{i % 7}") for i in range(400)] + [("en", "b c " + "odd one a b c d, " * 8)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    want = brute_phrases(rows, 8)
    for sample in (1, 10**6):
        got = {tuple(x) for x in phrases.collocations(df, min_count=8, sample=sample).collect()}
        assert got == want and any("odd" in x[2] for x in got)
    assert len(passes) == 1 and passes[0].count() > 0
    drawn = df.filter(~F.col("text").contains("odd"))
    monkeypatch.setattr(phrases, "stage", lambda df, label, real=phrases.stage: real(drawn if label == "phrases-sample" else df, label))
    assert {tuple(x) for x in phrases.collocations(df, min_count=8, sample=1).collect()} == want
    assert len(passes) == 2 and all("odd" in r.phrase or "one" in r.phrase for r in passes[1].collect())


def test_phrases_that_share_a_key_are_counted_apart(spark, monkeypatch):
    """Keys that nearly all phrases share: only the texts tell them apart."""
    monkeypatch.setattr(phrases, "longer", lambda keys, last: (keys ^ last) & np.uint64(3))
    rows = [("en", "a b c. b a d! d c a b")] * 6 + [("de", "a b c")] * 5 + [("en", "x y z w v u. y x")] * 3
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    assert {tuple(x) for x in phrases.collocations(df, min_count=5, sample=2).collect()} == brute_phrases(rows, 5)


def test_scores_beyond_64_bits(spark):
    a, n, left, right = 3 * 10**12, 10**14, 5 * 10**12, 7 * 10**12
    whole = [F.lit(x).cast("decimal(38,0)") for x in (a, n, left, right)]
    df = spark.range(1).select((1000 * whole[0] * whole[1]).alias("o"), (whole[2] * whole[3]).alias("u")).select(F.expr("o div u"))
    assert df.head()[0] == 1000 * a * n // (left * right)


def plain(s):
    return hashlib.sha256(s.encode()).hexdigest()


def brute_manifest(rows, fan):
    """Rows (doc_id, source, lang, n_chars, text) to a list of their leaf, subroot, root, proof, folded root."""
    leaf = lambda r: plain("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([plain("".join(out[-1][i:i + fan])) for i in range(0, len(out[-1]), fan)])
        return out

    def path(tree, i):
        for nodes in tree[:-1]:
            run = nodes[i // fan * fan:i // fan * fan + fan]
            yield run[:i % fan], run[i % fan + 1:]
            i //= fan

    trees = {}
    for r in sorted(rows, key=lambda r: (r[1] is not None, (r[1] or "").encode(), r[0] is not None, r[0] or 0, leaf(r))):
        trees.setdefault(r[1], []).append(r)
    built = {s: levels([leaf(r) for r in rs]) for s, rs in trees.items()}
    top = levels([t[-1][0] for t in built.values()])
    out = []
    for k, (s, rs) in enumerate(trees.items()):
        for i, r in enumerate(rs):
            steps = [*path(built[s], i), *path(top, k)]
            even = zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 2 == 0
            fold = leaf((*r[:4], r[4].replace("\n", ""))) if even and r[4] else leaf(r)
            for before, after in steps:
                fold = plain("".join([*before, fold, *after]))
            out.append((r[0], leaf(r), built[s][-1][0], top[-1][0], plain("".join(x for b, a in steps for x in b + a)), fold))
    return Counter(out)


def folded(made, docs):
    text = lambda c: F.lower(F.hex(c))
    rows = merkle.proofs(made, made.leaves, ["doc_id"]).select("doc_id", text("leaf"), text("subroot"), text("proof_sha256"), text("folded"))
    return Counter((r[0], r[1], r[2], made.root.hex(), r[3], r[4]) for r in rows.collect())


def test_manifest_of_odd_rows(docs):
    rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert folded(merkle.manifest_of(docs), docs) == brute_manifest(rows, 3)
    empty = merkle.manifest_of(docs.limit(0))
    assert empty.root is None and merkle.proofs(empty, empty.leaves, ["doc_id"]).count() == 0


@pytest.mark.parametrize("fan, levels, counts", [(3, 1, [1, 3, 4, 28]), (3, 2, [9, 10, 82, 1, 1, 1, 1, 1, 1, 1, 2]), (2, 2, [17, 5]), (3, 5, [1]), (3, 5, [244])])
def test_manifests_of_all_shapes(spark, fan, levels, counts):
    rows = [(100 * s + i if i % 5 else 7, None if s == 0 else f"é{s}", None, i // 2 if i % 4 else 1, f"t\n{i}") for s, n in enumerate(counts) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(3)
    made = merkle.manifest_of(df, fan, levels)
    assert folded(made, df) == brute_manifest(rows, fan)
    records = {bytes(r[0]): [bytes(c) for c in r[1]] for r in made.records().collect()}
    assert all(merkle.digest(c) == d for d, c in records.items())
    some = made.leaves.filter("rank % 4 = 3")
    assert merkle.proofs(made, some, ["doc_id", "rank"]).count() == sum(1 for n in counts for i in range(n) if i % 4 == 3)


def test_ranks_are_whole_and_split_a_hot_source(spark):
    rows = spark.range(500).select(F.lit("hot").alias("source"), F.lit(1).cast("long").alias("doc_id"), F.lit(b"x").alias("leaf"))
    out, groups = merkle.ranked(rows.repartition(4), "source", ["doc_id", "leaf"])
    assert all(b - a == 1 for a, b in pairwise(sorted(r["rank"] for r in out.collect()))) and groups.head()["n"] == 500
