"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names, operator by operator."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from dqlake.llm import graph, hnsw, line_dedup, mixing, pieces, quality, simhash, suffix, topk, toxicity, warc
from dqlake.llm.common import shared_folder

LONG = " ".join(f"word{i}" for i in range(60_000))
TEXTS = [(1, "a b c"), (2, None), (3, ""), (None, "a b c"), (4, LONG), (4, LONG), (5, " \n \t"), (6, "\x00▁ é😀\n")]


@pytest.fixture(scope="module")
def docs(spark):
    """Texts of every kind; the extra columns are named like columns that operators add or use."""
    rows = [(i, t, "s", "x", 1, 2, "k") for i, t in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, score string, n_lines long, copy int, _key string")


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def test_pieces(spark, docs, none):
    out = pieces.decode(pieces.encode(docs), text_col="back").collect()
    assert Counter((r.doc_id, r.text) for r in out) == Counter(TEXTS)
    assert all(r.back == r.text for r in out) and {r.ids is None for r in out if r.text is None} == {True}
    assert all(r.ids == [] for r in out if r.text == "")
    assert pieces.encode(none).count() == 0


def test_pieces_without_dropout_are_the_models_own_and_with_it_vary():
    import sentencepiece

    own = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    model = pieces.Model.load()
    text = "The quick  brown fox,\n jumps over über 東京 12345 " * 20
    assert pieces.Encoder(model, 0.0, 1, 4).text(text, "1") == own.encode(text)
    some = pieces.Encoder(model, 0.3, 1, 4)
    ways = {tuple(some.text(text, str(k))) for k in range(5)}
    assert len(ways) == 5 and all(pieces.Encoder(model, 0.3, 1, 4).text(text, "0") == some.text(text, "0") for _ in range(2))
    for unit in (" unbelievable", "aaaaaaaaaaaa", " 東京a"):
        for below in (0, 2**27):
            assert some.short(unit, some.ranks, below, 9) == some.long(unit, some.ranks, below, 9)


def test_every_occurrence_draws_its_own_cut():
    model = pieces.Model.load()
    encoder = pieces.Encoder(model, 0.1, 7)
    unit, plain = " unbelievable", pieces.Encoder(model, 0.0, 7).text("unbelievable", "")
    ways = Counter(tuple(encoder.text("unbelievable", str(k))) for k in range(5000))
    assert len(ways) > 8 and {b"".join(map(model.bytes_of.__getitem__, w)).decode() for w in ways} == {unit}
    taken = []
    assert list(encoder.unit(unit, 0, taken)) == plain and len(ways) > len(taken)
    assert ways[tuple(plain)] / 5000 >= 0.9 ** len(taken) - 0.03
    for text in (unit, " brown", "x" * 50 + "unbelievable" * 3):
        taken = []
        whole = encoder.unit(text, 0, taken)
        for key in range(0, 2**64, 2**64 // 200 + 1):
            none = not any(((h := key ^ at) ^ h >> 31) * 0xD6E8FEB86659FD93 >> 36 & 0xFFFFFFF < encoder.skip_below for at in taken)
            assert not none or encoder.unit(text, key) == whole


def plain_cut(model, unit, key, below):
    """The published method on one unit, symbol by symbol: the best neighbours merge unless their hash skips them."""
    cuts, dead = list(range(len(unit) + 1)), set()
    while True:
        pairs = [(-model.scores[model.ids[unit[a:c]]], a, c) for a, b, c in zip(cuts, cuts[1:], cuts[2:])
                 if unit[a:c] in model.ids and (a, b, c) not in dead]
        if not pairs:
            break
        _, a, c = min(pairs)
        b = cuts[cuts.index(a) + 1]
        h = (key ^ (a * 0x9E3779B97F4A7C15 + c * 0xC2B2AE3D27D4EB4F)) % 2**64
        if ((h ^ h >> 31) * 0xD6E8FEB86659FD93 % 2**64) >> 36 < below:
            dead.add((a, b, c))
        else:
            cuts.remove(b)
            dead = {d for d in dead if b not in d}
    out = []
    for a, c in zip(cuts, cuts[1:]):
        known = unit[a:c] in model.ids and unit[a:c] != pieces.SPACE
        out += [model.ids[unit[a:c]]] if known else [model.byte_ids[b] for b in unit[a:c].encode()]
    return out


def test_the_parts_of_units_lie_by_end_then_start():
    """A part's place needs no length of its unit; prices are the model's own floats."""
    model = pieces.Model.load()
    encoder = pieces.Encoder(model, 0.1, 7)
    units = [" unbelievable", "a", " ", "é\u2581\x00x", " " * 40, "x" * 48]
    encoder.learn(units)
    for unit in units:
        for stop in range(1, len(unit) + 1):
            for left in range(stop):
                part = unit[left:stop]
                want = -2 - ord(part) if len(part) == 1 and (part not in model.ids or part == pieces.SPACE) else model.ids.get(part, -1)
                assert encoder.parts[encoder.known[unit] + stop * (stop - 1) // 2 + left] == want
    assert encoder.cost.dtype == np.float32 and all(encoder.cost[i] == -model.scores[i] for i in model.ids.values())


def test_pieces_equal_the_plain_method_on_whole_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    model, below = pieces.Model.load(), int(0.1 * 2**28)
    encoder = pieces.Encoder(model, 0.1, 7)
    texts = [r.text for r in rows if r.text] + ["", "x" * 300 + " a", " ".join("unbelievable" * k for k in range(9)), "ä▁b 漢字 😀" * 30]
    keys = [str(r.doc_id) for r in rows if r.text] + ["a", "b", "c", "d"]
    for text, key, got in zip(texts, keys, encoder.texts(texts, keys), strict=True):
        units = pieces.UNIT.findall(" " + text) if text else []
        draws = encoder.draws(units, key).tolist()
        assert got.tolist() == [i for u, d in zip(units, draws) for i in plain_cut(model, u, d, below)]
        assert len(text) > 2000 or encoder.text(text, key) == got.tolist()


def test_parts_of_units_may_be_forgotten(monkeypatch):
    model = pieces.Model.load()
    text = " ".join(f"word{i} other{i % 7}" for i in range(3000))
    whole = pieces.Encoder(model, 0.2, 7).text(text, "1")
    monkeypatch.setattr(pieces, "KEPT", 500)
    monkeypatch.setattr(pieces, "BLOCK", 64)
    assert pieces.Encoder(model, 0.2, 7).text(text, "1") == whole


def test_top_k(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.5]), (100, [1.0, 0.5]), (1, [1.0, 0.5]), (2, None), (3, [nan, 1.0]), (4, [None, 1.0]), (5, []), (6, [-1.0]), (1, [1.0, 0.5]),
            (None, [1.0, 1.0]), (7, [1e300, 0.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, score int")
    got = [tuple(r) for r in topk.top_k(df, F.col("vec_id") % 100 == 0, k=3).drop("row").orderBy("query_id", "rank").collect()]
    one = 1024 * 1024 + 512 * 512
    most = 2**63 - 1
    assert got == [(0, 1, 7, most), (0, 2, 1, one), (0, 3, 1, one), (100, 1, 7, most), (100, 2, 0, one), (100, 3, 1, one)]
    many = topk.top_k(df, F.col("vec_id") == 1, k=20).collect()  # two queries of one id, each with all rows but its own
    assert Counter(r.rank for r in many) == Counter({i: 2 for i in range(1, 7)}) and sum(r.vec_id == 1 for r in many) == 2
    assert topk.top_k(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_top_k_in_many_blocks(spark):
    r = np.random.default_rng(1)
    x = r.integers(-3, 4, (900, 5)) * 0.25
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {(q.query_id, q.rank): (q.vec_id, q.score) for q in topk.top_k(df, F.col("vec_id") % 20 == 0, k=7, block=100, query_block=8).collect()}
    w = np.floor(1024 * x).astype(int)
    for q in range(0, 900, 20):
        scores = sorted((-int(w[q] @ w[c]), c) for c in range(900) if c != q)[:7]
        assert [got[q, k + 1] for k in range(7)] == [(c, -s) for s, c in scores]


def test_suffix_repeats(spark, docs, none):
    from test_llm_queries import brute_repeats

    rows = suffix.remove_repeats(docs).collect()
    assert len(rows) == len(TEXTS) and sum(r.n_bytes for r in rows if r.doc_id == 4) == 2 * len(LONG)
    assert all(r.n_removed == 0 for r in rows)  # rows with one id do not remove from each other
    assert suffix.remove_repeats(none).count() == 0
    line = "this very common line of licence text stands in one document of three, word for word."
    made = {i: f"{i} before it {i * i}\n{line}\n{i * 7} after {i}" + (LONG[:3000] if i % 5 == 0 else "") + "a" * (i % 90) for i in range(120)}
    df = spark.createDataFrame(list(made.items()), "doc_id long, text string").repartition(7)
    want = brute_repeats(made)
    for hot in (1, 64):  # windows one by one, and stretches
        got = suffix.remove_repeats(df, hot=hot).withColumn("sha", F.sha2("kept", 256)).collect()
        assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.sha) for r in got} == want


def test_warc(spark):
    rows = [(1, "http://a", "x"), (2, None, "x"), (3, "u r\n", None), (4, "u", ""), (5, "u", "é\r\n\r\nWARC/1.1\r\n" * 3000), (5, "u", "é\r\n\r\nWARC/1.1\r\n" * 3000),
            (None, "n", "x"), (6, "u", "😀" * 1000)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, record_type int")
    for chunk in (7, 64 * 1024):
        path = shared_folder(spark, "warc-test")
        warc.write_archives(pages, path, chunk=chunk)
        read = warc.read_records(spark, path).collect()
        assert Counter(r.page_id for r in read) == Counter(r[0] for r in rows)  # a row per row, repeated ones too
        got = {r.page_id: (r.payload_bytes, r.record_type, r.refers_to) for r in read}
        long = len("é\r\n\r\nWARC/1.1\r\n".encode()) * 3000
        assert got == {1: (1, "revisit", 2), 2: (1, "response", None), None: (1, "revisit", 2), 3: (0, "revisit", 4), 4: (0, "response", None),
                       5: (long, "response", None), 6: (4000, "response", None)}
        chunks = warc.read_chunks(spark, path, 100).where("page_id = 6").orderBy("chunk", "part").collect()
        assert b"".join(c.data for c in chunks).decode() == "😀" * 1000 and max(len(c.data) for c in chunks) <= 100
    empty = shared_folder(spark, "warc-empty")
    warc.write_archives(pages.limit(0), empty)
    assert warc.read_records(spark, empty).count() == 0


def test_a_damaged_archive_stops_the_job():
    import gzip

    import pyarrow as pa

    whole = warc.record([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:x-page:1:A>"), ("WARC-Target-URI", "u"),
                         ("WARC-Payload-Digest", "sha1:A"), ("X-Payload-Length", "1")], warc.HTTP + b"x") + warc.END
    for data in (gzip.compress(whole)[:-12], gzip.compress(whole[:-6]), gzip.compress(whole)):  # cut, cut, wrong digest
        batch = pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["content"])
        with pytest.raises(ValueError):
            list(warc.parse(100, False)(iter([batch])))


def test_mixing(spark, docs, none):
    out = mixing.mix(docs, total=80.0).collect()
    assert {r.source for r in out} == {"s"} and 40 < len(out) < 140 and mixing.mix(none).count() == 0
    rows = [(i, "hot" if i % 3 else None, "t") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    per = Counter(r.source for r in mixing.mix(df, {"hot": 1.0, None: 3.0, "absent": 1.0}, total=4000.0).collect())
    assert abs(per["hot"] - 1000) < 150 and abs(per[None] - 3000) < 250
    again = mixing.mix(df.repartition(5), {"hot": 1.0, None: 3.0}, total=4000.0).select("doc_id", "copy").collect()
    assert Counter(again) == Counter(mixing.mix(df, {"hot": 1.0, None: 3.0}, total=4000.0).select("doc_id", "copy").collect())
    counts = Counter(r.doc_id for r in again if r.doc_id % 3 == 0)  # rate 3: as a Poisson distribution has them
    share = [sum(1 for i in range(0, 3000, 3) if counts[i] == k) / 1000 for k in range(7)]
    assert all(abs(share[k] - math.exp(-3) * 3**k / math.factorial(k)) < 0.05 for k in range(7))
    large = mixing.mix(df.limit(1), total=1000.0).count()
    assert 850 < large < 1150


def test_line_dedup(spark, docs, none):
    out = line_dedup.drop_repeated_lines(docs).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in out) == sorted((i or 0, t or "") for i, t in TEXTS)
    assert Counter(r.n_lines for r in out) == {1: 6, 2: 2} and line_dedup.drop_repeated_lines(none).count() == 0
    line = "  A line that is LONG enough \t"
    made = [(1, f"{line}\nx\n{line}"), (2, line.lower()), (3, f"{line}\n{line}"), (None, f"{line}\ny"), (3, f"{line}\n{line}")]
    got = line_dedup.drop_repeated_lines(spark.createDataFrame(made, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.text, r.n_dropped) for r in got) == [
        (0, "y", 1), (1, "x", 2), (2, "", 1), (3, f"{line}\n{line}", 0), (3, f"{line}\n{line}", 0)]


def test_simhash(spark, docs, none):
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(TEXTS) and {r.fingerprint for r in got if r.doc_id in (2, 3, 5)} == {"0" * 16}
    assert {r.component_id for r in got if r.doc_id in (2, 3, 5)} == {2} and {r.component_id for r in got if r.doc_id in (1, None)} == {1}
    assert simhash.near_duplicates(none).count() == 0 and simhash.similar_documents(none).count() == 0


def test_simhash_cells_lose_no_link(spark):
    """A dense group of fingerprints in cells of a few entries against all pairs."""
    import random

    r = random.Random(5)
    base = [r.getrandbits(64) for _ in range(20)]
    fps = sorted({b ^ sum(1 << x for x in r.sample(range(64), r.randrange(6))) for b in base for _ in range(30)})
    rows = [(i, bytearray(f.to_bytes(8, "big"))) for i, f in enumerate(fps)]
    nodes = spark.createDataFrame(rows, "node long, fp binary")
    from test_llm_queries import roots

    want = roots(range(len(fps)), [(a, b) for a in range(len(fps)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 3])
    for parts, cell in ((4, 7), (3, 4096), (2, 5)):
        tree = {x.node: x.component for x in graph.components(simhash.links(nodes, 64, parts, 4, 3, 3, cell)).collect()}
        assert {i: tree.get(i, i) for i in want} == want


def test_thresholds_add_up():
    cost = [np.random.default_rng(p).random((5, 50)) for p in range(6)]
    assert (simhash.allocate(cost, 9).sum(axis=1) == 9).all()
    least = min(sum(cost[p][g][0] for p, g in enumerate(c)) for c in __import__("itertools").product(range(5), repeat=6) if sum(c) == 9)
    got = simhash.allocate(cost, 9)[0]
    assert sum(cost[p][g][0] for p, g in enumerate(got)) == pytest.approx(least)


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(200, 100), (100, 100), (300, 200), (300, 200)]
    df = spark.createDataFrame(chain, "a long, b long")
    got = {r.node: r.component for r in graph.components(df).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 200: 100, 300: 100}
    assert graph.components(df.limit(0)).count() == 0


def test_hnsw(spark):
    nan = float("nan")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 1), (4, [1.0, 0.0], 2), (5, [1.0, 0.0], None), (6, None, 1), (7, [0.0, 0.0], 1),
            (8, [nan, 1.0], 1), (9, [], 1), (10, [1e300, 1e299], 1), (None, [1.0, 0.0], 1), (11, [1.0], 1), (12, [5e-324, 0.0], 1)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, label int, n_links int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in hnsw.near_duplicates(df).collect()}
    alone = {i: (0, i, True) for i in (4, 5, 6, 7, 8, 9, 11)}
    linked = {i: (5, 1, i == 1) for i in (1, 2, 3, 10, 12)}
    assert got == {**alone, **linked, None: (5, 1, False)}
    assert hnsw.near_duplicates(df.limit(0)).count() == 0


def test_hnsw_shards_and_recall(spark):
    r = np.random.default_rng(3)
    centres = r.standard_normal((40, 16))
    x = np.concatenate([centres[r.integers(0, 40, 1500)] + 0.05 * r.standard_normal((1500, 16)), r.standard_normal((500, 16))])
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    y = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (y @ y.T >= 0.98) & ~np.eye(len(x), dtype=bool)
    got = {q.vec_id: q.n_links for q in hnsw.near_duplicates(df, shard=600, queries=500).collect()}
    found = sum(got.values())
    assert 0.98 * near.sum() <= found <= near.sum() and all(got[i] <= near[i].sum() for i in range(len(x)))


def test_hnsw_audit_sees_missed_pairs(spark, monkeypatch):
    r = np.random.default_rng(5)
    x = hnsw.unit(r.standard_normal((3000, 24)))
    x[:300:2] = hnsw.unit(x[1:300:2] + 0.01 * r.standard_normal((150, 24)))  # a tenth have one partner
    own, near = np.arange(len(x)), hnsw.unit(x) @ hnsw.unit(x).T >= 0.98
    search = hnsw.Graph.search

    def blind(self, queries, width):  # the first beam sees the vector itself, and the partner of every second pair
        ids, score = search(self, queries, len(self.x))
        if width == hnsw.BEAM:
            at = np.argmax(score, axis=1)
            hide = (at < 300) & (at // 2 % 2 == 0)
            score = np.where(hide[:, None] & (np.arange(len(self.x)) != at[:, None]), -1, score)
        order = np.argsort(-score, axis=1)[:, :width]
        return np.take_along_axis(ids, order, axis=1), np.take_along_axis(score, order, axis=1)

    monkeypatch.setattr(hnsw.Graph, "search", blind)
    found, seen = hnsw.lookups(hnsw.Graph(x.astype(np.float32), [], own[:1]), x, x, 0.98, own=own)
    assert seen["beam"] > hnsw.BEAM and seen["true"] >= hnsw.AUDIT and [set(f) for f in found] == [set(np.flatnonzero(n)) for n in near]
    monkeypatch.undo()
    audits = []
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = {q.vec_id: q.n_links for q in hnsw.near_duplicates(df, shard=1500, queries=1500, audits=audits).collect()}
    assert len(audits) == 4 and all(a["true"] >= hnsw.AUDIT or a["checked"] >= 1400 for a in audits)
    assert sum(a["there"] for a in audits) >= 0.98 * sum(a["true"] for a in audits) and sum(got.values()) >= 0.98 * 300


def test_gradients_of_both_networks():
    r = np.random.default_rng(0)
    net = toxicity.Network(3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    words = ["loser", "the", "a", "xy", "über"]
    x = net.inputs(words).astype(np.float64)
    index, length, label = r.integers(0, 5, (3, 6)), np.array([6, 3, 1]), np.array([1.0, 0.0, 1.0])

    def loss():
        logit, _ = net.read(net.project(x), index, length)
        return float(np.mean(np.log1p(np.exp(logit)) - label * logit))

    grads, _ = net.gradients(net.project(x), x, index, length, label)
    for name in ("w", "u", "a", "v", "o", "b"):
        at = tuple(r.integers(0, n) for n in net.p[name].shape)
        net.p[name][at] += 1e-2
        up = loss()
        net.p[name][at] -= 2e-2
        down = loss()
        net.p[name][at] += 1e-2
        assert grads[name][at] == pytest.approx((up - down) / 2e-2, abs=2e-4)
    bags = quality.Bags(2)
    bags.p = {k: v.astype(np.float64) for k, v in bags.p.items()}
    f, start, label = r.random((7, quality.FEATURES)), np.array([0, 3]), np.array([1.0, 0.0])
    grads = bags.gradients(f, start, label)

    def bag_loss():
        logit, _ = bags.read(f, start)
        return float(np.mean(np.log1p(np.exp(logit)) - label * logit))

    for name in ("e", "v", "u", "w", "o"):
        at = tuple(r.integers(0, n) for n in bags.p[name].shape)
        bags.p[name][at] += 1e-4
        up = bag_loss()
        bags.p[name][at] -= 2e-4
        down = bag_loss()
        assert grads[name][at] == pytest.approx((up - down) / 2e-4, abs=1e-4)


@pytest.mark.parametrize("module, model", [(toxicity, toxicity.Network(1)), (quality, quality.Bags(1))])
def test_scores_of_odd_texts(docs, none, module, model):
    out = module.score(docs, model).collect()
    assert len(out) == len(TEXTS) and all(0 <= r.score <= 1 for r in out)
    assert len({r.score for r in out if r.doc_id in (2, 3, 5)}) == 1 and len({r.score for r in out if r.doc_id in (1, None)}) == 1
    assert module.score(none, model).count() == 0
    assert len({r.score for r in out if r.doc_id == 4}) == 1


def test_training_on_nothing():
    assert 0 < toxicity.sigmoid(toxicity.train([], []).p["c"])[0] < 1 and quality.train([], []).p["c"][0] == 0


def test_toxic_words_are_learnt():
    r = np.random.default_rng(4)
    vocabulary = [f"{a}{b}" for a in ("ba", "ko", "mi", "tu") for b in ("ra", "lo", "ne", "si", "vu")]

    def text(bad):
        words = r.choice(vocabulary, 90).tolist()
        for at in r.integers(0, 90, 3) if bad else ():
            words[at] = r.choice(["scumbag", "scumlike", "scumm"])
        return " ".join(words)

    labels = [i % 3 == 0 for i in range(300)]
    net = toxicity.train([text(b) for b in labels[:200]], [int(b) for b in labels[:200]])
    proj_words = vocabulary + ["scumbag", "scumlike", "scumm", "scumful"]

    def scored(t):
        words = t.split()
        index = [[proj_words.index(w) for w in words[s:s + n]] + [0] * (toxicity.WINDOW - n) for s, n in toxicity.windows_of(len(words))]
        lengths = [n for _, n in toxicity.windows_of(len(words))]
        return float(toxicity.sigmoid(net.read(net.project(net.inputs(proj_words)), np.array(index), np.array(lengths))[0]).max())

    right = sum((scored(text(b)) >= 0.3) == b for b in labels[200:])
    assert right >= 90


def test_texts_without_blanks_are_read_whole(spark):
    for n in (39, 40, 41, 59, 60, 61, 1000):
        word = "".join(chr(0x4E00 + i) for i in range(n))
        parts = toxicity.inputs_of(f"a {word} b")[1:-1]
        assert all(len(p) <= 40 for p in parts) and (parts == [word] if n <= 40 else len(parts) > 1)
        assert all(any(word[i:i + 11] in p for p in parts) for i in range(n - 10))
    r = np.random.default_rng(6)
    syllables = [f"{a}{b}" for a in ("ba", "ko", "mi", "tu") for b in ("ra", "lo", "ne", "si", "vu")]

    def text(bad):
        words = r.choice(syllables, 150).tolist()
        if bad:
            words[int(r.integers(50, 100))] = "scumbag"
        return "".join(words)

    labels = [i % 2 for i in range(400)]
    net = toxicity.train([text(b) for b in labels[:300]], labels[:300])
    held = spark.createDataFrame([(b, text(b)) for b in labels[300:]], "label int, text string")
    rows = toxicity.score(held, net).collect()
    assert sum((r.score >= 0.3) == bool(r.label) for r in rows) >= 90
    clean = text(False)
    pair = spark.createDataFrame([(0, clean), (1, clean[:300] + "scumbag" + clean[307:])], "bad int, text string")
    scores = {r.bad: r.score for r in toxicity.score(pair, net).collect()}
    assert scores[1] > scores[0]


def test_passages_are_learnt():
    r = np.random.default_rng(5)

    def text(good):
        words = ["".join(r.choice(list("abcdefgh"), 5)) for _ in range(200)]
        if not good:
            words[70:130] = ["SPAM!!"] * 60
        return " ".join(words)

    labels = [i % 2 for i in range(300)]
    model = quality.train([text(g) for g in labels[:200]], labels[:200])
    scores = [quality.sigmoid(model.read(np.stack(list(quality.passages(text(g)))), np.array([0]))[0])[0] for g in labels[200:]]
    assert sum((s >= 0.3) == bool(g) for s, g in zip(scores, labels[200:])) >= 98


def pair(k, same, other):
    """Two texts with ``same`` shingles of five words in common and ``other`` more in each."""
    head = [f"w{k}x{i}" for i in range(same + 4)]
    return " ".join(head + [f"a{k}x{i}" for i in range(other)]), " ".join(head + [f"b{k}x{i}" for i in range(other)])


def test_near_copies_are_linked_at_the_stated_similarity_and_not_below(spark):
    rows, kind = [], {}
    for name, same, other, n in (("above", 180, 22, 80), ("below", 170, 29, 60), ("far", 165, 36, 40)):
        for _ in range(n):
            a, b = pair(len(rows), same, other)
            kind[len(rows)] = name
            rows += [(len(rows), a), (len(rows) + 1, b)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    root = {r.doc_id: r.component_id for r in simhash.similar_documents(df).collect()}
    found = Counter(name for i, name in kind.items() if root[i] == root[i + 1])
    assert 180 / 224 > 0.8 > 170 / 228 and found["above"] >= 76 and found["below"] == found["far"] == 0


def test_no_link_of_the_stated_similarity_is_lost(spark):
    """Short texts with noisy fingerprints, chains of variants, rows without id, against all pairs."""
    r, rows = np.random.default_rng(5), []
    for family in range(60):
        n = int(r.integers(6, 60))
        base = [f"w{family % 50}_{k}" for k in range(n)]
        for _ in range(6):
            text = list(base)
            for _ in range(int(r.integers(0, 3))):
                at = int(r.integers(0, 3)) if r.random() < 0.5 else int(r.integers(n - 3, n))
                text[at] = f"x{r.integers(0, 4)}"
            rows.append((len(rows) if r.random() < 0.95 else None, " ".join(text + ["a common ending of many texts"] * (family % 2))))
    sets = [simhash.shingle_set(t.encode(), 5) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(np.intersect1d(a, sets[j]))
            if both >= 0.8 * (len(a) + len(sets[j]) - both) - 1e-9:
                root[top(i)] = top(j)
    least = {}
    for i, (name, _) in enumerate(rows):
        least[top(i)] = min((x for x in (least.get(top(i)), name) if x is not None), default=None)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((x.doc_id, x.component_id) for x in simhash.similar_documents(df).collect())
    assert got == Counter((name, least[top(i)]) for i, (name, _) in enumerate(rows))


def test_the_sample_is_drawn_among_documents_that_fit(spark):
    from dqlake.llm.labelled import labelled_sample

    docs = spark.createDataFrame([(i, "x " * (5000 if i < 900 else 5), "e") for i in range(1000)], "doc_id long, text string, _label string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(2000)] + [(None, 1), (950, None)], "doc_id long, toxic int")
    got = labelled_sample(docs, labels, "toxic", 4, 2, (20, 20), 100).collect()
    assert Counter(r.label for r in got) == {0: 20, 1: 20} and all(r.doc_id >= 900 for r in got)


def test_reading_in_place_gives_what_training_reads():
    r = np.random.default_rng(2)
    net = toxicity.Network()
    proj = net.project(net.inputs([f"w{i}" for i in range(300)]))
    index = r.integers(0, 300, (50, toxicity.WINDOW))
    for length in (np.full(50, toxicity.WINDOW), r.integers(0, toxicity.WINDOW + 1, 50)):
        assert np.allclose(net.read(proj, index, length)[0], net.read(proj, index, length, keep=True)[0], atol=1e-4)


def test_scores_are_those_of_the_plain_network(spark):
    """Word by word, window by window, one step at a time."""
    net = toxicity.Network(4)
    sig = lambda x: 1 / (1 + math.exp(-x))

    def window(words):
        x = net.inputs(words)
        both = []
        for d, order in ((0, range(len(words))), (1, range(len(words) - 1, -1, -1))):
            h, states = np.zeros(toxicity.HIDDEN), {}
            for t in order:
                g, own = h @ net.p["u"][d], x[t] @ net.p["w"][d] + net.p["b"][d][0]
                n = toxicity.HIDDEN
                z, q = np.array([sig(v) for v in own[:n] + g[:n]]), np.array([sig(v) for v in own[n:2 * n] + g[n:2 * n]])
                new = np.tanh(own[2 * n:] + q * g[2 * n:])
                h = (1 - z) * new + z * h
                states[t] = h
            both.append(states)
        if not words:
            return sig(net.p["c"][0])
        all_states = [np.concatenate([both[0][t], both[1][t]]) for t in range(len(words))]
        e = np.array([np.tanh(s @ net.p["a"]) @ net.p["v"] for s in all_states])
        weight = np.exp(e - e.max())
        return sig(sum(w * s for w, s in zip(weight / weight.sum(), all_states)) @ net.p["o"] + net.p["c"][0])

    texts = ["", "one", " ".join(f"w{i}" for i in range(64)), " ".join(f"v{i % 9}" for i in range(65)), " ".join(f"u{i}" for i in range(200)), "y" * 100]
    got = toxicity.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), net).collect()
    for r in got:
        words = toxicity.inputs_of(r.text)
        assert abs(r.score - max(window(words[s:s + n]) for s, n in toxicity.windows_of(len(words)))) < 1e-4
