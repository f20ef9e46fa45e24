"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy.

Inputs of a word are an embedding of the word and the mean of embeddings of its character 3- and 5-grams, both hashed. A word
over 40 characters is read as its overlapping parts, each like a word, so that texts without blanks are read whole too. The
network reads every window of 64 words, half overlapping the next; a document's score is that of its most toxic window.
Documents are labelled, windows are not: training repeats rounds in which a document is represented by its currently
highest window (and, if it is clean, by a random one too).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dqlake.llm.common import table
from dqlake.llm.labelled import labelled_sample, remainder

WINDOW, STEP = 64, 32
BUCKETS = 1 << 15
INPUT, HIDDEN, ATTEND = 16, 8, 8
ROWS = (3500, 1500)  # at most so many clean and toxic documents train the network
CHARS = 12_000  # of a document that trains it: fewer
LONGEST, PART, STRIDE = 40, 20, 10  # characters of a word read as one; of a part of a longer word; from part to part
KNOWN = 150_000  # words whose inputs a task remembers
BATCH = 1024


def inputs_of(text: str) -> list[str]:
    """The words of a text in lower case; in place of one over ``LONGEST`` characters its overlapping parts, end to end."""
    words = text.lower().split()
    if not words or len(max(words, key=len)) <= LONGEST:
        return words
    parts = (((w,) if len(w) <= LONGEST else (w[at:at + PART] for at in range(0, len(w) - PART + STRIDE, STRIDE))) for w in words)
    return list(chain.from_iterable(parts))


def grams(word: str) -> list[int]:
    """Hashed character 3- and 5-grams of a word between its marks."""
    w = f"<{word}>".encode()
    return [zlib.crc32(w[i:i + n], n) % BUCKETS for n in (3, 5) for i in range(max(1, len(w) - n + 1))]


def bucket(word: str) -> int:
    return zlib.crc32(word.encode()) % BUCKETS


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of words: the buckets, the grams of all end to end, and how many each has."""
    chars, sizes = [np.empty(0, np.int32)], []
    for at in range(0, len(words), 4096):  # whole lists of numbers would take ten times the memory
        lists = [grams(w) for w in words[at:at + 4096]]
        chars.append(np.fromiter(chain.from_iterable(lists), dtype=np.int32))
        sizes += map(len, lists)
    return np.array([bucket(w) for w in words]), np.concatenate(chars), np.array(sizes)


def windows_of(n: int) -> list[tuple[int, int]]:
    """(start, length) of the windows of a text of ``n`` words; an empty text has one empty window."""
    return [(s, min(WINDOW, n - s)) for s in range(0, max(1, n - STEP), STEP)]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Parameters as arrays of float32; both directions are stacked in the first axis of the recurrent ones."""

    def __init__(self, seed: int = 1) -> None:
        r = np.random.default_rng(seed)
        small = lambda *shape, by=0.2: (r.standard_normal(shape) * by).astype(np.float32)
        self.p = {
            "word": small(BUCKETS, INPUT, by=0.1), "char": small(BUCKETS, INPUT, by=0.3),
            "w": small(2, INPUT, 3 * HIDDEN, by=0.3), "b": np.zeros((2, 1, 3 * HIDDEN), np.float32), "u": small(2, HIDDEN, 3 * HIDDEN, by=0.3),
            "a": small(2 * HIDDEN, ATTEND, by=0.3), "v": small(ATTEND), "o": small(2 * HIDDEN), "c": np.full(1, -1.0, np.float32),
        }

    def inputs(self, words: list[str]) -> np.ndarray:
        """Input vectors of words."""
        if not words:
            return np.empty((0, INPUT), np.float32)
        return self.embed(*features(words))

    def embed(self, word: np.ndarray, chars: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        sums = np.add.reduceat(self.p["char"][chars], np.cumsum(sizes) - sizes)
        return self.p["word"][word] + sums / sizes[:, None].astype(np.float32)

    def project(self, x: np.ndarray) -> np.ndarray:
        """[2, words, 3 * HIDDEN]: what each direction's gates get from a word."""
        return np.matmul(x, self.p["w"]) + self.p["b"]

    def project_all(self, word: np.ndarray, chars: np.ndarray, sizes: np.ndarray, part: int = 8192) -> np.ndarray:
        """``project`` of very many words; the embeddings of all their grams at once would take far more memory."""
        edge, out = np.r_[0, np.cumsum(sizes)], np.empty((2, len(word), 3 * HIDDEN), np.float32)
        for at in range(0, len(word), part):
            end = min(at + part, len(word))
            out[:, at:end] = self.project(self.embed(word[at:end], chars[edge[at]:edge[end]], sizes[at:end]))
        return out

    def read(self, proj: np.ndarray, index: np.ndarray, length: np.ndarray, keep: bool = False) -> tuple[np.ndarray, dict]:
        """Logits of windows; ``index`` [n, WINDOW] are rows of ``proj``, those beyond ``length`` are not read."""
        p, (n, steps) = self.p, index.shape
        h = np.zeros((2, n, HIDDEN), np.float32)
        states, kept = np.empty((steps, 2, n, HIDDEN), np.float32), []
        if not keep:
            self.follow(proj, index, length, states)
        for t in range(steps) if keep else ():
            at = (t, steps - 1 - t)
            x = np.stack([proj[d][index[:, at[d]]] for d in (0, 1)])
            m = np.stack([(length > at[d])[:, None] for d in (0, 1)])
            g = np.matmul(h, p["u"])
            zr = sigmoid(x[:, :, :2 * HIDDEN] + g[:, :, :2 * HIDDEN])
            z, r = zr[:, :, :HIDDEN], zr[:, :, HIDDEN:]
            new = np.tanh(x[:, :, 2 * HIDDEN:] + r * g[:, :, 2 * HIDDEN:])
            after = np.where(m, new + z * (h - new), h)
            kept.append((h, z, r, new, g[:, :, 2 * HIDDEN:], m))
            h = after
            states[at[0], 0], states[at[1], 1] = h[0], h[1]
        both = np.concatenate([states[:, 0], states[:, 1]], axis=2).transpose(1, 0, 2)  # [n, steps, 2 * HIDDEN]
        mask = np.arange(steps)[None, :] < length[:, None]
        act = np.tanh(both @ p["a"])
        e = np.where(mask, act @ p["v"], -1e9)
        e = np.exp(e - e.max(axis=1, keepdims=True)) * mask
        weight = e / np.maximum(e.sum(axis=1, keepdims=True), 1e-9)
        pooled = np.matmul(weight[:, None, :], both)[:, 0]
        logit = pooled @ p["o"] + p["c"][0]
        return logit, {"kept": kept, "both": both, "act": act, "weight": weight, "pooled": pooled} if keep else {}

    def follow(self, proj: np.ndarray, index: np.ndarray, length: np.ndarray, states: np.ndarray) -> None:
        """The states of ``read`` where nothing is kept for training: in place, without masks where all windows are full."""
        n, steps = index.shape
        u, rows = self.p["u"], np.ascontiguousarray(index.T)
        h, x, g = np.zeros((2, n, HIDDEN), np.float32), np.empty((2, n, 3 * HIDDEN), np.float32), np.empty((2, n, 3 * HIDDEN), np.float32)
        zr, new, shortest = np.empty((2, n, 2 * HIDDEN), np.float32), np.empty((2, n, HIDDEN), np.float32), int(length.min(initial=steps))
        for t in range(steps):
            at = (t, steps - 1 - t)
            for d in (0, 1):
                np.take(proj[d], rows[at[d]], axis=0, out=x[d], mode="clip")
                np.matmul(h[d], u[d], out=g[d])
            np.add(x[:, :, :2 * HIDDEN], g[:, :, :2 * HIDDEN], out=zr)
            zr *= 0.5  # the logistic function is half of one plus the tangent of half
            np.tanh(zr, out=zr)
            zr += 1
            zr *= 0.5
            np.multiply(zr[:, :, HIDDEN:], g[:, :, 2 * HIDDEN:], out=new)
            new += x[:, :, 2 * HIDDEN:]
            np.tanh(new, out=new)
            after = h - new
            after *= zr[:, :, :HIDDEN]
            after += new
            for d in (0, 1):
                if at[d] >= shortest:
                    after[d] = np.where((length > at[d])[:, None], after[d], h[d])
                states[at[d], d] = after[d]
            h = after

    def gradients(self, proj: np.ndarray, x: np.ndarray, index: np.ndarray, length: np.ndarray, label: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Of the mean logistic loss: by parameter, and by the input vectors ``x``."""
        p, n, steps = self.p, len(index), index.shape[1]
        logit, s = self.read(proj, index, length, keep=True)
        d_logit = (sigmoid(logit) - label).astype(np.float32) / n
        g = {"c": np.array([d_logit.sum()]), "o": s["pooled"].T @ d_logit}
        d_pooled = d_logit[:, None] * p["o"]
        d_both = s["weight"][:, :, None] * d_pooled[:, None, :]
        d_weight = np.matmul(s["both"], d_pooled[:, :, None])[:, :, 0]
        d_e = s["weight"] * (d_weight - (s["weight"] * d_weight).sum(axis=1, keepdims=True))
        g["v"] = np.einsum("nt,nta->a", d_e, s["act"])
        d_act = d_e[:, :, None] * p["v"] * (1 - s["act"] ** 2)
        g["a"] = np.einsum("nth,nta->ha", s["both"], d_act)
        d_both += d_act @ p["a"].T
        d_states = np.stack([d_both[:, :, :HIDDEN], d_both[:, :, HIDDEN:]]).transpose(2, 0, 1, 3)
        d_h, g["u"], d_proj = np.zeros((2, n, HIDDEN), np.float32), np.zeros_like(p["u"]), np.zeros_like(proj)
        for t in range(steps - 1, -1, -1):
            at = (t, steps - 1 - t)
            h, z, r, new, inner, m = s["kept"][t]
            d_h = d_h + np.stack([d_states[at[0], 0], d_states[at[1], 1]])
            d = d_h * m
            d_new = d * (1 - z) * (1 - new ** 2)
            d_z = d * (h - new) * z * (1 - z)
            d_r = d_new * inner * r * (1 - r)
            d_x = np.concatenate([d_z, d_r, d_new], axis=2)
            d_g = np.concatenate([d_z, d_r, d_new * r], axis=2)
            g["u"] += np.matmul(h.transpose(0, 2, 1), d_g)
            d_h = d_h * ~m + d * z + np.matmul(d_g, p["u"].transpose(0, 2, 1))
            for k in (0, 1):
                np.add.at(d_proj[k], index[:, at[k]], d_x[k])
        g["w"] = np.matmul(x.T, d_proj)
        g["b"] = d_proj.sum(axis=1, keepdims=True)
        return g, np.matmul(d_proj, p["w"].transpose(0, 2, 1)).sum(axis=0)


def train(texts: list[str], labels: list[int], rounds: int = 6, steps: int = 120, batch: int = 256, rate: float = 0.01, seed: int = 1) -> Network:
    """A network fitted to whole documents by their highest windows. Same input, same network.

    Few documents are dealt to smaller batches and read in more rounds, so that about ``steps`` steps are made at least.
    """
    net, random = Network(seed), np.random.default_rng(seed)
    if not texts:
        return net
    vocabulary: dict[str, int] = {}
    index, length, doc = [], [], []
    for d, text in enumerate(texts):
        words = [vocabulary.setdefault(w, len(vocabulary)) for w in inputs_of(text)]
        for s, n in windows_of(len(words)):
            index.append(np.array(words[s:s + n] + [0] * (WINDOW - n), dtype=np.int32))
            length.append(n)
            doc.append(d)
    vocabulary.setdefault("", len(vocabulary))
    words, flat, sizes = features(list(vocabulary))
    start = np.cumsum(sizes) - sizes
    index, length, doc, label = np.array(index, dtype=np.int32), np.array(length), np.array(doc), np.array(labels, dtype=np.float32)
    first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    windows = np.diff(np.r_[first, len(doc)])
    state = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    step = 0
    batch = min(batch, max(32, len(texts) // 16))
    rounds = max(rounds, steps * batch // len(texts))

    def adam(name: str, grad: np.ndarray, rows: np.ndarray | slice = slice(None)) -> None:
        m, v = state[name]
        m[rows] = 0.9 * m[rows] + 0.1 * grad
        v[rows] = 0.99 * v[rows] + 0.01 * grad ** 2
        net.p[name][rows] -= rate * (m[rows] / (1 - 0.9 ** step)) / (np.sqrt(v[rows] / (1 - 0.99 ** step)) + 1e-6)

    for round_ in range(rounds):
        pick = first + random.integers(0, windows)
        if round_:
            proj = net.project_all(words, flat, sizes)
            logit = np.concatenate([net.read(proj, index[i:i + BATCH], length[i:i + BATCH])[0] for i in range(0, len(doc), BATCH)])
            order = np.lexsort((logit, doc))
            top = order[np.r_[first[1:], len(doc)] - 1]
            pick = np.r_[top, pick[label == 0]]
        pick = random.permutation(pick)
        for i in range(0, len(pick), batch):
            some = pick[i:i + batch]
            used, local = np.unique(index[some], return_inverse=True)
            local = local.reshape(-1, WINDOW)
            count = sizes[used]
            chars = flat[np.repeat(start[used] - (np.cumsum(count) - count), count) + np.arange(count.sum())]
            x = net.embed(words[used], chars, count)
            grads, d_x = net.gradients(net.project(x), x, local, length[some], label[doc[some]])
            step += 1
            for name, grad in grads.items():
                adam(name, np.clip(grad, -1, 1))
            for name, at, grad in (("word", words[used], d_x), ("char", chars, np.repeat(d_x / count[:, None].astype(np.float32), count, axis=0))):
                rows, back = np.unique(at, return_inverse=True)
                total = np.zeros((len(rows), INPUT), np.float32)
                np.add.at(total, back, grad)
                adam(name, total, rows)
    return net


def score(docs: DataFrame, net: Network, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with ``score_col``, the greatest of its windows' (0 to 1; a column of that name is replaced).

    Every word of every text, or every part of a long one, is in one or two of the windows scored. Null and empty texts are one empty window. Equal texts get
    equal scores. A task remembers the inputs of a bounded number of words and reads a bounded number of windows at once.
    """
    rows = docs.drop(score_col)
    names = rows.columns
    shared = docs.sparkSession.sparkContext.broadcast(net.p)  # about 4 MB, whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Network.__new__(Network)
        model.p = shared.value
        known: dict[str, int] = {}
        proj = np.empty((2, KNOWN + (1 << 16), 3 * HIDDEN), np.float32)

        def numbers(words: list[str]) -> np.ndarray:
            fresh = [w for w in dict.fromkeys(words) if w not in known]
            for at in range(0, len(fresh), 4096):
                part = fresh[at:at + 4096]
                proj[:, len(known):len(known) + len(part)] = model.project(model.inputs(part))
                known.update(zip(part, range(len(known), len(known) + len(part)), strict=True))
            return np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))

        for batch in batches:
            best = np.full(batch.num_rows, -np.inf)
            index, length, doc = [], [], []  # arrays of windows, their lengths, their documents

            def read() -> None:
                windows, sizes, of = np.concatenate(index), np.concatenate(length), np.concatenate(doc)
                for at in range(0, len(of), BATCH):
                    logit, _ = model.read(proj, windows[at:at + BATCH], sizes[at:at + BATCH])
                    np.maximum.at(best, of[at:at + BATCH], logit)
                for kept in (index, length, doc):
                    kept.clear()

            held = 0
            for d, text in enumerate(batch.column(names.index(text_col))):
                words = inputs_of(text.as_py() or "")
                for at in range(0, max(1, len(words) - STEP), 512 * STEP):  # windows of a stretch of words
                    last = at + 512 * STEP >= len(words) - STEP
                    part = words[at:] if last else words[at:at + 511 * STEP + WINDOW]
                    if len(known) + len(part) > KNOWN:
                        if index:
                            read()
                            held = 0
                        known.clear()
                    ids = numbers(part)
                    starts = np.arange(0, max(1, len(ids) - STEP), STEP)
                    padded = np.zeros(starts[-1] + WINDOW, dtype=np.int64)
                    padded[:len(ids)] = ids[:len(padded)]
                    index.append(np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[starts])
                    length.append(np.minimum(WINDOW, len(ids) - starts))
                    doc.append(np.full(len(starts), d))
                    held += len(starts)
                    if held >= BATCH:
                        read()
                        held = 0
            if index:
                read()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sigmoid(best).astype(np.float64))], [*names, score_col])

    return rows.mapInArrow(run, rows.withColumn(score_col, F.lit(0.0)).schema)


def fit(docs: DataFrame, labels: DataFrame, rows: tuple[int, int] = ROWS, chars: int = CHARS) -> Network:
    """A network from labels of documents whose crc32 modulo 4 is not 2: at most ``rows`` clean and toxic ones of fewer than ``chars`` characters."""
    sample = sorted(labelled_sample(docs, labels, "toxic", 4, 2, rows, chars).collect())
    return train([r.text for r in sample], [r.label for r in sample])


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    net = fit(docs, table(spark, sf_dir, "labels"))
    out = score(docs.withColumn("held_out", remainder(F.col("doc_id"), 4) == 2), net)
    return out.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
