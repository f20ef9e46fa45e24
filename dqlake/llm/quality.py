"""Quality by attention-based multiple-instance learning, trained in numpy.

A document is a bag of passages of 64 words. Each passage is described by the frequencies of pairs of character classes and
a few word figures, and encoded by one layer; gated attention (tanh times sigmoid) weighs the passages, and a logistic output
scores the weighted sum. Only documents have labels: attention learns which passages carry them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dqlake.llm.common import table
from dqlake.llm.labelled import labelled_sample, remainder

PASSAGE = 64
ENCODED, GATE = 32, 16
ROWS = (2000, 3000)  # at most so many documents of low and high quality train the classifier
CHARS = 12_000  # of a document that trains it: fewer
CLASSES = 8


def class_table() -> np.ndarray:
    """The class of a byte: other, lower, upper, digit, blank, sentence mark, loud mark, beyond ASCII."""
    out = np.zeros(256, dtype=np.int64)
    for kind, members in ((1, range(97, 123)), (2, range(65, 91)), (3, range(48, 58)), (4, b" "), (5, b".,;:'\"-()"), (6, b"!?"), (7, range(128, 256))):
        out[list(members)] = kind
    return out


CLASS = class_table()
FEATURES = CLASSES * CLASSES + 6


def describe(words: list[str]) -> np.ndarray:
    """Features of a passage; zeros if it has no words."""
    out = np.zeros(FEATURES, dtype=np.float32)
    if not words:
        return out
    text = " ".join(words)
    kinds = CLASS[np.frombuffer(text.encode(), dtype=np.uint8)]
    if len(kinds) > 1:
        out[:CLASSES * CLASSES] = np.sqrt(np.bincount(kinds[:-1] * CLASSES + kinds[1:], minlength=CLASSES * CLASSES) / (len(kinds) - 1))
    n = len(words)
    out[CLASSES * CLASSES:] = (
        len(set(words)) / n, sum(map(str.__eq__, words, words[1:])) / n, min(len(text) / n, 40) / 10,
        sum(map(str.isupper, words)) / n, sum(map(str.istitle, words)) / n, np.log1p(n) / 4,
    )
    return out


def passages(text: str | None) -> Iterator[np.ndarray]:
    words = (text or "").split()
    for at in range(0, max(1, len(words)), PASSAGE):
        yield describe(words[at:at + PASSAGE])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Bags:
    """The classifier; a batch is all passages of its documents end to end, ``start`` is where each document begins."""

    def __init__(self, seed: int = 1) -> None:
        r = np.random.default_rng(seed)
        small = lambda *shape: (r.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.p = {
            "e": small(FEATURES, ENCODED), "eb": np.zeros(ENCODED, np.float32), "v": small(ENCODED, GATE), "u": small(ENCODED, GATE),
            "w": small(GATE), "o": small(ENCODED), "c": np.zeros(1, np.float32),
            "mean": np.zeros(FEATURES, np.float32), "scale": np.ones(FEATURES, np.float32),
        }

    def read(self, x: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, tuple]:
        p, size = self.p, np.diff(np.r_[start, len(x)])
        x = np.clip((x - p["mean"]) * p["scale"], -5, 5)
        h = np.tanh(x @ p["e"] + p["eb"])
        t, s = np.tanh(h @ p["v"]), sigmoid(h @ p["u"])
        a = (t * s) @ p["w"]
        a = np.exp(a - np.repeat(np.maximum.reduceat(a, start), size))
        a /= np.repeat(np.add.reduceat(a, start), size)
        z = np.add.reduceat(a[:, None] * h, start)
        return z @ p["o"] + p["c"][0], (x, h, t, s, a, z, size)

    def gradients(self, x: np.ndarray, start: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        logit, (x, h, t, s, a, z, size) = self.read(x, start)
        d = ((sigmoid(logit) - label) / len(label)).astype(np.float32)
        d_z = np.repeat(d[:, None] * p["o"], size, axis=0)
        d_a = (d_z * h).sum(axis=1)
        d_a = a * (d_a - np.repeat(np.add.reduceat(a * d_a, start), size))
        d_t, d_s = d_a[:, None] * p["w"] * s * (1 - t * t), d_a[:, None] * p["w"] * t * s * (1 - s)
        d_h = (a[:, None] * d_z + d_t @ p["v"].T + d_s @ p["u"].T) * (1 - h * h)
        return {"c": np.array([d.sum()]), "o": z.T @ d, "w": (t * s).T @ d_a, "v": h.T @ d_t, "u": h.T @ d_s, "e": x.T @ d_h, "eb": d_h.sum(axis=0)}


def train(texts: list[str], labels: list[int], rounds: int = 40, steps: int = 1500, batch: int = 64, rate: float = 0.003, seed: int = 1) -> Bags:
    """A classifier fitted to whole documents; few documents are read in more rounds. Same input, same classifier."""
    model, random = Bags(seed), np.random.default_rng(seed)
    if not texts:
        return model
    bags = [np.stack(list(passages(t))) for t in texts]
    every = np.concatenate(bags)
    model.p["mean"], model.p["scale"] = every.mean(axis=0), 1 / (every.std(axis=0) + 0.02)
    label = np.array(labels, dtype=np.float32)
    state, step = {}, 0
    for _ in range(max(rounds, steps * batch // len(texts))):
        order = random.permutation(len(texts))
        for i in range(0, len(order), batch):
            some = order[i:i + batch]
            sizes = np.array([len(bags[d]) for d in some])
            grads = model.gradients(np.concatenate([bags[d] for d in some]), np.cumsum(sizes) - sizes, label[some])
            step += 1
            for name, grad in grads.items():
                m, v = state.get(name, (0.0, 0.0))
                m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
                state[name] = m, v
                model.p[name] = (model.p[name] * (1 - rate * 0.01) - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return model


def score(docs: DataFrame, model: Bags, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score``, the probability of label 1 (a column of that name is replaced).

    Every passage of every text is encoded and weighed. Null and empty texts are one passage without words. Equal texts get equal
    scores. A passage is kept as 70 numbers, so a long text needs memory for a fraction of its own length.
    """
    rows = docs.drop("score")
    names, parameters = rows.columns, model.p

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Bags.__new__(Bags)
        reader.p = parameters
        for batch in batches:
            out, held, sizes = [], [], []

            def read() -> None:
                size = np.array(sizes)
                out.append(reader.read(np.stack(held), np.cumsum(size) - size)[0])
                held.clear()
                sizes.clear()

            for text in batch.column(names.index(text_col)):
                before = len(held)
                held.extend(passages(text.as_py()))
                sizes.append(len(held) - before)
                if len(held) >= 4096:
                    read()
            if held:
                read()
            scores = sigmoid(np.concatenate(out).astype(np.float64)) if out else np.empty(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*names, "score"])

    return rows.mapInArrow(run, rows.withColumn("score", F.lit(0.0)).schema)


def fit(docs: DataFrame, labels: DataFrame, rows: tuple[int, int] = ROWS, chars: int = CHARS) -> Bags:
    """A classifier from labels of documents whose crc32 modulo 5 is not 0: at most ``rows`` of each label, each of fewer than ``chars`` characters."""
    sample = sorted(labelled_sample(docs, labels, "quality", 5, 0, rows, chars).collect())
    return train([r.text for r in sample], [r.label for r in sample])


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    out = score(docs.withColumn("held_out", remainder(F.col("doc_id"), 5) == 0), model)
    return out.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
