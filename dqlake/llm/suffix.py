"""Suffix-array dedup of long byte strings by prefix-free parsing.

A text is cut into phrases where a hash of the sliding 16-byte window triggers, so equal stretches are cut alike. A phrase
with the bytes that its last windows still need is a word of the dictionary; every window (a string of ``width`` bytes)
starts in exactly one word of the parse. The first document of each word comes from one aggregate over the dictionary: in
later documents all of the word's windows are repeats, so highly repetitive text is settled here. What is left are strings
shared by different words. Each window is represented by its least 16-byte hash, one position in eighteen; stretches of
windows whose representative lies in different words meet by that representative, where the suffix array of the stretches,
to the depth of a window, puts equal windows next to each other.

Documents are dealt to blocks, hashes to as many buckets. A block sends each distinct word, representative and stretch once.
A representative that many blocks have (a line that a third of all documents share) could still gather many different
surroundings in a bucket; its windows are therefore sent one by one under a 128-bit key of their own: equal ones come once
per block, all others spread over the buckets. Buckets answer with bits. Blocks are computed anew from the documents in each
of the three passes instead of being kept, which bounds the disk by the texts' own size.
"""

from __future__ import annotations


import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dqlake.llm.common import stage, table, tasks

GRAM = 16
EVERY = 192  # mean bytes of a phrase
PIECE = 1 << 18  # texts are worked on in pieces, which bounds the arrays
BLOCK = 2 << 20  # least bytes of text in a block
HOT = 64  # blocks with a representative from which on its windows go their own ways
LAST = 2**63 - 1  # stands for a null id
C1, C2, C3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * C3
    x ^= x >> np.uint64(29)
    x *= C1
    x ^= x >> np.uint64(32)
    return x


def eights(data: np.ndarray) -> np.ndarray:
    """Eight bytes from every position, as a number."""
    return np.ndarray((max(0, len(data) - 7),), dtype="<u8", buffer=data, strides=(1,))


def least_of(x: np.ndarray, span: int) -> np.ndarray:
    """Least of every ``span`` neighbours."""
    done = 1
    while done * 2 <= span:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    return np.minimum(x[:len(x) - (span - done)], x[span - done:]) if span > done else x


class Piece:
    """A stretch of a block's bytes: windows by start, the words they start in, and stretches that share a representative."""

    def __init__(self, held: list[tuple[int, int, memoryview]], ids: np.ndarray, width: int) -> None:
        """``held``: (document, place in it, bytes) of the texts laid end to end here."""
        lengths = np.array([len(p) for _, _, p in held])
        starts = np.cumsum(lengths) - lengths
        self.data = np.frombuffer(b"".join(p for _, _, p in held), dtype=np.uint8)
        self.where = [(d, at, n - width + 1) for (d, at, _), n in zip(held, lengths.tolist(), strict=True)]
        self.width, size = width, len(self.data)
        n = size - width + 1
        u = eights(self.data)
        gram = mixed(u[:-8] * C1 + mixed(u[8:] * C2))
        rep = least_of(gram, width - GRAM + 1)[:n]
        cut = gram[:n] % np.uint64(EVERY) == 0
        cut[starts[starts < n]] = True
        begin = np.flatnonzero(cut)
        border = np.r_[starts, size]
        end = np.minimum(np.r_[begin[1:], n] + width - 1, border[np.searchsorted(border, begin, side="right")])
        self.phrase = np.repeat(np.arange(len(begin), dtype=np.int32), np.diff(np.r_[begin, n]))
        view = memoryview(self.data)
        names = b"".join(xxhash.xxh3_128_digest(view[a:b]) if b - a >= width else bytes(16) for a, b in zip(begin.tolist(), end.tolist(), strict=True))
        self.names = np.frombuffer(names, dtype="<u8").reshape(-1, 2)
        self.whole = np.flatnonzero(end - begin >= width)
        self.doc = ids[[d for d, _, _ in held]][np.searchsorted(starts, begin, side="right") - 1]
        valid = np.ones(n, dtype=bool)  # not across documents
        for s, m in zip(starts.tolist(), lengths.tolist(), strict=True):
            valid[s + m - width + 1:s + m] = False
        self.valid = valid
        new = np.r_[True, (rep[1:] != rep[:-1]) | (valid[1:] != valid[:-1])]
        new[starts[starts < n]] = True
        at = np.flatnonzero(new)
        stop = np.r_[at[1:], n]
        fine = valid[at]
        self.at, self.stop = at[fine], stop[fine]
        self.rep = mixed(rep[self.at])  # least values are small ones; mixed anew they spread over the buckets
        total = np.r_[np.uint64(0), np.cumsum(mixed(self.names[:, 0] + C1))]
        first, last = self.phrase[self.at], self.phrase[self.stop - 1]
        self.tag = total[last + 1] - total[first]  # of all words that the stretch runs through
        self.tag[self.tag == 0] = 1

    def keys(self, at: np.ndarray) -> np.ndarray:
        """128-bit keys of the windows that start at ``at``."""
        u, out = eights(self.data), []
        offsets = [*range(0, self.width - 8, 8), self.width - 8]
        for c, d in ((C1, C2), (C2, C3)):
            h = np.full(len(at), d, dtype=np.uint64)
            for o in offsets:
                h = mixed((h ^ u[at + o]) * c)
            out.append(h)
        return np.stack(out, axis=1)


def joined(arrays: list[np.ndarray], empty: np.ndarray) -> np.ndarray:
    return np.concatenate(arrays) if arrays else empty


class Block:
    """The documents of a block in order of id, cut into pieces, with its distinct words and representatives."""

    def __init__(self, docs: pa.Table, width: int) -> None:
        ids = pc.fill_null(docs["doc_id"], LAST).combine_chunks().to_numpy()
        texts = [t.as_buffer() for t in docs["text"].combine_chunks()]
        row = np.argsort(ids, kind="stable")
        self.ids, self.texts, self.width = ids[row], [texts[i] for i in row], width
        self.known = docs["doc_id"].is_valid().to_numpy(zero_copy_only=False)[row]
        self.pieces = list(self.cut())
        names = joined([p.names[p.whole] for p in self.pieces], np.empty((0, 2), np.uint64))
        self.words, self.first, self.word = least_value(names, joined([p.doc[p.whole] for p in self.pieces], np.empty(0, np.int64)))
        rep = joined([p.rep for p in self.pieces], np.empty(0, np.uint64))
        tag = joined([p.tag for p in self.pieces], np.empty(0, np.uint64))
        order = np.argsort(rep, kind="stable")
        new = np.flatnonzero(np.r_[True, rep[order][1:] != rep[order][:-1]]) if len(rep) else np.empty(0, np.int64)
        self.reps, self.stretch = rep[order][new], np.empty(len(rep), np.int64)
        self.stretch[order] = np.repeat(np.arange(len(new)), np.diff(np.r_[new, len(rep)]))
        low, high = (f.reduceat(tag[order], new) if len(rep) else tag for f in (np.minimum, np.maximum))
        self.tags = np.where(low == high, low, np.uint64(0))  # zero: in several words of this block alone

    def cut(self) -> Iterator[Piece]:
        held, size = [], 0
        for d, text in enumerate(self.texts):
            for at in range(0, len(text) - self.width + 1, PIECE):
                part = memoryview(text)[at:at + PIECE + self.width - 1]
                held.append((d, at, part))
                size += len(part)
                if size >= PIECE:
                    yield Piece(held, self.ids, self.width)
                    held, size = [], 0
        if held:
            yield Piece(held, self.ids, self.width)


def least_value(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, the least value of each, and the number of each row's key."""
    order = np.argsort(keys[:, 0], kind="stable")
    k = keys[order]
    same = k[1:, 0] == k[:-1, 0]
    if (same & (k[1:, 1] != k[:-1, 1])).any():
        order = np.lexsort((keys[:, 1], keys[:, 0]))
        k = keys[order]
    new = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]).any(axis=1)]) if len(k) else np.empty(0, np.int64)
    number = np.empty(len(k), dtype=np.int64)
    number[order] = np.repeat(np.arange(len(new)), np.diff(np.r_[new, len(k)]))
    return k[new], np.minimum.reduceat(values[order], new) if len(new) else values, number


def by_bucket(lead: np.ndarray, buckets: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) of ordered 64-bit numbers; a bucket is a range of them."""
    edge = np.searchsorted(lead, np.array([b * 2**64 // buckets for b in range(1, buckets)], dtype=np.uint64))
    for b, (i, j) in enumerate(zip(np.r_[0, edge].tolist(), np.r_[edge, len(lead)].tolist(), strict=True)):
        if j > i:
            yield b, i, j


def packed(block: int, kind: str, buckets: int, columns: list[np.ndarray]) -> Iterator[dict]:
    """Rows for the buckets; the first column is in order and leads."""
    lead = columns[0] if columns[0].ndim == 1 else columns[0][:, 0]
    for b, i, j in by_bucket(lead, buckets):
        yield {"bucket": b, "kind": kind, "block": block, "n": j - i, "data": b"".join(np.ascontiguousarray(c[i:j]).tobytes() for c in columns)}


SENT = pa.schema([("bucket", pa.int32()), ("kind", pa.string()), ("block", pa.int32()), ("n", pa.int32()), ("data", pa.binary())])
SENT_SQL = "bucket int, kind string, block int, n int, data binary"


def unpacked(rows: pa.Table, kinds: list[tuple[type, int]]) -> list[np.ndarray]:
    """The columns of all rows, one after the other; what follows them in a row is returned last."""
    out: list[list] = [[] for _ in range(len(kinds) + 1)]
    for n, data in zip(rows["n"].to_pylist(), rows["data"].combine_chunks(), strict=True):
        at, buffer = 0, data.as_buffer()
        for column, (kind, wide) in zip(out[:-1], kinds, strict=True):
            column.append(np.frombuffer(buffer, dtype=kind, count=n * wide, offset=at).reshape((n, wide) if wide > 1 else n))
            at += column[-1].nbytes
        out[-1].append(np.frombuffer(buffer, dtype=np.uint8, offset=at) if at < buffer.size else np.empty(0, np.uint8))
    return [np.concatenate(c) for c in out]


def answer(rows: pa.Table, width: int, hot: int) -> pa.Table:
    """Bits for every row sent to a bucket, in its order.

    Words and windows: a smaller document has it. Representatives: two words have it; at least ``hot`` blocks have it.
    Stretches: for each window, whether a smaller document has it, from the suffix array of all stretches of the bucket.
    """
    kind, sent = rows["kind"][0].as_py(), rows["n"].to_numpy()
    if kind == "rep":
        keys, tags, _ = unpacked(rows, [(np.uint64, 1)] * 2)
        order = np.argsort(keys, kind="stable")
        new = np.flatnonzero(np.r_[True, keys[order][1:] != keys[order][:-1]])
        count = np.diff(np.r_[new, len(keys)])
        low, high = np.minimum.reduceat(tags[order], new), np.maximum.reduceat(tags[order], new)
        bits = np.empty((len(keys), 2), dtype=bool)
        bits[order, 0] = np.repeat((low != high) | (low == 0), count)
        bits[order, 1] = np.repeat(count >= hot, count)
        bits, counts = bits.ravel(), 2 * sent
    elif kind == "stretch":
        lengths, docs, data = unpacked(rows, [(np.int32, 1), (np.int64, 1)])
        windows = lengths - width + 1
        start = np.cumsum(lengths) - lengths
        first = np.cumsum(windows) - windows
        at = np.repeat(start - first, windows) + np.arange(windows.sum())
        order, new = suffix_runs(data, at, width)
        value = np.repeat(docs, windows)
        least = np.minimum.reduceat(value[order], new)
        bits = np.empty(len(at), dtype=bool)
        bits[order] = np.repeat(least, np.diff(np.r_[new, len(at)])) < value[order]
        counts = np.add.reduceat(windows, np.cumsum(sent) - sent)
    else:
        keys, values, _ = unpacked(rows, [(np.uint64, 2), (np.int64, 1)])
        _, least, number = least_value(keys, values)
        bits, counts = least[number] < values, sent
    data = [np.packbits(b).tobytes() for b in np.split(bits, np.cumsum(counts)[:-1])]
    return pa.table({"bucket": rows["bucket"], "kind": rows["kind"], "block": rows["block"], "n": pa.array(counts, pa.int32()), "data": pa.array(data, pa.binary())}).cast(SENT)


def suffix_runs(data: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes that start at ``at`` in order, to the depth of a window, and where equal ones begin."""
    text = np.lib.stride_tricks.sliding_window_view(data, width)[at].view(f"S{width}")[:, 0]
    order, new = np.argsort(text, kind="stable"), np.ones(len(at), dtype=bool)
    for i in range(1, len(at), 1 << 16):
        new[i:i + (1 << 16)] = text[order[i:i + (1 << 16)]] != text[order[i - 1:i - 1 + (1 << 16)]][:len(new[i:i + (1 << 16)])]
    return order, np.flatnonzero(new)


def told(replies: pa.Table, kind: str) -> np.ndarray:
    """The bits that a block got for what it sent of a kind, in its order."""
    rows = replies.filter(pc.equal(replies["kind"], kind)).sort_by("bucket")
    bits = [np.unpackbits(np.frombuffer(d.as_buffer(), np.uint8), count=n).astype(bool) for n, d in zip(rows["n"].to_pylist(), rows["data"].combine_chunks(), strict=True)]
    return np.concatenate(bits) if bits else np.empty(0, bool)


class Settled:
    """A block with the answers about its words and representatives, and what is still open.

    ``gone``: per piece, the windows known to be repeats. ``stretches``: distinct stretches of open windows by content, with
    their representative and first document. ``keys``, ``first``: distinct open windows whose representative is hot.
    """

    def __init__(self, block: Block, replies: pa.Table) -> None:
        self.block, width = block, block.width
        earlier, shared = told(replies, "word"), told(replies, "rep").reshape(-1, 2)
        self.gone, self.open, self.hot, keys, docs = [], [], [], [], []
        self.stretches: dict[bytes, list[int]] = {}
        w = r = 0
        for p in block.pieces:
            word = block.word[w:w + len(p.whole)]
            stretch = block.stretch[r:r + len(p.at)]
            w, r = w + len(word), r + len(stretch)
            copied = np.zeros(len(p.names), dtype=bool)
            copied[p.whole] = earlier[word] | (p.doc[p.whole] > block.first[word])
            gone = copied[p.phrase] & p.valid
            edge = np.r_[0, np.cumsum(gone)]
            some = np.flatnonzero(shared[stretch, 0] & (edge[p.stop] - edge[p.at] < p.stop - p.at))
            is_hot = shared[stretch[some], 1]
            view, spans = memoryview(p.data), []
            for at, stop, rep, d in zip(p.at[some[~is_hot]].tolist(), p.stop[some[~is_hot]].tolist(), p.rep[some[~is_hot]].tolist(), p.doc[p.phrase[p.at[some[~is_hot]]]].tolist(), strict=True):
                while at < stop and gone[at]:
                    at += 1
                while stop > at and gone[stop - 1]:
                    stop -= 1
                text = bytes(view[at:stop + width - 1])
                spans.append((at, stop, text))
                known = self.stretches.setdefault(text, [rep, d])
                known[1] = min(known[1], d)
            hot = some[is_hot]
            count = p.stop[hot] - p.at[hot]
            at = np.repeat(p.at[hot] - (np.cumsum(count) - count), count) + np.arange(count.sum())
            at = at[~gone[at]]
            self.gone.append(gone)
            self.open.append(spans)
            self.hot.append(at)
            keys.append(p.keys(at))
            docs.append(p.doc[p.phrase[at]])
        self.keys, self.first, self.number = least_value(joined(keys, np.empty((0, 2), np.uint64)), joined(docs, np.empty(0, np.int64)))
        self.order = sorted((rep, text, doc) for text, (rep, doc) in self.stretches.items())

    def send(self, number: int, buckets: int) -> Iterator[dict]:
        yield from packed(number, "window", buckets, [self.keys, self.first])
        for b, i, j in by_bucket(np.array([o[0] for o in self.order], dtype=np.uint64), buckets):
            some = self.order[i:j]
            head = np.array([len(o[1]) for o in some], np.int32).tobytes() + np.array([o[2] for o in some], np.int64).tobytes()
            yield {"bucket": b, "kind": "stretch", "block": number, "n": j - i, "data": head + b"".join(o[1] for o in some)}


def removed(block: Block, replies: pa.Table) -> list[np.ndarray]:
    """Per document of the block the mask of its bytes that go."""
    settled, width = Settled(block, replies), block.width
    earlier, bits = told(replies, "window"), told(replies, "stretch")
    place, at = {}, 0
    for _, text, doc in settled.order:
        n = len(text) - width + 1
        place[text] = doc, bits[at:at + n]
        at += n
    masks = [np.zeros(len(t), dtype=bool) for t in block.texts]
    h = 0
    for p, gone, spans, hot in zip(block.pieces, settled.gone, settled.open, settled.hot, strict=True):
        number = settled.number[h:h + len(hot)]
        h += len(hot)
        gone[hot] = earlier[number] | (p.doc[p.phrase[hot]] > settled.first[number])
        for i, j, text in spans:
            doc, found = place[text]
            if p.doc[p.phrase[i]] > doc:
                gone[i:j] = True
            else:
                gone[i:j] |= found
        base = 0
        for d, start, n in p.where:
            count = np.cumsum(np.r_[gone[base:base + n], np.zeros(width - 1, dtype=bool)])
            count[width:] -= count[:-width].copy()
            masks[d][start:start + n + width - 1] |= count > 0
            base += n + width - 1
    return masks


def remove_repeats(docs: DataFrame, width: int = 50, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (binary), a row per row of ``docs``.

    Every byte goes that is covered by a string of ``width`` bytes that also starts in a document with a smaller id; strings are
    judged on the whole input. Texts are their UTF-8 bytes, null is empty; texts shorter than a string lose nothing. Rows that
    share an id never remove from each other; rows without id come after all others and not from each other. Other columns are
    ignored. An empty table gives an empty table. ``width`` is at least 32.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    size = max(BLOCK, math.isqrt(256 * total))  # larger blocks for larger inputs keep the rows between blocks and buckets few
    n = max(1, math.ceil(total / size), min(tasks(spark), total // (BLOCK // 8)))
    blocks = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int")).groupBy("block")

    def first_pass(group: pa.Table) -> pa.Table:
        block, number = Block(group, width), group["block"][0].as_py()
        return pa.Table.from_pylist([*packed(number, "word", n, [block.words, block.first]), *packed(number, "rep", n, [block.reps, block.tags])], SENT)

    def second_pass(group: pa.Table, replies: pa.Table) -> pa.Table:
        if not len(group):
            return SENT.empty_table()
        return pa.Table.from_pylist([*Settled(Block(group, width), replies).send(group["block"][0].as_py(), n)], SENT)

    def third_pass(group: pa.Table, replies: pa.Table) -> pa.Table:
        if not len(group):
            return out.empty_table()
        block, found = Block(group, width), []
        for i, (text, gone) in enumerate(zip(block.texts, removed(block, replies), strict=True)):
            kept = np.frombuffer(text, np.uint8)[~gone].tobytes() if len(text) else b""
            spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
            found.append((int(block.ids[i]) if block.known[i] else None, len(text), int(gone.sum()), spans, kept))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*found, strict=True), out.types, strict=True)], schema=out)

    def meet(group: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()  # what the group before took
        return answer(group, width, hot)

    out = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])
    by = ["kind", "bucket"]
    sent = blocks.applyInArrow(first_pass, SENT_SQL)
    replies = stage(sent.groupBy(*by).applyInArrow(meet, SENT_SQL), "repeat-words")
    sent = blocks.cogroup(replies.groupBy("block")).applyInArrow(second_pass, SENT_SQL)
    more = stage(sent.groupBy(*by).applyInArrow(meet, SENT_SQL), "repeat-windows")
    return blocks.cogroup(replies.union(more).groupBy("block")).applyInArrow(third_pass, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
