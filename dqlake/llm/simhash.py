"""SimHash near-dedup by the generalised pigeonhole principle.

The 64 bits are dealt to partitions so that correlated bits lie together. A fingerprint gets a threshold per partition whose
sum is the wanted distance less the number of partitions plus one (-1: the partition is not probed); then two fingerprints
within the distance agree within the threshold in at least one partition. A dynamic program picks the thresholds with the
fewest estimated candidates for each fingerprint. Candidates are met by partition value and verified on all 64 bits.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dqlake.llm.common import release, stage, table
from dqlake.llm.graph import components

COUNTED = 16  # bits of a partition that the candidate estimate looks at
CELL = 4096  # index entries that a task holds at once
PROBE = 32  # what sending a probe costs, in verified candidates
ROUND = 1024  # bytes of entries and probes that a round of partitions moves for each fingerprint, about
TURNS = 4  # parts by shingle in which prefixes meet, one after the other
SAMPLE = 20_000  # documents whose shingles are counted to tell frequent ones; any order of shingles gives the same links
FREQUENT = 2**18  # shingles that are known to be frequent, at most
C1, C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def hashes_of(text: bytes, words: int) -> np.ndarray:
    """XXH64 (seed 42) of all shingles of a text; none for a text without words."""
    tokens = text.lower().split()  # of bytes: A-Z only, and the six ASCII blanks
    if not tokens:
        return np.empty(0, dtype=np.uint64)
    shingles = map(b" ".join, zip(*(tokens[i:] for i in range(words)), strict=False)) if len(tokens) > words else iter([b" ".join(tokens)])
    return np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(42)), dtype=np.uint64, count=max(1, len(tokens) - words + 1))


def shingle_set(text: bytes, words: int) -> np.ndarray:
    """The distinct hashes of a text's shingles in order; none for a text without words."""
    return np.unique(hashes_of(text, words))


def majority(hashes: np.ndarray, bits: int) -> bytes:
    """Majority of the bits of the hashes; bits beyond 64 come from mixing them. Zero without hashes."""
    ones = np.zeros(bits, dtype=np.int64)
    for at in range(0, len(hashes), 255):  # as many as a byte counts
        block = hashes[at:at + 255]
        words = np.empty((len(block), bits // 64), dtype=np.uint64)
        words[:, 0] = block
        for w in range(1, bits // 64):
            word = (block ^ np.uint64(int(C1) * w % 2**64)) * C2
            word = (word ^ (word >> np.uint64(32))) * C1
            words[:, w] = word ^ (word >> np.uint64(29))
        ones += np.add.reduce(np.unpackbits(words.view(np.uint8), axis=1, bitorder="little"), axis=0, dtype=np.uint8)
    return np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8").astype(">u8").tobytes()


def fingerprint(text: bytes, words: int, bits: int = 64, repeats: bool = True) -> bytes:
    """Majority of the bits of all shingles' hashes; ``repeats`` counts a shingle as often as it occurs."""
    return majority(hashes_of(text, words) if repeats else shingle_set(text, words), bits)


def digest_of(shingles: np.ndarray) -> bytes:
    return hashlib.md5(shingles.tobytes()).digest()


def fingerprints(
    docs: DataFrame, words: int = 3, bits: int = 64, repeats: bool = True, id_col: str = "doc_id", text_col: str = "text", digest: bool = False,
) -> DataFrame:
    """(doc_id, fp): one row per row of ``docs``; fp is binary, the highest bit of each 64 first; ``digest`` appends that of the set of shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in batch.column(1)]
            found = (hashes_of(t, words) if repeats else shingle_set(t, words) for t in texts)
            fps = [majority(h, bits) + (digest_of(np.unique(h)) if digest else b"") for h in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.binary())], ["doc_id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp binary")


def words_of(column: pa.Array) -> np.ndarray:
    """[n, words] of a column of fingerprints."""
    if not len(column):
        return np.empty((0, 1), np.uint64)
    width = len(column[0].as_buffer())
    return np.frombuffer(b"".join(v.as_buffer() for v in column), dtype=">u8").astype(np.uint64).reshape(-1, width // 8)


def column_of(fps: np.ndarray) -> pa.Array:
    data = np.ascontiguousarray(fps.astype(">u8"))
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(8 * fps.shape[1]), len(fps), [None, pa.py_buffer(data)]).cast(pa.binary())


def bits_of(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.view(np.uint8), axis=1, bitorder="little")


def correlation(fps: DataFrame, bits: int) -> np.ndarray:
    """[bits, bits] sums of bit agreements less disagreements; their number does not depend on the input."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((bits, bits))
        for batch in batches:
            if batch.num_rows:
                signs = bits_of(words_of(batch.column(0))).astype(np.float32) * 2 - 1
                total += signs.T @ signs
        yield pa.RecordBatch.from_arrays([pa.array(range(bits), pa.int32()), pa.array([r.tobytes() for r in total], pa.binary())], ["i", "sums"])

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(v.as_buffer()) for v in group["sums"].combine_chunks())
        return pa.table({"i": group["i"].slice(0, 1), "sums": pa.array([total.tobytes()], pa.binary())})

    out = np.zeros((bits, bits))
    summed = stage(fps.select("fp").mapInArrow(run, "i int, sums binary").groupBy("i").applyInArrow(add, "i int, sums binary"), "correlation")
    for i, sums in summed.collect():
        out[i] = np.frombuffer(sums)
    release(summed)
    return out


def deal_bits(agree: np.ndarray, parts: int) -> list[list[int]]:
    """Partitions of nearly equal size; each starts with the strongest free pair and takes the bit most correlated with it."""
    strength, rest, out = np.abs(agree), set(range(len(agree))), []
    for p in range(parts):
        size, free = math.ceil(len(rest) / (parts - p)), sorted(rest)
        if size >= 2:
            sub = np.triu(strength[np.ix_(free, free)], 1)
            i, j = np.unravel_index(np.argmax(sub), sub.shape) if sub.max() > 0 else (0, 1)
            group = [free[i], free[j]]
        else:
            group = [free[0]]
        while len(group) < size:
            left = [b for b in free if b not in group]
            group.append(max(left, key=lambda b: (strength[b, group].sum(), -b)))
        rest -= set(group)
        out.append(group)
    return out


def values(fps: np.ndarray, group: list[int]) -> np.ndarray:
    """The partition's bits, gathered into a number; its first bits are the lowest."""
    out = np.zeros(len(fps), dtype=np.uint64)
    for at, bit in enumerate(group):
        out |= ((fps[:, bit // 64] >> np.uint64(bit % 64)) & np.uint64(1)) << np.uint64(at)
    return out.astype(np.int64)


def near_counts(counts: np.ndarray, bits: int, most: int) -> np.ndarray:
    """[t, v]: how many counted values lie within t bits of v; each bit in turn is kept or flipped."""
    shells = [counts.astype(np.float64)] + [np.zeros(len(counts)) for _ in range(most)]
    index = np.arange(len(counts))
    for b in range(bits):
        flipped = index ^ (1 << b)
        shells = [shells[d] + (shells[d - 1][flipped] if d else 0) for d in range(most + 1)]
    return np.cumsum(shells, axis=0)


def allocate(costs: list[np.ndarray], units: int) -> np.ndarray:
    """[n, parts]: units per partition (threshold + 1) that add up to ``units`` at least total cost; costs[p] is [given, n]."""
    n, most = costs[0].shape[1], costs[0].shape[0]
    best, choice = np.full((units + 1, n), np.inf), []
    best[0] = 0
    for cost in costs:
        least, chosen = np.full((units + 1, n), np.inf), np.zeros((units + 1, n), dtype=np.int64)
        for used in range(units + 1):
            for given in range(min(used + 1, most)):
                total = best[used - given] + cost[given]
                better = total < least[used]
                least[used][better] = total[better]
                chosen[used][better] = given
        best = least
        choice.append(chosen)
    out, left = np.zeros((n, len(costs)), dtype=np.int64), np.full(n, units)
    for p in range(len(costs) - 1, -1, -1):
        out[:, p] = choice[p][left, np.arange(n)]
        left = left - out[:, p]
    return out


def masks(bits: int, radius: int) -> np.ndarray:
    return np.array([sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(bits), r)], dtype=np.int64)


def thresholds(groups: list[list[int]], near: list[np.ndarray], units: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(fp, node) with ``units``: a byte per partition, its threshold + 1."""
    low, most = (1 << COUNTED) - 1, len(near[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                fps, costs = words_of(part.column(0)), []
                for p, g in enumerate(groups):
                    own, cost = values(fps, g) & low, np.zeros((most + 1, len(fps)))
                    thin = 2.0 ** -max(0, len(g) - COUNTED)
                    for t in range(most):
                        cost[t + 1] = near[p][t][own] * thin + PROBE * sum(math.comb(len(g), r) for r in range(t + 1))
                    costs.append(cost)
                given = [u.tobytes() for u in allocate(costs, units).astype(np.uint8)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(given, pa.binary())], ["fp", "node", "units"])
    return run


def units_of(column: pa.Array, parts: int) -> np.ndarray:
    return np.frombuffer(b"".join(v.as_buffer() for v in column), dtype=np.uint8).reshape(-1, parts)


def entry_counts(rows: DataFrame, groups: list[list[int]], most: int) -> list[int]:
    """Entries and probes that the rows of ``thresholds`` make, by partition."""
    parts = len(groups)
    ball = np.array([[1 + sum(math.comb(len(g), r) for r in range(1, u)) for u in range(most + 2)] for g in groups])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(parts, dtype=np.int64)
        for batch in batches:
            total += ball[np.arange(parts), units_of(batch.column(0), parts)].sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(parts), pa.int32()), pa.array(total)], ["part", "n"])

    out = [0] * parts
    for p, n in rows.select("units").mapInArrow(run, "part int, n long").groupBy("part").agg(F.sum("n")).collect():
        out[p] = n
    return out


def rounds(counts: list[int], most: float) -> list[list[int]]:
    """The partitions, a few after each other in a round, so that their rows add up to ``most`` or are those of one."""
    out: list[list[int]] = []
    for p, n in enumerate(counts):
        if out and sum(counts[q] for q in out[-1]) + n <= most:
            out[-1].append(p)
        else:
            out.append([p])
    return out


def entries(groups: list[list[int]], some: list[int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of ``thresholds`` to index entries (probe false) and probes (the ball around the value, but for the value) in some partitions.

    The entry itself stands for the probe of its own value: all entries of a value are compared.
    """
    def rows(fps: np.ndarray, nodes: np.ndarray, given: np.ndarray) -> Iterator[tuple[int, bool, np.ndarray, np.ndarray, np.ndarray]]:
        for p in some:
            own, g = values(fps, groups[p]), groups[p]
            yield p, False, own, fps, nodes
            for t in range(1, int(given[:, p].max())):
                mine = np.flatnonzero(given[:, p] == t + 1)
                if len(mine):
                    flips = masks(len(g), t)[1:]
                    yield p, True, (own[mine, None] ^ flips).ravel(), np.repeat(fps[mine], len(flips), axis=0), np.repeat(nodes[mine], len(flips))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps, nodes, given = words_of(batch.column(0)), batch.column(1).to_numpy(), units_of(batch.column(2), len(groups))
            for at in range(0, len(fps), 1024):
                for p, probe, value, fp, node in rows(fps[at:at + 1024], nodes[at:at + 1024], given[at:at + 1024]):
                    n = len(node)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, p, np.int32)), pa.array(value), pa.array(np.full(n, probe)), column_of(fp), pa.array(node)], ["part", "value", "probe", "fp", "node"])
    return run


def join(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give all entries that ``a`` and ``b`` connect one label, the least."""
    while True:
        before = label.copy()
        least = np.minimum(label[a], label[b])
        for side in (a, b, before[a], before[b]):
            np.minimum.at(label, side, least)
        while not np.array_equal(label, label[label]):
            label[:] = label[label]
        if np.array_equal(label, before):
            return


def within(some: np.ndarray, others: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs within the distance, by the first."""
    apart = np.bitwise_count(some[:, 0, None] ^ others[None, :, 0]).astype(np.uint16)
    for w in range(1, some.shape[1]):
        apart += np.bitwise_count(some[:, w, None] ^ others[None, :, w])
    return np.nonzero(apart <= distance)


def verified(distance: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Cells in order, index entries before probes, to links that connect what the true links of the cell connect.

    A probe gives one link, to the first entry within the distance; entries that are linked or share a probe are joined in the
    cell and linked once. So a cell returns fewer links than it has rows, however many pairs lie within the distance.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell: np.ndarray | None = None
        index = nodes = label = np.empty(0, np.int64)
        out_a: list[np.ndarray] = []
        out_b: list[np.ndarray] = []

        def close() -> None:
            inner = np.flatnonzero(label != np.arange(len(label)))
            out_a.append(nodes[inner])
            out_b.append(nodes[label[inner]])

        def flush() -> pa.RecordBatch:
            arrays = [pa.array(np.concatenate(o)) if o else pa.array([], pa.int64()) for o in (out_a, out_b)]
            out_a.clear()
            out_b.clear()
            return pa.RecordBatch.from_arrays(arrays, ["a", "b"])

        for batch in batches:
            part, value, chunk, probe, node = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("part", "value", "chunk", "probe", "node"))
            fp = words_of(batch.column("fp"))
            key = np.stack([part.astype(np.int64), value, chunk.astype(np.int64)], axis=1)
            turn = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1)]) if len(fp) else np.empty(0, np.int64)
            for a, b in zip(turn.tolist(), np.r_[turn[1:], len(fp)].tolist(), strict=True):
                if cell is None or not np.array_equal(key[a], cell):
                    close()
                    cell, index, nodes, label = key[a].copy(), fp[:0], node[:0], np.empty(0, np.int64)
                first = a + int(np.searchsorted(probe[a:b], True))
                if first > a:
                    old = len(index)
                    index, nodes = np.concatenate([index, fp[a:first]]), np.concatenate([nodes, node[a:first]])
                    label = np.r_[label, np.arange(old, len(index))]
                    for at in range(old, len(index), 256):
                        r, c = within(index[at:at + 256], index[:at + 256], distance)
                        r, c = (r + at)[c < r + at], c[c < r + at]
                        if len(r):
                            join(label, r, c)
                for at in range(first, b, 256) if len(index) else ():
                    some, names = fp[at:min(b, at + 256)], node[at:min(b, at + 256)]
                    r, c = within(some, index, distance)
                    if not len(r):
                        continue
                    start = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
                    lead = c[start]
                    out_a.append(names[r[start]])
                    out_b.append(nodes[lead])
                    leads = np.repeat(lead, np.diff(np.r_[start, len(r)]))
                    if (leads != c).any():
                        pairs = np.unique(leads * len(index) + c)
                        join(label, pairs // len(index), pairs % len(index))
            if sum(map(len, out_a)) > 100_000:
                yield flush()
        close()
        yield flush()
    return run


def links(fps: DataFrame, bits: int, parts: int, units: int, distance: int, most: int, cell: int = CELL) -> DataFrame:
    """(a, b): links among the nodes of ``fps`` (node, fp) that connect what pairs within ``distance`` bits connect.

    Each fingerprint's thresholds (at most ``most``) plus one add up to ``units``; with distance + 1 units every pair within the
    distance is met. A value with more than ``cell`` index entries is dealt into cells of about ``cell``, which all its entries
    and probes visit; a cell holds its entries and streams the visitors. Thresholds are stored; entries and probes are made from
    them a few partitions at a time (``ROUND``), as all at once would be several times the texts on disk.
    """
    groups = deal_bits(correlation(fps, bits), parts)

    def counted(width: int) -> DataFrame:
        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                fp = words_of(batch.column(0))
                for p, g in enumerate(groups if batch.num_rows else []):
                    v, n = np.unique(values(fp, g[:width]), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), p, np.int32)), pa.array(v), pa.array(n)], ["part", "value", "n"])

        return fps.select("fp").mapInArrow(count, "part int, value long, n long").groupBy("part", "value").agg(F.sum("n").alias("n"))

    counts = [np.zeros(1 << min(len(g), COUNTED), dtype=np.int64) for g in groups]  # at most parts * 2^16 numbers
    low = stage(counted(COUNTED), "low-values")
    seen = low.toArrow()
    part, value, n = (seen[c].to_numpy() for c in ("part", "value", "n"))
    for p in range(parts):
        counts[p][value[part == p]] = n[part == p]
    near = [near_counts(c, min(len(g), COUNTED), most)[:most + 1] for c, g in zip(counts, groups, strict=True)]
    every = low if max(map(len, groups)) <= COUNTED else counted(bits)
    large = stage(every.filter(F.col("n") > cell).select(F.col("part").alias("p_"), F.col("value").alias("v_"), F.ceil(F.col("n") / cell).cast("int").alias("cells")), "large-values")
    kept = stage(fps.select("fp", "node").mapInArrow(thresholds(groups, near, units), "fp binary, node long, units binary"), "thresholds")
    found = []
    for some in rounds(entry_counts(kept, groups, most), kept.count() * ROUND / (bits // 8 + 21)):
        rows = kept.mapInArrow(entries(groups, some), "part int, value long, probe boolean, fp binary, node long")
        met = rows.join(large, (F.col("part") == F.col("p_")) & (F.col("value") == F.col("v_")), "left").withColumn("cells", F.coalesce("cells", F.lit(1)))
        met = met.withColumn("own", F.when(~F.col("probe"), F.pmod(F.xxhash64("node"), F.col("cells")).cast("int")))
        dealt = met.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
        dealt = dealt.select("part", "value", "chunk", (~F.col("chunk").eqNullSafe(F.col("own"))).alias("probe"), "fp", "node")
        dealt = dealt.repartition("part", "value", "chunk").sortWithinPartitions("part", "value", "chunk", "probe")
        found.append(stage(dealt.mapInArrow(verified(distance), "a long, b long"), "fp-links"))
    release(low, large, kept)
    return together(found, "fp-links")


def together(found: list[DataFrame], label: str) -> DataFrame:
    """Stored tables of links as one; they are removed."""
    if len(found) == 1:
        return found[0]
    out = stage(reduce(DataFrame.union, found).distinct(), label)
    release(*found)
    return out


def grouped(rows: DataFrame, find: Callable[[DataFrame], DataFrame], spare: Column | None = None) -> DataFrame:
    """(doc_id, fp, component_id) of stored fingerprints; ``find`` links distinct ones.

    Copies and all others with one fingerprint are a single node of the graph, so groups of copies of any size cost nothing.
    ``spare`` names the nodes of which no row has an id.
    """
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    nodes = stage(nodes.withColumn("node", F.coalesce("least", F.xxhash64("fp") if spare is None else spare)), "nodes")
    found = find(nodes)
    tree = components(found).withColumnRenamed("node", "child")
    roots = stage(nodes.join(tree, nodes.node == tree.child, "left").select("fp", F.coalesce("component", "node").alias("root"), "least"), "roots")
    ids = stage(roots.groupBy("root").agg(F.min("least").alias("component_id")), "component-ids")
    named = stage(roots.join(ids, "root").select(F.col("fp").alias("of"), "component_id"), "components")
    release(found, nodes, roots, ids)
    return rows.join(named, rows.fp == named.of).select("doc_id", "fp", "component_id")


def near_duplicates(docs: DataFrame, words: int = 3, distance: int = 3, id_col: str = "doc_id", text_col: str = "text", cell: int = CELL) -> DataFrame:
    """(doc_id, fingerprint, component_id), a row per row of ``docs``.

    ``fingerprint``: 16 lower-case hex digits. ``component_id``: the smallest id reachable over 64-bit fingerprints that differ in
    at most ``distance`` bits; no such pair is missed. Null, empty and blank texts have fingerprint zero and link like any other;
    a text of fewer words than a shingle is one shingle. Repeated rows stay repeated; documents that share an id are one node.
    A row without id keeps its null id, and its component is the smallest id that is not null (null if there is none). Other
    columns are ignored. An empty table gives an empty table.
    """
    rows = stage(fingerprints(docs, words, 64, True, id_col, text_col), "fingerprints")

    def find(nodes: DataFrame) -> DataFrame:
        n = nodes.count()
        parts = 4 if n < 2**18 else 3 if n < 2**24 else 2  # so that a value of a partition holds few fingerprints
        return links(nodes, 64, parts, distance + 1, distance, distance, cell)

    out = grouped(rows, find)
    return out.select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


def texts_of(docs: DataFrame, nodes: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """The columns of ``nodes`` and ``text``: the texts of the documents by node; rows without id have the digest's hash as node."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [digest_of(shingle_set(t.as_buffer().to_pybytes() if t.is_valid else b"", words)) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["text", "digest"])

    rows = docs.select(F.col(id_col).cast("long").alias("node"), F.col(text_col).cast("binary").alias("text"))
    spare = rows.filter("node IS NULL").select("text").distinct().mapInArrow(run, "text binary, digest binary")
    return rows.filter("node IS NOT NULL").union(spare.select(F.xxhash64("digest"), "text")).join(nodes, "node").select(*nodes.columns, "text")


def shingle_sets(texts: DataFrame, words: int) -> DataFrame:
    """(node, shingles): the sorted 64-bit hashes of each text's distinct shingles, as ``fingerprint`` takes them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_buffer().to_pybytes() if t.is_valid else b"", words).view(np.int64) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], ["node", "shingles"])

    return texts.select("node", "text").mapInArrow(run, "node long, shingles array<long>")


def similar_links(found: DataFrame, nodes: int, docs: DataFrame, words: int, similarity: float, id_col: str, text_col: str) -> DataFrame:
    """The links (a, b) whose texts' sets of shingles have a Jaccard similarity of ``similarity`` or more, by the sets themselves.

    A set is larger than its text, so a round takes as many links as have about half of the ``nodes`` for ends.
    """
    pairs = stage(found.distinct(), "links-to-compare")
    release(found)
    turns, out = max(1, math.ceil(4 * pairs.count() / max(1, nodes))), []
    for turn in range(turns):
        some = pairs.filter(F.pmod(F.xxhash64("a", "b"), F.lit(turns)) == turn)
        ends = stage(some.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "link-ends")
        sets = stage(shingle_sets(texts_of(docs, ends, words, id_col, text_col), words), "link-sets")
        both = F.size(F.array_intersect("left", "right"))
        alike = both >= similarity * (F.size("left") + F.size("right") - both) - 1e-9
        out.append(stage(some.join(sets.toDF("a", "left"), "a").join(sets.toDF("b", "right"), "b").filter(alike).select("a", "b").distinct(), "similar-links"))
        release(ends, sets)
    release(pairs)
    return together(out, "similar-links")


def parities(shingles: np.ndarray) -> bytes:
    """Bits by the lowest bits of the hashes, as many as there are shingles or up to twice that: whether their number is odd."""
    bits = max(64, 1 << (len(shingles) - 1).bit_length())
    counts = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def may_be_similar(similarity: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Pairs with sizes and parities to those that may have the similarity: sets differ in one shingle at least for each bit that differs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("a_size").to_numpy() + batch.column("b_size").to_numpy()
            most = sizes * ((1 - similarity) / (1 + similarity)) + 1e-6
            sides = [batch.column("a_bits"), batch.column("b_bits")]
            widths = np.stack([np.array([len(v.as_buffer()) for v in side], dtype=np.int64) for side in sides], axis=1).reshape(-1, 2)
            kept = np.zeros(len(sizes), dtype=bool)
            for pair in np.unique(widths, axis=0):
                at = np.flatnonzero((widths == pair).all(axis=1))
                folded = []
                for side, width in zip(sides, pair.tolist(), strict=True):
                    bits = np.frombuffer(b"".join(v.as_buffer() for v in side.take(pa.array(at))), dtype=np.uint64).reshape(len(at), -1)
                    while width > pair.min():
                        width //= 2
                        bits = bits[:, :width // 8] ^ bits[:, width // 8:]
                    folded.append(bits)
                kept[at] = np.bitwise_count(folded[0] ^ folded[1]).sum(axis=1, dtype=np.int64) <= most[at]
            yield batch.select(["a", "b"]).filter(pa.array(kept))
    return run


def prefixes(words: int, similarity: float, frequent: np.ndarray, often: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Texts to rows of their sets' prefixes: the shingles that come first when rare ones precede frequent ones.

    Two sets of the similarity share a shingle among the first n - ceil(similarity * n) + 1 of either, whatever the order is.
    A set's first row has its ``parities``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                tokens, sizes, bits = [np.empty(0, np.uint64)], [], []
                for text in part.column(2):
                    found = shingle_set(text.as_buffer().to_pybytes() if text.is_valid else b"", words)
                    sizes.append(len(found))
                    bits.append(parities(found) if len(found) else b"")
                    if len(frequent):
                        place = np.minimum(np.searchsorted(frequent, found), len(frequent) - 1)
                        found = found[np.argsort(np.where(frequent[place] == found, often[place], 0), kind="stable")]
                    tokens.append(found[:len(found) - math.ceil(similarity * len(found) - 1e-9) + 1])
                kept = np.array([len(t) for t in tokens[1:]], dtype=np.int64)
                of = np.repeat(np.arange(len(kept)), kept)
                place = np.arange(len(of)) - np.repeat(np.cumsum(kept) - kept, kept)
                columns = [pa.array(np.concatenate(tokens).view(np.int64)), part.column(0).take(pa.array(of)), part.column(1).take(pa.array(of))]
                rest = [pa.array(v.astype(np.int32)) for v in (np.array(sizes, dtype=np.int64)[of], place)]
                once = pa.array(bits, pa.binary()).take(pa.array(of, mask=place > 0))
                yield pa.RecordBatch.from_arrays([*columns, *rest, once], ["token", "node", "component", "size", "place", "bits"])
    return run


def remaining_links(nodes: DataFrame, linked: DataFrame, docs: DataFrame, words: int, similarity: float, id_col: str, text_col: str) -> DataFrame:
    """(a, b): every link of the similarity between ``nodes`` that ``linked`` leaves in different components, by prefix filtering.

    Shingles are ordered by their counts in a sample of at most about ``SAMPLE`` nodes. Nodes that share a shingle of their prefixes
    are candidates when the sets' sizes and the shingle's places leave room for the overlap, and parities of the sets do not rule it
    out; the sets themselves decide. Shingles meet in ``TURNS`` parts, so that a fraction of the prefixes is moved at a time.
    """
    tree = components(linked).withColumnRenamed("node", "child")
    named = nodes.select("node").distinct().join(tree, F.col("node") == F.col("child"), "left").select("node", F.coalesce("component", "node").alias("component"))
    named = stage(named, "node-components")
    total = named.count()
    sample = texts_of(docs, named.filter(F.pmod(F.xxhash64("node"), F.lit(max(1, math.ceil(total / SAMPLE)))) == 0), words, id_col, text_col)
    counted = shingle_sets(sample, words).select(F.explode("shingles").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    counted = stage(counted.filter("n > 2"), "sampled-shingles")
    seen = counted.orderBy(F.col("n").desc(), "token").limit(FREQUENT).toArrow()
    token, n = seen["token"].to_numpy().view(np.uint64), seen["n"].to_numpy()
    order = np.argsort(token)
    rows = texts_of(docs, named, words, id_col, text_col).select("node", "component", "text")
    rows = stage(rows.mapInArrow(prefixes(words, similarity, token[order], n[order]), "token long, node long, component long, size int, place int, bits binary"), "prefixes")
    bits = rows.filter("bits IS NOT NULL").select("node", "size", "bits")
    found = []
    for turn in range(TURNS):
        some = rows.filter(F.pmod("token", F.lit(TURNS)) == turn).drop("bits")
        mixed = some.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high").select("token")
        met = stage(some.join(mixed, "token", "left_semi").distinct(), "shared-prefixes")
        a, b = met.alias("a"), met.alias("b")
        need = (F.col("a.size") + F.col("b.size")) * (similarity / (1 + similarity)) - 1e-6
        room = F.least(F.col("a.size") - F.col("a.place"), F.col("b.size") - F.col("b.place")) >= need
        pairs = a.join(b, (F.col("a.token") == F.col("b.token")) & (F.col("a.node") < F.col("b.node")) & (F.col("a.component") != F.col("b.component")) & room)
        pairs = stage(pairs.select(F.col("a.node").alias("a"), F.col("b.node").alias("b")).distinct(), "prefix-pairs")
        release(met)
        ends = pairs.join(bits.toDF("a", "a_size", "a_bits"), "a").join(bits.toDF("b", "b_size", "b_bits"), "b")
        found.append(stage(ends.mapInArrow(may_be_similar(similarity), "a long, b long").distinct(), "likely-pairs"))
        release(pairs)
    release(named, rows, counted)
    return similar_links(together(found, "likely-pairs"), total, docs, words, similarity, id_col, text_col)


def similar_documents(
    docs: DataFrame, words: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text", width: int = 14, missed: float = 0.02,
) -> DataFrame:
    """(doc_id, component_id): documents whose sets of word shingles have a Jaccard similarity of ``similarity`` or more, chained.

    Sets of that similarity J have cosine 2J / (1 + J), and so differ in a share of arccos / pi of their fingerprints' bits. That
    share is too large for a guarantee at a bearable number of candidates. Fingerprints are made long enough, and partitions of
    ``width`` bits many enough, that a pair at the very threshold agrees in one but for a share ``missed``; candidates lie up to
    two standard deviations above the expected distance. What they link is then compared by the sets themselves, so nothing less
    similar is linked. The links that this misses between different components are found by ``remaining_links``, so none is lost
    (but for equal 64-bit hashes of different shingles). Documents of one set of shingles are one node. Rows as in ``near_duplicates``.
    """
    share = math.acos(2 * similarity / (1 + similarity)) / math.pi
    bits = 64 * math.ceil(math.log(missed) / math.log(1 - (1 - share) ** width) * width / 64)
    parts = bits // width
    distance = round(share * bits + 2 * math.sqrt(share * (1 - share) * bits))
    rows = stage(fingerprints(docs, words, bits, False, id_col, text_col, True), "fingerprints")

    def find(nodes: DataFrame) -> DataFrame:
        fps = nodes.select("node", F.substring("fp", 1, bits // 8).alias("fp"))
        near = similar_links(links(fps, bits, parts, parts, distance, 1), nodes.count(), docs, words, similarity, id_col, text_col)
        rest = remaining_links(nodes, near, docs, words, similarity, id_col, text_col)
        out = stage(near.union(rest), "all-links")
        release(near, rest)
        return out

    spare = F.xxhash64(F.substring("fp", bits // 8 + 1, 16))
    return grouped(rows, find, spare).select("doc_id", "component_id")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
