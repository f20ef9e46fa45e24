"""Embedding near-dedup: hierarchical navigable small-world graphs per shard, audited beams, verified cosine, united components."""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dqlake.llm.common import release, stage, table
from dqlake.llm.graph import components

SHARD = 16384  # vectors in one graph
QUERIES = 8192  # vectors that one task looks up in one graph
DEGREE = 16  # neighbours kept above the ground layer; twice as many on it
BUILD_BEAM = 64
BEAM = 64  # first beam of a lookup
TOP = 128  # vectors of the top layer, which a search scans whole
AUDIT = 128  # true links that an audit sees at least, or it repeats all lookups of its task by brute force
RECALL = 0.98  # share of an audit's true links that must be found before beams stop widening
CHUNK = 256
COUNTS = ("there", "true", "checked", "beam")  # of a task's audit: links found, true links, lookups checked, the last beam


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision; scaled first, so that squares neither overflow nor vanish."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def keep_first(ids: np.ndarray) -> np.ndarray:
    """Mask of ids that are not negative and did not occur before in their row."""
    order = np.argsort(ids, axis=1, kind="stable")
    ranked = np.take_along_axis(ids, order, axis=1)
    fresh = np.ones(ids.shape, dtype=bool)
    fresh[:, 1:] = ranked[:, 1:] != ranked[:, :-1]
    out = np.empty_like(fresh)
    np.put_along_axis(out, order, fresh, axis=1)
    return out & (ids >= 0)


def beam_search(x: np.ndarray, near: np.ndarray, queries: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-first search of all queries at once over neighbour lists ``near`` (-1 pads): ids and similarities, best first."""
    n_q, rows = len(queries), np.arange(len(queries))[:, None]
    seen = np.zeros((n_q, len(x) + 1), dtype=bool)
    similar = lambda q, ids: np.where(ids >= 0, np.matmul(x[ids], queries[q][:, :, None])[:, :, 0], -np.inf)
    ids = np.where(keep_first(starts), starts, -1)
    seen[rows, ids] = True
    score = similar(np.arange(n_q), ids)
    done = ids < 0
    active = np.arange(n_q)
    while len(active):
        a_ids, a_score, a_done = ids[active], score[active], done[active]
        open_ = np.where(a_done, -np.inf, a_score)
        step = min(4, open_.shape[1])
        pick = np.argpartition(-open_, step - 1, axis=1)[:, :step]
        going = np.take_along_axis(open_, pick, axis=1) > -np.inf
        live = going.any(axis=1)
        if not live.all():
            active, a_ids, a_score, a_done, pick, going = active[live], a_ids[live], a_score[live], a_done[live], pick[live], going[live]
            if not len(active):
                break
        np.put_along_axis(a_done, pick, True, axis=1)
        fresh = np.where(going[:, :, None], near[np.take_along_axis(a_ids, pick, axis=1)], -1).reshape(len(active), -1)
        fresh = np.where(keep_first(fresh) & ~seen[active[:, None], fresh], fresh, -1)
        seen[active[:, None], fresh] = True
        a_ids = np.concatenate([a_ids, fresh], axis=1)
        a_score = np.concatenate([a_score, similar(active, fresh)], axis=1)
        a_done = np.concatenate([a_done, fresh < 0], axis=1)
        if a_ids.shape[1] > width:
            best = np.argpartition(-a_score, width - 1, axis=1)[:, :width]
            a_ids, a_score, a_done = (np.take_along_axis(v, best, axis=1) for v in (a_ids, a_score, a_done))
        if a_ids.shape[1] != ids.shape[1]:
            wide = a_ids.shape[1]
            ids_, score_, done_ = np.full((n_q, wide), -1), np.full((n_q, wide), -np.inf, dtype=score.dtype), np.ones((n_q, wide), dtype=bool)
            w = min(wide, ids.shape[1])
            order = np.argsort(-score, axis=1)[:, :w]
            ids_[:, :w], score_[:, :w], done_[:, :w] = (np.take_along_axis(v, order, axis=1) for v in (ids, score, done))
            ids, score, done = ids_, score_, done_
        ids[active], score[active], done[active] = a_ids, a_score, a_done
    order = np.argsort(-score, axis=1, kind="stable")
    return np.take_along_axis(ids, order, axis=1), np.take_along_axis(score, order, axis=1)


def diverse(x: np.ndarray, ids: np.ndarray, score: np.ndarray, most: int) -> np.ndarray:
    """Per row up to ``most`` of ``ids`` (best first, -1 pads): those nearer to the row's vector than to any taken; then the rest by rank."""
    between = np.matmul(x[ids], x[ids].transpose(0, 2, 1))
    taken = np.zeros(ids.shape, dtype=bool)
    closest = np.full(ids.shape, -np.inf, dtype=np.float32)
    for r in range(ids.shape[1]):
        fits = (ids[:, r] >= 0) & (score[:, r] > closest[:, r]) & (taken.sum(axis=1) < most)
        taken[:, r] = fits
        closest = np.where(fits[:, None], np.maximum(closest, between[:, r]), closest)
    rank = np.where(ids < 0, 2, np.where(taken, 0, 1))
    order = np.argsort(rank, axis=1, kind="stable")[:, :most]
    return np.take_along_axis(ids, order, axis=1)


class Graph:
    """Layers of neighbour lists over unit vectors; layer 0 holds all, each higher one a sample of the one below."""

    def __init__(self, x: np.ndarray, layers: list[np.ndarray], top: np.ndarray) -> None:
        self.x, self.layers, self.top = x, layers, top

    @classmethod
    def build(cls, x: np.ndarray, seed: int = 1) -> Graph:
        """Layer by layer from the top; in a layer in batches that search what is there and also see each other."""
        x = x.astype(np.float32)
        level = np.floor(-np.log(1 - np.random.default_rng(seed).random(len(x))) / np.log(DEGREE)).astype(int)
        height = 0
        while (level >= height).sum() > TOP:
            height += 1
        top = np.flatnonzero(level >= height)
        graph = cls(x, [], top if len(top) else np.array([0]))
        for layer in range(height - 1, -1, -1):
            graph.add_layer(np.flatnonzero(level >= layer), DEGREE * (2 if layer == 0 else 1))
        return graph

    def starts(self, queries: np.ndarray) -> np.ndarray:
        """Per query the best of the top layer, carried down through the finished layers."""
        score = queries @ self.x[self.top].T
        best = self.top[np.argsort(-score, axis=1)[:, :8]]
        for near in self.layers:
            best = beam_search(self.x, near, queries, best, 8)[0][:, :8]
        return best

    def add_layer(self, nodes: np.ndarray, degree: int) -> None:
        near = np.full((len(self.x) + 1, degree), -1, dtype=np.int64)  # the last row serves id -1
        first = nodes[:1]
        at, inside = 1, np.zeros(len(self.x) + 1, dtype=bool)
        inside[first] = True
        while at < len(nodes):
            batch = nodes[at:at + min(CHUNK, max(1, at))]
            starts = self.starts(self.x[batch])
            starts = np.where(inside[starts], starts, -1)
            starts = np.concatenate([starts, np.repeat(first[None, :], len(batch), axis=0)], axis=1)
            ids, score = beam_search(self.x, near, self.x[batch], starts, BUILD_BEAM)
            peers = self.x[batch] @ self.x[batch].T
            np.fill_diagonal(peers, -np.inf)
            order = np.argsort(-peers, axis=1)[:, :min(DEGREE, len(batch) - 1)]
            ids = np.concatenate([ids, batch[order]], axis=1)
            score = np.concatenate([score, np.take_along_axis(peers, order, axis=1)], axis=1)
            order = np.argsort(-score, axis=1, kind="stable")
            ids, score = np.take_along_axis(ids, order, axis=1), np.take_along_axis(score, order, axis=1)
            near[batch, :] = -1
            mine = diverse(self.x, ids, score, degree)
            near[batch, :mine.shape[1]] = mine
            self.link_back(near, batch, degree)
            inside[batch] = True
            at += len(batch)
        self.layers.append(near)

    def link_back(self, near: np.ndarray, batch: np.ndarray, degree: int) -> None:
        """Every neighbour of a new node also lists the node; full lists keep a diverse choice."""
        to, source = near[batch].ravel(), np.repeat(batch, degree)
        there = to >= 0
        to, source = to[there], source[there]
        order = np.argsort(to, kind="stable")
        to, source = to[order], source[order]
        nodes, start, count = np.unique(to, return_index=True, return_counts=True)
        for width in sorted(set(np.minimum(2 ** np.ceil(np.log2(count)), 4096).astype(int))):
            some = np.flatnonzero(np.minimum(2 ** np.ceil(np.log2(count)), 4096).astype(int) == width)
            for part in np.array_split(some, max(1, len(some) * (degree + width) ** 2 // 4_000_000)):
                column = np.arange(width)[None, :]
                extra = np.where(column < count[part, None], source[np.minimum(start[part, None] + column, len(source) - 1)], -1)
                own = nodes[part]
                ids = np.concatenate([near[own], extra], axis=1)
                ids = np.where(keep_first(ids), ids, -1)
                score = np.where(ids >= 0, np.matmul(self.x[ids], self.x[own][:, :, None])[:, :, 0], -np.inf)
                rank = np.argsort(-score, axis=1, kind="stable")
                near[own] = diverse(self.x, np.take_along_axis(ids, rank, axis=1), np.take_along_axis(score, rank, axis=1), degree)

    def search(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        if width >= len(self.x) or not self.layers:  # as wide as the graph: every vector is compared
            score = queries @ self.x.T
            return np.broadcast_to(np.arange(len(self.x)), score.shape), score
        best = self.top[np.argsort(-(queries @ self.x[self.top].T), axis=1)[:, :8]]
        for near in self.layers[:-1]:
            best = beam_search(self.x, near, queries, best, 8)[0][:, :8]
        return beam_search(self.x, self.layers[-1], queries, best, width)

    def dump(self, **more: np.ndarray) -> bytes:
        out = io.BytesIO()
        np.savez(out, top=self.top, **{f"layer{i}": v.astype(np.int32) for i, v in enumerate(self.layers)}, **more)
        return out.getvalue()


def lookups(graph: Graph, exact: np.ndarray, queries: np.ndarray, least: float, seed: int = 1, own: np.ndarray | None = None) -> tuple[list[np.ndarray], dict[str, float]]:
    """Per query the positions in the graph with cosine of at least ``least``, and what the audit saw.

    A beam filled with links is doubled for its query. Then queries in an order drawn once, whatever was found, are repeated by
    brute force until ``AUDIT`` true links are seen or all queries are checked; while fewer than ``RECALL`` of these links are
    found, all beams are doubled and searched anew. ``own`` is the position of a query's own vector in the graph (-1: not there),
    which counts neither as found nor as true. Beams as wide as the graph compare everything, so this ends.
    """
    def find(some: np.ndarray, width: int) -> None:
        for at in range(0, len(some), CHUNK):
            part = some[at:at + CHUNK]
            ids, score = graph.search(queries[part].astype(np.float32), width)
            more = (score[:, -1] >= least - 1e-4) & (width < len(exact))
            r, c = np.nonzero((score >= least - 1e-4) & ~more[:, None])
            i = ids[r, c]
            fine = (queries[part[r]] * exact[i]).sum(axis=1) >= least  # in double precision
            r, i = r[fine], i[fine]
            split = np.searchsorted(r, np.arange(len(part) + 1))
            for k, q in enumerate(part):
                found[q] = np.unique(i[split[k]:split[k + 1]])
            if more.any():
                find(part[more], 2 * width)

    found: list[np.ndarray] = [np.empty(0, np.int64)] * len(queries)
    width, rng = BEAM, np.random.default_rng(seed)
    everything = np.arange(len(queries))
    own = np.full(len(queries), -1) if own is None else own
    order = rng.permutation(everything)
    while True:
        find(everything, width)
        there = true = checked = 0
        for at in range(0, len(order), CHUNK):
            some = order[at:at + CHUNK]
            links = queries[some] @ exact.T >= least
            mine = np.flatnonzero(own[some] >= 0)
            links[mine, own[some[mine]]] = False
            true, checked = true + int(links.sum()), checked + len(some)
            there += sum(int(links[i, found[q]].sum()) for i, q in enumerate(some))
            if true >= AUDIT:
                break
        if there >= RECALL * true or width >= len(exact):
            return found, {"beam": width, "recall": there / max(true, 1), "there": there, "true": true, "checked": checked}
        width *= 2


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)


def near_duplicates(
    vectors: DataFrame, least: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    shard: int = SHARD, queries: int = QUERIES, audits: list[dict[str, int]] | None = None,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept), a row per row of ``vectors``.

    Vectors link when their labels are equal and not null, their lengths are equal and their cosine in double precision is at
    least ``least``. ``n_links``: other rows linked directly; ``component_id``: smallest id reachable, itself included;
    ``kept``: the row has that id. Vectors that are null, empty or zero, or hold null or non-finite components, link with
    nothing: no links, their own component, kept. Rows without id count as links of others, have a null component of their own
    if they are alone, and are not kept. Rows that share an id are one node of the components. Other columns are ignored. An
    empty table gives an empty table.

    Equal vectors of a label are one class with a size, so copies cost nothing. Classes are dealt to shards of about
    ``shard``, so a label with a third of all rows has many. Every class is looked up in every shard of its label, ``queries``
    to a task, against the stored graph. A lookup returns the number of links and one of them, and a shard joins vectors that
    share a lookup once, so pairs within a group are never written out. ``audits`` gets each task's ``COUNTS``.
    """
    vector = F.col(vector_col)
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    fine = F.coalesce(F.col(label_col).isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))
    key = F.md5(F.concat_ws(",", F.col(label_col).cast("string"), vector.cast("array<string>")))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.when(fine, key).alias("key"), F.col(label_col).cast("string").alias("label"), vector.cast("array<double>").alias("vector"))
    classes = stage(
        rows.filter("key IS NOT NULL").groupBy("key")
        .agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("size"), F.any_value("label").alias("label"), F.any_value("vector").alias("vector"))
        .withColumn("node", F.coalesce("least", F.xxhash64("key")))
        .withColumn("space", F.concat(F.size("vector"), F.lit(":"), F.col("label"))),
        "vector-classes",
    )
    spaces = stage(classes.groupBy("space").agg(F.count(F.lit(1)).alias("n")).select(F.col("space").alias("of"), F.ceil(F.col("n") / shard).cast("int").alias("shards"), F.ceil(F.col("n") / queries).cast("int").alias("blocks")), "spaces")
    placed = classes.join(spaces, classes.space == spaces.of).drop("of")
    spread = lambda n, seed: F.pmod(F.xxhash64(F.lit(seed), "key"), F.col(n)).cast("int")

    def build(group: pa.Table) -> pa.Table:
        exact = unit(matrix(group["vector"]))
        blob = Graph.build(exact).dump(exact=exact, node=group["node"].to_numpy(), size=group["size"].to_numpy())
        one = {c: group[c].slice(0, 1) for c in ("space", "shard", "blocks")}
        return pa.table({**one, "graph": pa.array([blob], pa.large_binary())}).cast(graph_schema)

    graph_schema = pa.schema([("space", pa.string()), ("shard", pa.int32()), ("blocks", pa.int32()), ("graph", pa.binary())])
    graphs = stage(placed.withColumn("shard", spread("shards", 1)).select("space", "shard", "blocks", "node", "size", "vector")
                   .groupBy("space", "shard").applyInArrow(build, "space string, shard int, blocks int, graph binary"), "graphs")

    def look(asked: pa.Table, stored: pa.Table) -> pa.Table:
        held = np.load(io.BytesIO(stored["graph"][0].as_py()))
        exact, node, size = held["exact"], held["node"], held["size"]
        layers = [held[f"layer{i}"].astype(np.int64) for i in range(sum(k.startswith("layer") for k in held.files))]
        graph = Graph(exact.astype(np.float32), layers, held["top"])
        own = asked["node"].to_numpy()
        order = np.argsort(node, kind="stable")
        at = order[np.minimum(np.searchsorted(node, own, sorter=order), len(node) - 1)]
        found, seen = lookups(graph, exact, unit(matrix(asked["vector"])), least, own=np.where(node[at] == own, at, -1))
        label = np.arange(len(node))

        def root(i: int) -> int:
            while label[i] != i:
                label[i] = label[label[i]]
                i = label[i]
            return i

        count, linked = np.zeros(len(own), np.int64), np.full(len(own), -1)
        for q, ids in enumerate(found):
            if len(ids):
                count[q] = size[ids[node[ids] != own[q]]].sum()
                linked[q] = ids[0]
                first = root(ids[0])
                for i in ids[1:]:
                    other = root(i)
                    label[max(first, other)] = first = min(first, other)
        some = np.flatnonzero(linked >= 0)
        inner = np.flatnonzero(label != np.arange(len(label)))
        return pa.table({
            "a": np.r_[own[some], node[inner], own[:1]], "n_links": np.r_[count[some], np.zeros(len(inner) + 1, np.int64)],
            "b": np.r_[node[linked[some]], node[label[inner]], own[:1]],
            **{k: pa.array([None] * (len(some) + len(inner)) + [seen[k]], pa.int64()) for k in COUNTS},  # the last row tells the audit
        })

    asked = placed.withColumn("block", spread("blocks", 2)).select("space", "block", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), "node", "vector")
    offered = graphs.select("space", "shard", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "graph")
    by = ["space", "shard", "block"]
    found = stage(asked.groupBy(*by).cogroup(offered.groupBy(*by)).applyInArrow(look, "a long, n_links long, b long, there long, true long, checked long, beam long"), "vector-links")
    if audits is not None:
        audits.extend(r.asDict() for r in found.filter("checked IS NOT NULL").select(*COUNTS).collect())
    links = found.filter("checked IS NULL")
    tree = components(links.select("a", "b"))
    counts = links.groupBy("a").agg(F.sum("n_links").alias("n_links"))
    named = (
        classes.join(counts, classes.node == counts.a, "left").join(tree.withColumnRenamed("node", "child"), F.col("node") == F.col("child"), "left")
        .select("key", "least", (F.coalesce("n_links", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("component", "node").alias("root"))
    )
    named = stage(named, "vector-roots")
    ids = stage(named.groupBy("root").agg(F.min("least").alias("component")), "vector-components")
    told = stage(named.join(ids, "root").select(F.col("key").alias("of"), "n_links", "component"), "vector-results")
    release(classes, spaces, graphs, found, named, ids)
    out = rows.select("vec_id", "key").join(told, F.col("key") == F.col("of"), "left")
    component = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def op10_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
