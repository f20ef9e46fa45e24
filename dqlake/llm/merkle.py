"""Merkle manifest of a dataset: one tree per source, one tree over their roots, proofs by content-addressed descent.

Leaves get their rank by one global sort and partition offsets. Segments of ``LEVELS`` levels are built at a time: a segment is a
row, stored under the digest of its top node, with the records digest -> children of all nodes in it. A leaf request starts with
the digest of the root, asks the store for the segment of that digest and follows the digits of its rank down; the children it
does not follow are its siblings. Asking once per segment, not per leaf and level, makes every join a few hundredths of the rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dqlake.llm.common import release, stage, table

FAN = 3  # children of a node
LEVELS = 5  # of a segment: at most FAN ** LEVELS leaves and about half as many records
PATH = "array<struct<place:int,others:array<binary>>>"  # from the top down: the digit followed, and the other children
SEGMENT = "tree long, idx long, n long, digest binary, records map<binary,array<binary>>"
REQUEST = f"tree long, idx long, n long, subroot binary, digest binary, path {PATH}"


def digest(parts: Sequence[bytes]) -> bytes:
    """SHA-256 of digests, written as hex text one after the other."""
    return sha256("".join(p.hex() for p in parts).encode()).digest()


def height(n: int, fan: int) -> int:
    """Levels above the leaves of a tree of ``n`` leaves."""
    h = 0
    while fan**h < n:
        h += 1
    return h


def leaf_hash(columns: Sequence[Column]) -> Column:
    """SHA-256 of the columns' texts, each with its length in bytes before it; null is a dash. Binary."""
    texts = [c.cast("string") for c in columns]
    parts = [F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts), 256))


@dataclass
class Forest:
    """The segments of many trees, tier by tier from the leaves up, and the trees' roots (tree, n, digest)."""

    tiers: list[DataFrame]
    roots: DataFrame
    fan: int
    levels: int


@dataclass
class Manifest:
    root: bytes | None
    leaves: DataFrame  # tree, rank, n and the columns of the leaf table
    sources: DataFrame  # tree, source, n
    forest: Forest
    top: Forest

    def records(self) -> DataFrame:
        """(digest, children): the whole DAG, every node once."""
        tiers = [t.select(F.explode("records").alias("digest", "children")) for t in (*self.forest.tiers, *self.top.tiers)]
        out = tiers[0]
        for t in tiers[1:]:
            out = out.union(t)
        return out.dropDuplicates(["digest"])


def numbered(df: DataFrame, order: list[Column], label: str) -> DataFrame:
    """``df``, stored in that order, with ``at``: rises with the order, without gaps inside a partition (``at >> 33``)."""
    return stage(df.orderBy(*order).withColumn("at", F.monotonically_increasing_id()), label)


def ranked(leaves: DataFrame, group: str, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(leaves with ``tree``, ``rank`` and ``n``; groups with ``tree`` and ``n``): trees numbered by group, null first.

    Equal rows are told apart by their place in the scan, so that many copies of one row are split over partitions.
    """
    keys = [F.col(c).asc_nulls_first() for c in (group, *order)]
    rows = numbered(leaves.withColumn("_scan", F.monotonically_increasing_id()), [*keys, F.col("_scan").asc()], "merkle-sorted").drop("_scan")
    rows = rows.withColumn("_part", F.shiftright("at", 33))
    runs = stage(rows.groupBy("_part", group).agg(F.count(F.lit(1)).alias("_n"), F.min("at").alias("_first")), "merkle-runs")
    sizes = runs.groupBy(group).agg(F.sum("_n").alias("n"))
    groups = numbered(sizes, [F.col(group).asc_nulls_first()], "merkle-groups").withColumn("_part", F.shiftright("at", 33))
    per_part = groups.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("at").alias("_first"))
    earlier = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    start = per_part.select("_part", (earlier - F.col("_first")).alias("_shift"))  # one row per partition
    groups = stage(groups.join(start, "_part").select((F.col("at") + F.col("_shift")).alias("tree"), group, "n"), "merkle-trees")
    # A group has at most one run per partition.
    earlier = F.coalesce(F.sum("_n").over(Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shifts = runs.select("_part", F.col(group).alias("_of"), (earlier - F.col("_first")).alias("_shift"))
    named = groups.select("tree", "n", F.col(group).alias("_named"))
    shifts = stage(shifts.join(named, F.col("_of").eqNullSafe(F.col("_named"))).drop("_named").withColumnRenamed("_part", "_of_part"), "merkle-shifts")
    out = rows.join(shifts, (F.col("_part") == F.col("_of_part")) & F.col(group).eqNullSafe(F.col("_of")))
    release(runs)
    return out.select("tree", (F.col("at") + F.col("_shift")).alias("rank"), "n", *leaves.columns), groups


def climb(nodes: list[bytes], levels: int, fan: int) -> tuple[bytes, list[tuple[bytes, list[bytes]]]]:
    """The digest of the node ``levels`` above ``nodes``, and the records of all nodes made."""
    records = []
    for _ in range(levels):
        runs = [nodes[i:i + fan] for i in range(0, len(nodes), fan)]
        nodes = [digest(r) for r in runs]
        records += zip(nodes, runs)
    return nodes[0], records


def segments(blocks: DataFrame, tier: int, fan: int, levels: int) -> DataFrame:
    """Blocks (tree, idx, n, nodes: consecutive digests) to segments."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ns, tops, records = batch["n"].to_pylist(), [], []
            for n, nodes in zip(ns, batch["nodes"].to_pylist()):
                top, made = climb(nodes, min(levels, height(n, fan) - tier * levels), fan)
                tops.append(top)
                records.append(made)
            kind = pa.map_(pa.binary(), pa.list_(pa.binary()))
            yield pa.RecordBatch.from_arrays(
                [batch["tree"], batch["idx"], batch["n"], pa.array(tops, pa.binary()), pa.array([list(dict(r).items()) for r in records], kind)],
                names=["tree", "idx", "n", "digest", "records"],
            )

    return blocks.mapInArrow(build, SEGMENT)


def grow(leaves: DataFrame, fan: int = FAN, levels: int = LEVELS) -> Forest:
    """The trees over ``leaves`` (tree, rank, n: leaves of the tree, digest). Every group that is collected has a bounded size."""
    width = fan**levels
    most = leaves.agg(F.max("n")).head()[0] or 0  # one number
    nodes, tiers, roots = leaves.select("tree", F.col("rank").alias("idx"), "n", "digest"), [], None
    for tier in range(max(1, -(-height(most, fan) // levels))):
        block = F.transform(F.sort_array(F.collect_list(F.struct("idx", "digest"))), lambda x: x["digest"])
        block_of = F.expr(f"idx div {width}").alias("block")
        blocks = nodes.groupBy("tree", block_of, "n").agg(block.alias("nodes")).withColumnRenamed("block", "idx")
        made = stage(segments(blocks, tier, fan, levels), f"merkle-tier{tier}")
        tiers.append(made)
        done = F.col("n") <= width ** (tier + 1)
        tops = made.filter(done).select("tree", "n", "digest")
        roots = tops if roots is None else roots.union(tops)
        nodes = made.filter(~done).select("tree", "idx", "n", "digest")
    return Forest(tiers, roots, fan, levels)


def walk(records: dict[bytes, list[bytes]], node: bytes, digits: list[int]) -> tuple[bytes, list[tuple[int, list[bytes]]]]:
    """Follow the digits down from ``node``: the node reached, and what was left aside on every level."""
    aside = []
    for d in digits:
        children = records[node]
        aside.append((d, children[:d] + children[d + 1:]))
        node = children[d]
    return node, aside


def digits_of(place: int, levels: int, fan: int) -> list[int]:
    return [place // fan**i % fan for i in range(levels - 1, -1, -1)]


def descend(forest: Forest, requests: DataFrame, wanted: DataFrame) -> DataFrame:
    """Requests (``REQUEST``, at the roots of trees) to (request at a leaf's segment, records, ``leaves``: what is wanted in it).

    ``wanted`` holds (tree, block, leaves: array of structs) with the leaves asked for in a lowest segment. Each tier asks for the
    segments above wanted ones only.
    """
    fan, levels, width = forest.fan, forest.levels, forest.fan**forest.levels

    def down(tier: int):
        def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    depth = min(levels, height(row["n"], fan) - tier * levels)
                    records, out = dict(row["records"]), []
                    for idx in row["below"]:
                        node, aside = walk(records, row["digest"], digits_of(idx - row["idx"] * fan**depth, depth, fan))
                        path = row["path"] + [{"place": d, "others": o} for d, o in aside]
                        out.append({"tree": row["tree"], "idx": idx, "n": row["n"], "subroot": row["subroot"], "digest": node, "path": path})
                    yield pa.RecordBatch.from_pylist(out, schema=ARROW_REQUEST)

        return step

    below = [wanted.select("tree", F.col("block").alias("idx"))]
    for _ in forest.tiers[1:]:
        below.append(below[-1].select("tree", F.expr(f"idx div {width}").alias("idx")).distinct())
    asked = requests.limit(0)
    for tier in range(len(forest.tiers) - 1, -1, -1):
        first = F.col("n") <= width ** (tier + 1)
        if tier:
            first = first & (F.col("n") > width**tier)
        asked = asked.union(requests.filter(first))
        # By digest; the place only picks one of several equal segments.
        found = asked.join(forest.tiers[tier].select("digest", "tree", "idx", "records"), ["digest", "tree", "idx"])
        if not tier:
            return found.join(wanted.withColumnRenamed("block", "idx"), ["tree", "idx"])
        children = below[tier - 1].groupBy("tree", F.expr(f"idx div {width}").alias("_up")).agg(F.collect_list("idx").alias("below"))
        found = found.join(children.withColumnRenamed("_up", "idx"), ["tree", "idx"])
        asked = stage(found.mapInArrow(down(tier), REQUEST), f"merkle-requests{tier}")


ARROW_PATH = pa.list_(pa.struct([("place", pa.int32()), ("others", pa.list_(pa.binary()))]))
ARROW_REQUEST = pa.schema([
    ("tree", pa.int64()), ("idx", pa.int64()), ("n", pa.int64()), ("subroot", pa.binary()), ("digest", pa.binary()), ("path", ARROW_PATH),
])


def in_blocks(leaves: DataFrame, columns: Sequence[str], width: int) -> DataFrame:
    """(tree, block, leaves): leaves (tree, rank, ...) by the segment they lie in."""
    block = F.expr(f"rank div {width}").alias("block")
    return leaves.groupBy("tree", block).agg(F.collect_list(F.struct(*dict.fromkeys(["rank", *columns]))).alias("leaves"))


def build(leaves: DataFrame, source_col: str, order: Sequence[str], fan: int = FAN, levels: int = LEVELS) -> Manifest:
    """Sort, number and hash the table ``leaves`` (with a binary column ``leaf``). An empty table has no root."""
    rows, groups = ranked(leaves, source_col, order)
    rows = stage(rows, "merkle-leaves")
    forest = grow(rows.withColumnRenamed("leaf", "digest"), fan, levels)
    sources = groups.count()
    top = grow(forest.roots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("rank"), F.lit(sources).cast("long").alias("n"), "digest"), fan, levels)
    root = top.roots.head()  # one row
    return Manifest(root and bytes(root["digest"]), rows, groups.withColumnRenamed(source_col, "source"), forest, top)


def proofs(manifest: Manifest, presented: DataFrame, out: Sequence[str]) -> DataFrame:
    """The proof of every row of ``presented`` and what a leaf shown with it folds to.

    ``presented``: (tree, rank, shown: binary, ...). Columns: ``out`` (of ``presented``, long or binary), leaf, subroot, proof (the
    siblings from the leaf up), proof_sha256, folded (binary).
    """
    fan, levels = manifest.forest.fan, manifest.forest.levels
    none = F.array().cast(PATH)
    tops = manifest.top.roots.select("tree", F.lit(0).cast("long").alias("idx"), "n", F.lit(None).cast("binary").alias("subroot"), "digest", none.alias("path"))
    all_sources = in_blocks(manifest.sources.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("rank"), F.col("n").alias("size")), ["size"], fan**levels)

    def to_subroots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                depth, records, made = min(levels, height(row["n"], fan)), dict(row["records"]), []
                for leaf in row["leaves"]:
                    node, aside = walk(records, row["digest"], digits_of(leaf["rank"] % fan**levels, depth, fan))
                    path = row["path"] + [{"place": d, "others": o} for d, o in aside]
                    made.append({"tree": leaf["rank"], "idx": 0, "n": leaf["size"], "subroot": node, "digest": node, "path": path})
                yield pa.RecordBatch.from_pylist(made, schema=ARROW_REQUEST)

    requests = stage(descend(manifest.top, tops, all_sources).mapInArrow(to_subroots, REQUEST), "merkle-subroots")
    wanted = in_blocks(presented, ["shown", *out], fan**levels)
    types = dict(presented.dtypes)
    schema = ", ".join(f"`{c}` {types[c]}" for c in out) + ", leaf binary, subroot binary, proof array<binary>, proof_sha256 binary, folded binary"
    arrow = pa.schema([(c, pa.int64() if types[c] == "bigint" else pa.binary()) for c in out] + [
        ("leaf", pa.binary()), ("subroot", pa.binary()), ("proof", pa.list_(pa.binary())), ("proof_sha256", pa.binary()), ("folded", pa.binary()),
    ])

    def to_proofs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                depth, records, made = min(levels, height(row["n"], fan)), dict(row["records"]), []
                above = [(p["place"], p["others"]) for p in row["path"]]
                for leaf in row["leaves"]:
                    node, aside = walk(records, row["digest"], digits_of(leaf["rank"] % fan**levels, depth, fan))
                    path = (above + aside)[::-1]
                    siblings, folded = [s for _, others in path for s in others], leaf["shown"]
                    for place, others in path:
                        folded = digest([*others[:place], folded, *others[place:]])
                    made.append({c: leaf[c] for c in out} | {
                        "leaf": node, "subroot": row["subroot"], "proof": siblings, "proof_sha256": digest(siblings), "folded": folded,
                    })
                yield pa.RecordBatch.from_pylist(made, schema=arrow)

    return descend(manifest.forest, requests, wanted).mapInArrow(to_proofs, schema)


def manifest_of(docs: DataFrame, fan: int = FAN, levels: int = LEVELS) -> Manifest:
    """The manifest of documents, with a leaf shown in place of each: the row with the line breaks of its text deleted where the
    CRC-32 of its id is even, else the row itself.

    Leaves stand in the order of doc_id in their source. Null sources are one tree, the first; null ids come first in their tree and
    count as the empty text for the CRC. Rows that share an id are leaves of their own, in the order of their digests. Other
    columns do not count. Texts of any length are hashed where they are scanned, only digests move.
    """
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    cut = F.translate(F.col("text"), "\n", "")
    shown = leaf_hash([F.col(c) for c in fields[:-1]] + [cut])
    even = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 2 == 0
    leaf = leaf_hash([F.col(c) for c in fields])
    rows = docs.select("source", "doc_id", leaf.alias("leaf"), F.when(even & F.contains("text", F.lit("\n")), shown).alias("shown"))
    rows = stage(rows, "merkle-hashes")
    return build(rows.withColumn("shown", F.coalesce("shown", "leaf")), "source", ["doc_id", "leaf"], fan, levels)


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = manifest_of(table(spark, sf_dir, "documents"))
    rows = proofs(made, made.leaves, ["doc_id"])
    text = lambda c: F.lower(F.hex(c))
    root = F.lit(made.root.hex() if made.root else None).cast("string")
    return rows.select(
        "doc_id", text("leaf").alias("leaf"), text("subroot").alias("subroot"), root.alias("root"), text("proof_sha256").alias("proof_sha256"),
        text("folded").alias("folded_root"), (text("folded") == root).alias("verified"),
    )


def field_sql(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(field_sql(v) for v in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def levels_sql(name: str, start: str) -> str:
    """All levels above the nodes that ``start`` gives (tree, level, pos, digest, size: nodes on that level)."""
    return f"""{name}(tree, level, pos, digest, size) AS ({start} UNION ALL
  SELECT tree, level + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), any_value((size + 2) // 3) FROM {name} WHERE size > 1 GROUP BY tree, level, pos // 3)"""


# The CRC-32 of the decimal id: a byte is added (x >= 0), then eight shifts (x = -1).
CRC_SQL = """list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
    lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END)"""

SQL = f"""
WITH RECURSIVE hashed AS (SELECT doc_id, source, {leaf_sql('text')} AS leaf, {leaf_sql("replace(text, chr(10), '')")} AS cut, xor({CRC_SQL}, 4294967295::BIGINT) % 2 = 0 AS even FROM documents),
placed AS (SELECT *, dense_rank() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS tree, row_number() OVER (PARTITION BY source ORDER BY doc_id, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS size FROM hashed),
{levels_sql('nodes', 'SELECT tree, 0, pos, leaf, size FROM placed')},
subroots AS (SELECT tree, level AS height, digest FROM nodes WHERE size = 1),
{levels_sql('above', 'SELECT -1, 0, tree, digest, count(*) OVER () FROM subroots')},
trail AS (SELECT p.doc_id, n.level AS step, p.pos // CAST(pow(3, n.level) AS BIGINT) AS own, n.pos, n.digest
  FROM placed p JOIN nodes n ON n.tree = p.tree AND n.size > 1 AND n.pos // 3 = p.pos // CAST(pow(3, n.level + 1) AS BIGINT)
  UNION ALL SELECT p.doc_id, s.height + a.level, p.tree // CAST(pow(3, a.level) AS BIGINT), a.pos, a.digest
  FROM placed p JOIN subroots s ON s.tree = p.tree JOIN above a ON a.size > 1 AND a.pos // 3 = p.tree // CAST(pow(3, a.level + 1) AS BIGINT)),
steps AS (SELECT doc_id, step, coalesce(string_agg(digest, '' ORDER BY pos) FILTER (pos < own), '') AS lefts, coalesce(string_agg(digest, '' ORDER BY pos) FILTER (pos > own), '') AS rights
  FROM trail GROUP BY doc_id, step),
proofs AS (SELECT doc_id, string_agg(lefts || rights, '' ORDER BY step) AS proof, count(*) AS n FROM steps GROUP BY doc_id),
fold(doc_id, step, digest) AS (SELECT doc_id, 0::BIGINT, CASE WHEN even THEN coalesce(cut, leaf) ELSE leaf END FROM placed UNION ALL
  SELECT f.doc_id, f.step + 1, sha256(s.lefts || f.digest || s.rights) FROM fold f JOIN steps s ON s.doc_id = f.doc_id AND s.step = f.step),
root AS (SELECT digest FROM above WHERE size = 1)
SELECT p.doc_id, p.leaf, s.digest AS subroot, r.digest AS root, sha256(coalesce(q.proof, '')) AS proof_sha256, f.digest AS folded_root, f.digest = r.digest AS verified
FROM placed p JOIN subroots s ON s.tree = p.tree CROSS JOIN root r LEFT JOIN proofs q ON q.doc_id = p.doc_id JOIN fold f ON f.doc_id = p.doc_id AND f.step = coalesce(q.n, 0)"""
