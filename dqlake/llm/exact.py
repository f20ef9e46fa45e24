"""Exact dedup against immutable snapshots, screened by static binary-fuse filters.

Documents come in batches. A batch's own duplicates are grouped first, by digest and text. The digests left are screened by
the filters of every earlier snapshot; only what a filter lets through joins that snapshot's stored texts and is compared byte by
byte. What is found there belongs to the stored class; the rest is new. Then the batch becomes a snapshot of its own: its texts
by digest, and a filter per bucket of the digests that were new. Nothing written is ever changed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dqlake.llm import fuse
from dqlake.llm.common import release, stage, table

BLANKS = r"[\x20\x09-\x0D]+"
BATCHES = 3  # that the registered query takes the documents in
BUCKET = 2048  # digests of a filter


def normalised(text: Column) -> Column:
    """Every run of blanks as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def md5(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


@dataclass
class Snapshot:
    """A stored batch. ``texts``: (digest, text, entry, n, least); ``filters``: (bucket, filter) over its new digests."""

    number: int
    texts: DataFrame
    filters: DataFrame
    buckets: int


def key(digest: Column) -> Column:
    return F.xxhash64(digest)


def make_filters(digests: DataFrame, buckets: int) -> DataFrame:
    """(bucket, filter) of distinct digests. A bucket holds about ``BUCKET`` keys, so a task holds few at a time."""

    def build(_: tuple[pa.Scalar, ...], bucket: pa.Table) -> pa.Table:
        keys = bucket["key"].to_numpy().astype(np.int64).view(np.uint64)
        return pa.table({"bucket": bucket["bucket"].slice(0, 1), "filter": pa.array([fuse.build(keys)], pa.binary())})

    rows = digests.select(key(F.col("digest")).alias("key"))
    return rows.withColumn("bucket", F.pmod("key", F.lit(buckets))).groupBy("bucket").applyInArrow(build, "bucket long, filter binary")


def screen(entries: DataFrame, snapshot: Snapshot) -> DataFrame:
    """(entry) of those rows (digest, entry) whose digest the snapshot's filters let through.

    A bucket's filter is sorted before the digests that are tested with it, and these stream by in batches.
    """

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, built = None, None
        for batch in batches:
            of, keys = batch["bucket"].to_numpy(), batch["key"].to_numpy().view(np.uint64)
            known, entry = batch["filter"], batch["entry"].to_numpy()
            cuts = [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1).tolist(), len(of)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if of[a] != bucket:
                    bucket, built = of[a], None
                if known[a].is_valid:
                    built, a = known[a].as_py(), a + 1
                if built is not None and a < b:
                    hits = entry[a:b][fuse.contains(built, keys[a:b])]
                    yield pa.RecordBatch.from_arrays([pa.array(hits)], names=["entry"])

    bucket = F.pmod("key", F.lit(snapshot.buckets)).alias("bucket")
    zero = F.lit(0).cast("long")
    asked = entries.select(key(F.col("digest")).alias("key"), "entry").select(bucket, F.lit(1).alias("turn"), "key", "entry", F.lit(None).cast("binary").alias("filter"))
    filters = snapshot.filters.select("bucket", F.lit(0).alias("turn"), zero.alias("key"), zero.alias("entry"), "filter")
    return filters.union(asked).repartition("bucket").sortWithinPartitions("bucket", "turn").mapInArrow(test, "entry long")


def ingest(batch: DataFrame, snapshots: list[Snapshot], bucket: int = BUCKET) -> tuple[Snapshot, DataFrame]:
    """The snapshot of a batch (id, digest, text), and (entry, of_snapshot, of_entry): its texts that earlier ones hold."""
    spark, number = batch.sparkSession, len(snapshots)
    grouped = batch.groupBy("digest", "text").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("least"))
    texts = stage(grouped.withColumn("entry", F.monotonically_increasing_id()), "exact-texts")
    found = spark.createDataFrame([], "entry long, of_snapshot int, of_entry long")
    for old in snapshots:
        hits = stage(screen(texts.select("digest", "entry"), old), "exact-positives")
        asked = texts.select("digest", "text", "entry").join(hits, "entry", "left_semi")
        stored = old.texts.select(F.col("digest").alias("_digest"), F.col("text").alias("_text"), F.col("entry").alias("of_entry"))
        same = asked.join(stored, (F.col("digest") == F.col("_digest")) & (F.col("text") == F.col("_text")))
        checked = stage(same.select("entry", F.lit(old.number).alias("of_snapshot"), "of_entry"), "exact-checked")
        release(hits)
        found = found.union(checked)
    # A text known twice (let through by chance later on) belongs where it was stored first.
    first = F.min(F.struct("of_snapshot", "of_entry")).alias("of")
    known = stage(found.groupBy("entry").agg(first).select("entry", "of.of_snapshot", "of.of_entry"), "exact-known")
    new = stage(texts.join(known, "entry", "left_anti").select("digest").distinct(), "exact-new")
    buckets = max(1, -(-new.count() // bucket))
    filters = stage(make_filters(new, buckets), "exact-filters")
    release(new)
    return Snapshot(number, texts, filters, buckets), known


def equal_texts(
    docs: DataFrame, batches: int = BATCHES, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = md5,
    bucket: int = BUCKET,
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), a row per row of ``docs``, taken in batches by a hash of the id.

    Texts are equal when they are the same once every run of blanks is one space; null is the empty text. ``keep_id`` is the
    smallest id with that text; an id that is null counts as larger than all. One row of a class is kept, also when rows repeat.
    Other columns are ignored; an empty table gives an empty table. Digests only bring texts together: texts that share one are told
    apart by their bytes. Copies are combined before they move, so a text that a third of all rows hold is a row a task.
    """
    spark = docs.sparkSession
    text = normalised(F.col(text_col))
    named = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.pmod(F.xxhash64(F.col(id_col)), F.lit(batches)).cast("int").alias("batch"))
    hashed = named.select("id", "batch", digest(F.col("text")).alias("digest"), F.unhex(F.sha2("text", 256)).alias("sha"))
    rows = stage(hashed.withColumn("row", F.monotonically_increasing_id()), "exact-rows")
    snapshots, members = [], None
    for b in range(batches):
        batch = named.filter(F.col("batch") == b).select("id", digest(F.col("text")).alias("digest"), "text")
        snapshot, known = ingest(batch, snapshots, bucket)
        snapshots.append(snapshot)
        mine = snapshot.texts.select("entry", "digest", "n", "least", F.unhex(F.sha2("text", 256)).alias("sha"))
        mine = mine.join(known, "entry", "left").select(
            F.lit(b).alias("of_batch"), F.col("digest").alias("_digest"), F.col("sha").alias("_sha"), "n", "least",
            F.coalesce("of_snapshot", F.lit(b)).alias("snapshot"), F.coalesce("of_entry", "entry").alias("class"),
        )
        members = mine if members is None else members.union(mine)
    members = stage(members, "exact-members")
    classes = members.groupBy("snapshot", "class").agg(F.sum("n").alias("group_size"), F.min("least").alias("keep_id")).filter("group_size > 1")
    repeated = stage(members.select("of_batch", "_digest", "_sha", "snapshot", "class").join(classes, ["snapshot", "class"]).drop("snapshot", "class"), "exact-repeated")
    same_id = rows.groupBy("digest", "sha", "id").agg(F.count(F.lit(1)).alias("k"), F.min("row").alias("first")).filter("k > 1")
    ties = stage(same_id.select(F.col("digest").alias("_d"), F.col("sha").alias("_s"), F.col("id").alias("_i"), "first"), "exact-ties")
    out = rows.join(repeated, (F.col("batch") == F.col("of_batch")) & (F.col("digest") == F.col("_digest")) & (F.col("sha") == F.col("_sha")), "left")
    alone = F.col("group_size").isNull()
    out = out.withColumn("keep_id", F.when(alone, F.col("id")).otherwise(F.col("keep_id")))
    out = out.join(ties, (F.col("digest") == F.col("_d")) & (F.col("sha") == F.col("_s")) & F.col("id").eqNullSafe(F.col("_i")), "left")
    for s in snapshots:
        release(s.filters)
    return out.select(
        F.col("id").alias("doc_id"), "keep_id", F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("id").eqNullSafe(F.col("keep_id")) & F.coalesce(F.col("first") == F.col("row"), F.lit(True))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return equal_texts(table(spark, sf_dir, "documents"))


SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS text FROM documents),
g AS (SELECT text, min(doc_id) AS keep_id, count(*) AS n FROM t GROUP BY text)
SELECT t.doc_id, g.keep_id, CAST(g.n AS BIGINT) AS group_size, t.doc_id = g.keep_id AS kept, sha256(t.text) AS text_sha256
FROM t JOIN g ON t.text = g.text"""
