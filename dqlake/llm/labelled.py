"""A bounded sample of labelled documents for the trained operators, and the split that keeps documents out of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dqlake.llm.common import stage


def remainder(id_: Column, modulus: int) -> Column:
    """crc32 of the id's text modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")) % modulus


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, modulus: int, held_out: int, rows: tuple[int, int], chars: int,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(doc_id, text, label) of at most ``rows`` documents with label 0 and 1 that are not held out.

    Ids are drawn by a hash, so a run draws the same again; an id with several labels has the largest, null labels are left out.
    They are drawn among documents that are there and have a text of fewer than ``chars`` characters: longer ones are left out
    of the sample (and only of the sample), which bounds what the driver collects. The drawn ids are fewer than the sum of
    ``rows``: small enough to broadcast whatever the tables' size.
    """
    known = labels.select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("_label")).filter("_id IS NOT NULL AND _label IN (0, 1)")
    known = known.filter(remainder(F.col("_id"), modulus) != held_out).groupBy("_id").agg(F.max("_label").alias("_label"))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).filter(F.length(text_col) < chars)
    there = stage(texts.select("doc_id").join(known, F.col("doc_id") == F.col("_id")).select("_id", "_label").distinct(), "labelled")
    drawn = [there.filter(F.col("_label") == value).orderBy(F.xxhash64("_id"), "_id").limit(n) for value, n in enumerate(rows)]
    ids = F.broadcast(drawn[0].unionByName(drawn[1]))
    return texts.join(ids, texts.doc_id == ids["_id"]).select("doc_id", "text", F.col("_label").alias("label")).limit(sum(rows))
