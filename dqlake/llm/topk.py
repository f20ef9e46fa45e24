"""Exact top-k search: exhaustive term-at-a-time accumulation into dense scores, partition selection, merge."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dqlake.llm.common import stage, table, tasks

BLOCK = 16384  # candidates that one task holds as postings
QUERY_BLOCK = 4096  # queries that one task runs over them
LONG = 2**63 - 1


def weights(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) per component, null for a vector that is null or holds null or non-finite components.

    Components beyond the long range saturate.
    """
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(fine, F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long")))


def rows_of(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a list column: row, position and value of every entry that is not zero."""
    lists = column.combine_chunks()
    values = lists.flatten().to_numpy(zero_copy_only=False)
    lengths = np.asarray(lists.value_lengths())
    row = np.repeat(np.arange(len(lengths)), lengths)
    position = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    there = np.flatnonzero(values)
    return row[there], position[there], values[there]


def block_top(candidates: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    """The k best candidates of one block for each query of one block."""
    ids = candidates["vec_id"].to_numpy()
    row, term, value = rows_of(candidates["weights"])
    q_ids, own, q_own = queries["vec_id"].to_numpy(), candidates["row"].to_numpy(), queries["row"].to_numpy()
    q_row, q_term, q_value = rows_of(queries["weights"])
    n, n_terms = len(ids), int(max(term.max(initial=-1), q_term.max(initial=-1))) + 1
    most = lambda x: max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0))))
    if most(value) * most(q_value) * max(n_terms, 1) > LONG:
        value, q_value = value.astype(object), q_value.astype(object)  # integers without bound
    order = np.argsort(term, kind="stable")
    row, value = row[order], value[order]
    start = np.searchsorted(term[order], np.arange(n_terms + 1))
    q_start = np.searchsorted(q_row, np.arange(len(q_ids) + 1))
    found: list[tuple[np.ndarray, ...]] = []
    for q, query_id in enumerate(q_ids):
        scores = np.zeros(n, dtype=value.dtype)
        for t, w in zip(q_term[q_start[q]:q_start[q + 1]], q_value[q_start[q]:q_start[q + 1]], strict=True):
            a, b = start[t], start[t + 1]
            if b - a == n:  # every candidate has this term, in row order
                scores += value[a:b] * w
            else:
                scores[row[a:b]] += value[a:b] * w
        others = np.flatnonzero(own != q_own[q])
        score = scores[others]
        if len(others) > k:
            least = np.partition(score, len(score) - k)[len(score) - k]
            best = np.flatnonzero(score >= least)
            others, score = others[best], score[best]
        if score.dtype == object:
            score = np.array([min(max(int(s), -LONG - 1), LONG) for s in score], dtype=np.int64)
        best = np.lexsort((ids[others], -score.astype(object) if len(score) and score.min() == -LONG - 1 else -score))[:k]
        found.append((*(np.full(len(best), v, dtype=np.int64) for v in (query_id, q_own[q])), ids[others][best], score[best].astype(np.int64)))
    joined = [np.concatenate([f[i] for f in found]) if found else np.empty(0, np.int64) for i in range(4)]
    return pa.table(dict(zip(("query_id", "row", "vec_id", "score"), joined, strict=True)))


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: int = 1024, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, row, rank (from 1), vec_id, score: the ``k`` highest integer inner products of each query row with all other rows.

    Ties go to the smaller id. Vectors that are null or hold null or non-finite components, and rows without id, take no
    part. Components that a shorter vector lacks are zero; an empty vector scores 0 with all. Rows that share an id are rows
    of their own, as candidates and as queries: only the query's own row is left out, and each such query has ranks of its own
    (column ``row`` tells them apart). Scores beyond the long range saturate. Columns besides id and vector are ignored, so
    their names cannot clash. An empty table gives an empty table.

    Every (candidate block, query block) cell is one task's group: at most about ``block`` candidates as postings by term and
    ``query_block`` queries, whatever the table's size. Rows fall into blocks by a hash of their number, so no block is
    hot. A cell returns k rows a query; the merge keeps k of each query's rows before and after the shuffle.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), weights(F.col(vector_col), scale).alias("weights"), is_query.alias("asks"))
    rows = rows.filter("vec_id IS NOT NULL AND weights IS NOT NULL")
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "weights")
    total, asking = rows.agg(F.count(F.lit(1)), F.count(F.when(F.col("asks"), 1))).first()
    blocks = max(1, math.ceil(total / block), min(tasks(spark), total // 256))
    query_blocks = max(1, math.ceil(asking / query_block))

    def cells(df: DataFrame, own: int, other: int, names: tuple[str, str]) -> DataFrame:
        at = F.pmod(F.xxhash64("row"), F.lit(own)).cast("int")
        return df.select("vec_id", "row", "weights", at.alias(names[0]), F.explode(F.sequence(F.lit(0), F.lit(other - 1))).alias(names[1]))

    candidates = cells(rows, blocks, query_blocks, ("c", "q")).groupBy("c", "q")
    queries = cells(rows.filter("asks"), query_blocks, blocks, ("q", "c")).groupBy("c", "q")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return block_top(left, right, k)

    best = candidates.cogroup(queries).applyInArrow(run, "query_id long, row long, vec_id long, score long")
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.asc("vec_id"))
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "row", "rank", "vec_id", "score")


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(vectors, F.col("vec_id") % 100 == 0).drop("row")


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.w, c.w) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 10"""
