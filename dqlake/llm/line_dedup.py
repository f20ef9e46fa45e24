"""Line dedup: explode normalised lines, hash, count distinct documents per hash, drop, reassemble by position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dqlake.llm.common import ascii_lower, free, release, stage, table

BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def drop_repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3,
) -> DataFrame:
    """Every column of ``docs`` with the shortened text in ``text_col``, plus ``n_lines`` and ``n_dropped``.

    A line's key is the line without blanks at its ends and with A-Z in lower case. Keys of at least ``min_chars`` code
    points that at least ``min_docs`` documents hold lose all their lines, except in the document with the largest id.

    Null or empty text is one empty line. Rows that share an id are one document when documents are counted; rows without
    id are together one document whose id is below all others. Equal rows get equal results. Columns of ``docs`` named like
    an added column are replaced; other extra columns are kept. An empty table gives an empty table.

    Only 128-bit hashes, row keys and line numbers are shuffled to find the lines; the texts are shuffled once, to meet the
    line numbers, and not at all when Spark finds those small enough to broadcast. The keys to drop are a table whose size
    Spark knows before the join, so a line that a third of all documents hold is either broadcast or split as a skewed join.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    row, pos, line, key, last, flags = free(docs, "_row", "_pos", "_line", "_key", "_last", "_flags")
    keyed = docs.withColumn(row, F.unhex(F.md5(text)))
    lines = (
        keyed.select(F.col(id_col), F.col(row), F.posexplode(F.split(text, "\n", -1)).alias(pos, line))
        .select(id_col, row, pos, line_key(F.col(line)).alias(key))
        .filter(F.length(key) >= min_chars)
        .select(id_col, row, pos, F.unhex(F.md5(F.col(key))).alias(key))
    )
    lines = stage(lines, "lines")
    repeated = stage(
        lines.select(key, id_col).distinct()
        .groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.max(id_col).alias(last))
        .filter(F.col("n") >= min_docs).select(key, last),
        "repeated-lines",
    )
    hits = lines.join(repeated, key).filter(~F.col(id_col).eqNullSafe(F.col(last)))
    at = F.sort_array(F.collect_set(pos))
    marks = F.flatten(F.zip_with(at, F.concat(F.array(F.lit(-1)), at), lambda p, before: F.when(
        p.isNull(), F.array().cast("array<boolean>"),
    ).otherwise(F.concat(F.array_repeat(F.lit(False), p - before - 1), F.array(F.lit(True))))))
    dropped = stage(hits.groupBy(id_col, row).agg(marks.alias(flags)), "dropped-lines")
    release(lines, repeated)
    dropped = dropped.toDF("_of", "_of_row", flags)
    out = keyed.join(dropped, F.col(id_col).eqNullSafe(F.col("_of")) & (F.col(row) == F.col("_of_row")), "left")
    all_lines = F.split(text, "\n", -1)
    kept = F.array_join(F.filter(all_lines, lambda _, i: ~F.coalesce(F.get(F.col(flags), i), F.lit(False))), "\n")
    n_dropped = F.coalesce(F.size(F.filter(F.col(flags), lambda x: x)), F.lit(0))
    return out.select(
        *[F.when(F.col(flags).isNull(), F.col(c)).otherwise(kept).alias(c) if c == text_col else F.col(c)
          for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")],
        F.size(all_lines).cast("long").alias("n_lines"),
        F.when(F.col(flags).isNull(), F.lit(0)).otherwise(n_dropped).cast("long").alias("n_dropped"),
    )


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = drop_repeated_lines(docs)
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    return out.select("doc_id", "n_lines", "n_dropped", digest.alias("kept_sha256"))


def lines_sql(docs: str) -> str:
    """DuckDB: doc_id, position, line, and whether it goes, for the rows of ``docs`` (doc_id, text)."""
    lower = "translate(trim(line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
SELECT l.doc_id, l.pos, l.line, coalesce(r.n >= 3 AND l.doc_id <> r.last, false) AS gone
FROM (SELECT *, {lower} AS key FROM (
        SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM {docs}))) l
LEFT JOIN (SELECT key, count(DISTINCT doc_id) AS n, max(doc_id) AS last FROM (
        SELECT doc_id, {lower} AS key FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM {docs}))
      WHERE length(key) >= 20 GROUP BY key) r ON l.key = r.key AND length(l.key) >= 20"""


SQL = f"""
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM ({lines_sql('documents')}) GROUP BY doc_id"""
