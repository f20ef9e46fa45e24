"""The corpus pipeline: toxicity, line dedup, near-dedup, mixing and tokenisation of ``documents``.

Every stage works on all rows its predecessor kept and returns the columns it got; the last one adds the piece ids. Between
stages the rows are Parquet in the shared folder, so a lost executor costs one task of one stage. Rows without id pass all
stages; empty and null texts are ordinary documents (as near copies of each other, one of them stays).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dqlake.llm import common, line_dedup, mixing, pieces, simhash, toxicity

REJECT = 0.8  # score from which a document is toxic; higher than the report's 0.3, as a rejected document is lost


def beside(docs: DataFrame, added: list[str], work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``work(docs)`` without the columns that it adds; the documents' own columns of such names are kept."""
    clash = [c for c in docs.columns if c.lower() in added]
    names = dict(zip(clash, common.free(docs, *[f"{c}_own" for c in clash])))
    out = work(docs.withColumnsRenamed(names))
    return out.select(*[F.col(names.get(c, c)).alias(c) for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network, trained here on labelled ones, scores below ``REJECT``."""
    net = toxicity.fit(docs, common.table(spark, sf_dir, "labels"))
    (name,) = common.free(docs, "toxic_score")
    scored = toxicity.score(docs, net, score_col=name)
    return scored.filter(F.col(name) < REJECT).select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that three documents or more hold, but in the last; ``n_chars`` follows the text."""
    def work(rows: DataFrame) -> DataFrame:
        out = line_dedup.drop_repeated_lines(rows)
        length = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
        return out.withColumn("n_chars", length) if "n_chars" in rows.columns else out

    return beside(docs, ["n_lines", "n_dropped"], work)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the smallest id. Five words, a similarity of 0.8."""
    found = simhash.similar_documents(docs)
    firsts = found.filter("doc_id IS NULL AND component_id IS NULL OR doc_id = component_id").select(F.col("doc_id").alias("kept")).distinct()
    return docs.join(common.stage(firsts, "kept"), F.col("doc_id").eqNullSafe(F.col("kept")), "left_semi")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many rows as before, with all sources at the same weight, in a global random order."""
    return beside(docs, ["copy", "mix_key"], mixing.mix)


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their piece ids, drawn with merge-dropout; the copies of a document draw cuts of their own."""
    (key,) = common.free(docs, "draw")
    drawn = docs.withColumn(key, F.concat_ws(":", F.col("doc_id").cast("string"), F.monotonically_increasing_id()))  # of a stored table
    return pieces.encode(drawn, id_col=key).drop(key)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("near-dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("pieces", to_pieces),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.stage(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
