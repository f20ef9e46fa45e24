"""Mixing sources to target weights by Poisson replication, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dqlake.llm.common import free, hex_digits, release, stage, table, tasks

UNIT_DIGITS = 13  # 52 bits of the hash: exact in a double


def mix(
    docs: DataFrame, weights: dict[str | None, float] | None = None, total: float | None = None, seed: int = 17,
    id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
) -> DataFrame:
    """Rows of ``docs``, each repeated by a Poisson count with its source's target rate, in a global random order.

    ``weights``: share of each source in the output, scaled to sum 1; sources not named get none, and null names the rows
    without source. Without ``weights`` all sources weigh the same. ``total``: rows wanted, by default as many as there are.
    The rate of a source is weight * total / its rows. A row's count inverts the Poisson distribution at a point drawn by a
    hash of seed and id (of the text, where the id is null), so it is the same in every run and for every partitioning;
    rows that share an id share the count. Added columns: ``copy`` (from 1) and ``mix_key``, the key of the random order;
    columns of ``docs`` with these names are replaced. Texts are never looked at, so null, empty and long ones are alike.
    An empty table gives an empty table; rates that are not positive give no rows.

    Sources are counted by a map-side aggregate. The inverse distribution is one small array per source, staged, and met by a
    join on source and a random salt, so a hot source spreads over all partitions; Spark broadcasts the arrays instead when
    their known size is below its limit. The rows are shuffled once, by the random key.
    """
    spark = docs.sparkSession
    mean, k, salt, point, cdf, n = free(docs, "_mean", "_k", "_salt", "_point", "_cdf", "_n")
    name, name_salt = free(docs, "_name", "_name_salt")
    rows = stage(docs.groupBy(F.col(source_col).alias(name)).agg(F.count(F.lit(1)).alias(n)), "sources")
    if weights is None:
        share = rows.withColumn(mean, F.lit(1.0))
    else:
        listed = spark.createDataFrame([(s, float(w)) for s, w in weights.items()], "_listed string, _weight double")
        share = rows.join(listed, F.col(name).cast("string").eqNullSafe(F.col("_listed"))).select(name, n, F.col("_weight").alias(mean))
    amount = float(total if total is not None else rows.agg(F.sum(n)).first()[0] or 0)
    whole = share.agg(F.sum(mean)).first()[0] or 1.0
    rates = share.withColumn(mean, F.col(mean) / F.lit(whole) * F.lit(amount) / F.col(n)).filter(F.col(mean) > 0)
    arrays = stage(poisson_arrays(rates.select(name, mean), name, mean, k, cdf), "poisson")
    release(rows)
    salts = tasks(spark)
    spread = arrays.select("*", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias(name_salt))
    identity = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("t"), F.md5(F.coalesce(F.col(text_col), F.lit(""))))))
    drawn = docs.drop("copy", "mix_key").withColumn(point, (hex_digits(identity, UNIT_DIGITS) + F.lit(0.5)) / F.lit(float(16**UNIT_DIGITS)))
    drawn = drawn.withColumn(salt, F.pmod(F.xxhash64(point), F.lit(salts)).cast("int"))
    met = drawn.join(spread, F.col(source_col).eqNullSafe(F.col(name)) & (F.col(salt) == F.col(name_salt)))
    count = F.size(F.filter(F.col(cdf), lambda c: c <= F.col(point)))
    order = hex_digits(F.concat(F.lit(f"{seed}:order:"), identity, F.lit(":"), F.col("copy").cast("string")), 15)
    kept = [c for c in docs.columns if c.lower() not in ("copy", "mix_key")]
    return (
        met.withColumn(n, count).filter(F.col(n) > 0)
        .select(*kept, F.explode(F.sequence(F.lit(1), F.col(n))).alias("copy"))
        .withColumn("mix_key", order)
        .repartition("mix_key").sortWithinPartitions("mix_key")
    )


def poisson_arrays(rates: DataFrame, name: str, mean: str, k: str, cdf: str) -> DataFrame:
    """For each name the cumulative probabilities of 0, 1, 2, ... up to where they are 1 in a double.

    Terms come from logarithms, so that large rates do not vanish in exp(-rate).
    """
    terms = rates.withColumn(k, F.explode(F.sequence(F.lit(0), F.ceil(F.col(mean) + 12 * F.sqrt(mean) + 30).cast("int"))))
    ln_factorial = f"sum(ln(greatest({k}, 1))) OVER (PARTITION BY {name} ORDER BY {k})"
    terms = terms.withColumn("_p", F.expr(f"exp({k} * ln({mean}) - {mean} - {ln_factorial})"))
    terms = terms.withColumn("_c", F.expr(f"sum(_p) OVER (PARTITION BY {name} ORDER BY {k})"))
    pairs = F.sort_array(F.collect_list(F.struct(k, "_c")))
    return terms.groupBy(name).agg(F.transform(pairs, lambda x: x["_c"]).alias(cdf))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal weights for all sources; the whole rows, whose texts are given by their digest."""
    out = mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "source", "copy", "mix_key", F.sha2("text", 256).alias("text_sha256"))


SQL = """
WITH n AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
r AS (SELECT source, (SELECT sum(n) FROM n) * 1.0 / (SELECT count(*) FROM n) / n AS rate FROM n),
c AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM (
  SELECT source, k, exp(k * ln(rate) - rate - lgamma(k + 1)) AS p FROM (
    SELECT source, rate, unnest(range(0, CAST(ceil(rate + 12 * sqrt(rate) + 30) AS BIGINT) + 1)) AS k FROM r))),
a AS (SELECT source, list(c ORDER BY k) AS cdf FROM c GROUP BY source),
u AS (SELECT doc_id, source, text, (CAST('0x' || substr(md5('17:' || CAST(doc_id AS VARCHAR)), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0 AS u FROM documents),
m AS (SELECT u.*, len(list_filter(a.cdf, lambda x: x <= u.u)) AS n FROM u JOIN a ON u.source IS NOT DISTINCT FROM a.source),
e AS (SELECT doc_id, source, text, unnest(range(1, n + 1)) AS copy FROM m)
SELECT doc_id, source, CAST(copy AS INTEGER) AS copy,
       CAST('0x' || substr(md5('17:order:17:' || CAST(doc_id AS VARCHAR) || ':' || CAST(copy AS VARCHAR)), 1, 15) AS BIGINT) AS mix_key,
       sha256(text) AS text_sha256
FROM e"""
