"""First row per key, surrogate keys and insert-or-replace by key, as joins and aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from dqlake.operators.keyed import repeated_keys
from dqlake.operators.numbering import number_rows
from dqlake.sources.staging import stage


def first_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The first row of each key by ``order``, then by the other columns; rows without a key all stay.

    ``df`` is a stored table. Only the key column is shuffled to find the keys that repeat. Without any, the rows pass
    untouched; otherwise the repeated ones alone are reduced. The smallest row is an aggregate, combined before the
    shuffle, so a key with many copies needs no large group.
    """
    repeated = repeated_keys(df, [key]).select(key)
    if repeated.isEmpty():
        return df
    repeated = stage(repeated, "repeated")
    rest = [c for c in df.columns if c != key and c not in order]
    first = (
        df.join(repeated, key, "left_semi").groupBy(key).agg(F.min(F.struct(*order, *rest)).alias("_first"))
        .select(*[F.col(c) if c == key else F.col(f"_first.{c}").alias(c) for c in df.columns])
    )
    return df.join(repeated, key, "left_anti").select(*df.columns).unionByName(first)


def replace_by_key(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Target rows whose key is not in the source, and all source rows. Both are unique by key."""
    kept = target.join(source.select(key), key, "left_anti")
    return kept.unionByName(source)


def keep_or_number(source: DataFrame, target: DataFrame, key: str, surrogate: str, order: Sequence[str]) -> DataFrame:
    """Give source rows the surrogate key their business key has in the target, and new ones the next numbers."""
    known = target.select(key, F.col(surrogate).alias("_known"))
    matched = source.join(known, key, "left")
    old = matched.where(F.col("_known").isNotNull()).withColumnRenamed("_known", surrogate)
    last = target.agg(F.coalesce(F.max(surrogate), F.lit(0)).alias("n")).scalar()
    fresh = number_rows(
        matched.where(F.col("_known").isNull()).drop("_known"), [F.col(c) for c in order], surrogate, last + 1
    )
    return old.unionByName(fresh)
