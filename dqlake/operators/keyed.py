"""Lookups by key that stay balanced when one key holds a large share of the rows.

``attach`` left-joins rows to a table with one row per key in an ordinary equi-join, so adaptive execution can split a key that
holds very many rows. Rows with a null key have no match; they take their row id as partitioning value, so they spread evenly
instead of piling up in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

PREFIX = "__dq_"  # reserved for the columns that validation adds
ROW_ID = f"{PREFIX}row"
SPREAD = f"{PREFIX}spread"

Keys = Sequence[str]


def with_row_id(rows: DataFrame) -> DataFrame:
    """Number the rows of a scan, unless they carry an id already.

    Only a scan numbers its rows the same way when a task is retried; other inputs bring a unique id along.
    """
    return rows if ROW_ID in rows.columns else rows.withColumn(ROW_ID, F.monotonically_increasing_id())


def present(on: Keys) -> Column:
    cond = F.col(on[0]).isNotNull()
    for c in on[1:]:
        cond = cond & F.col(c).isNotNull()
    return cond


def attach(rows: DataFrame, lookup: DataFrame, on: Keys) -> DataFrame:
    """Left join ``rows`` (with a row id) to ``lookup``, which has one row per key."""
    on = list(on)
    values = [c for c in lookup.columns if c not in on]
    spread = rows.withColumn(SPREAD, F.when(present(on), F.lit(0).cast("long")).otherwise(F.col(ROW_ID)))
    found = lookup.withColumn(SPREAD, F.lit(0).cast("long"))
    return spread.join(found, [*on, SPREAD], "left").select(*rows.columns, *values)


def mark_members(rows: DataFrame, members: DataFrame, on: Keys, flag: str) -> DataFrame:
    """Add ``flag``: is the row's key among ``members`` (distinct keys)? A null key is not."""
    hit = members.select(*on).withColumn(flag, F.lit(True))
    return attach(rows, hit, on).withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def repeated_keys(rows: DataFrame, on: Keys) -> DataFrame:
    """Keys that occur more than once, with their count; null keys never repeat."""
    return rows.where(present(on)).groupBy(*on).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
