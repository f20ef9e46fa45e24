"""Consecutive numbers and ranks over a whole table without a single-task window.

A global sort is range-partitioned. Each row gets its place inside its partition; the partition sizes (one row per
partition) give the offset. The sort key must end in a column that tells equal rows apart, such as a row id, so
that a large group of copies is split over partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from dqlake.operators.keyed import ROW_ID, attach, with_row_id
from dqlake.sources.staging import stage


def _part() -> Column:
    return F.shiftright("_pos", 33)


def _before(placed: DataFrame, amount: Column) -> DataFrame:
    """Per sort partition, the total of all earlier partitions. One row per partition."""
    totals = placed.groupBy(_part().alias("_part")).agg(amount.alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))


def _place(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    return stage(df.orderBy(*order).withColumn("_pos", F.monotonically_increasing_id()), "sorted")


def number_rows(df: DataFrame, order: Sequence[Column], name: str, first: Column | int = 0) -> DataFrame:
    """Add ``name``: first, first + 1, ... in the given order."""
    placed = _place(df, order)
    first = F.lit(first) if isinstance(first, int) else first
    return (
        placed.withColumn("_part", _part())
        .join(F.broadcast(_before(placed, F.count(F.lit(1)))), "_part", "left")
        .withColumn(name, F.col("_before") + F.col("_pos").bitwiseAND((1 << 33) - 1) + first)
        .drop("_pos", "_part", "_before")
    )


def rank_desc(df: DataFrame, value: str, name: str, within: Sequence[str] = ()) -> DataFrame:
    """SQL ``rank()`` of ``value`` descending, overall or within groups.

    Rows are first counted per distinct value; only these counts are sorted and summed up. The rank of a value
    is the number of rows sorted before it in its group, plus one. ``df`` is a scan or a staged table; a null value
    or group gets no rank.
    """
    within = list(within)
    keys = [*within, value]
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    placed = _place(counts, [*[F.col(c).asc_nulls_first() for c in within], F.col(value).desc_nulls_last()])
    inside = Window.partitionBy("_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    summed = (
        placed.withColumn("_part", _part())
        .join(F.broadcast(_before(placed, F.sum("_rows"))), "_part", "left")
        .withColumn("_ahead", F.col("_before") + F.coalesce(F.sum("_rows").over(inside), F.lit(0)))
    )
    if within:
        base = summed.groupBy(*within).agg(F.min("_ahead").alias("_base"))
        summed = attach(summed.withColumn(ROW_ID, F.col("_pos")), base, within)
        summed = summed.withColumn("_ahead", F.col("_ahead") - F.col("_base"))
    ranks = summed.select(*keys, (F.col("_ahead") + 1).alias(name))
    return attach(with_row_id(df), ranks, keys).drop(ROW_ID)
