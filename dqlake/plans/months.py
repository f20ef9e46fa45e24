"""Marts kept by month: a refresh reads the facts of the months that a load has touched, and nothing else of the history.

Counts and decimal sums of months add up; distinct customers do not. A month therefore keeps the set of its customers as bitmaps over the
numeric customer key (32,768 keys each, only those with a customer), and sets merge by OR. Numbers are exact. Customers without a row in
the dimension have no key; a month keeps their ids, which are looked up again when months are merged, as a later load may have added
them. Keys never change between full refreshes; after one, all months are built anew.

A month's bitmaps take at most an eighth of a byte a key, 125 MB for 10^9 customers. As in the facts, a refresh writes beside what is there
and then names its months in one file, so one that dies changes nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from dqlake.functions import money_avg, round2
from dqlake.functions.numbers import MONEY
from dqlake.plans import warehouse
from dqlake.plans.lake import PARTITION
from dqlake.plans.layout import Layout
from dqlake.sources.files import empty_table, read_if_there, write_parquet
from dqlake.sources.staging import stage

TOTALS = "orders bigint, amounts bigint, revenue decimal(38,2), year int, month int"
BUYERS = "bucket bigint, bits binary, year int, month int"
OTHERS = "customer_id string, year int, month int"
NAMED = "year int, month int, build int, load_id int, keys_of int"


@dataclass(frozen=True)
class Months:
    """What is kept: ``totals`` (a row a month), ``buyers`` (bitmaps), ``others`` (ids without a key), and the dimension's keys."""

    totals: DataFrame
    buyers: DataFrame
    others: DataFrame
    known: DataFrame
    rebuilt: list[tuple[int, int]]


def refresh(spark: SparkSession, layout: Layout) -> Months:
    """Bring the months up to the loaded facts and return all of them. Without a load since the last call nothing is built."""
    root = layout.warehouse("months")
    named = read_if_there(spark, f"{root}/named", NAMED).collect()  # a row a month and build
    facts, keys_of = warehouse.fact_months(spark, layout), warehouse.keys_of(spark, layout)
    last: dict[tuple[int, int], Row] = {}
    for row in sorted(named, key=lambda r: r["build"]):
        last[row["year"], row["month"]] = row

    def current(m: Row) -> bool:
        have = last.get((m["year"], m["month"]))
        return have is not None and (have["load_id"], have["keys_of"]) == (m["load_id"], keys_of)

    stale = [m for m in facts if not current(m)]
    build = 1 + max((r["build"] for r in named), default=0)
    known = warehouse.read_table(spark, layout, "dim_customers").select("customer_id", "customer_key")
    if stale:
        _build(warehouse.facts_of(spark, layout, stale), known, f"{root}/build={build}")
        rows = [(m["year"], m["month"], build, m["load_id"], keys_of) for m in stale]
        spark.createDataFrame(rows, NAMED).coalesce(1).write.mode("append").parquet(f"{root}/named")
    fresh = {(m["year"], m["month"]) for m in stale}
    use = [(*at, build if at in fresh else last[at]["build"]) for at in ((m["year"], m["month"]) for m in facts)]
    parts = (_read(spark, root, name, schema, use) for name, schema in (("totals", TOTALS), ("buyers", BUYERS), ("others", OTHERS)))
    return Months(*parts, known, sorted(fresh))


def _build(facts: DataFrame, known: DataFrame, folder: str) -> None:
    """Write the three parts of some months. A customer travels once a month, whatever the orders."""
    amount = F.col("total_amount")
    totals = facts.groupBy(*PARTITION).agg(
        F.count(F.lit(1)).alias("orders"), F.count(amount).alias("amounts"), F.sum(amount.cast(MONEY)).alias("revenue"))
    write_parquet(totals.select(*_names(TOTALS)), f"{folder}/totals", PARTITION)
    once = facts.where("customer_id IS NOT NULL").select(*PARTITION, "customer_id").distinct()
    keyed = stage(once.join(known, "customer_id", "left"), "month_customers")
    write_parquet(bitmaps(keyed.where("customer_key IS NOT NULL"), PARTITION).select(*_names(BUYERS)), f"{folder}/buyers", PARTITION)
    write_parquet(keyed.where("customer_key IS NULL").select(*_names(OTHERS)), f"{folder}/others", PARTITION)


def _names(schema: str) -> list[str]:
    return [field.split(" ")[0] for field in schema.split(", ")]


def _read(spark: SparkSession, root: str, name: str, schema: str, use: list[tuple[int, int, int]]) -> DataFrame:
    """The part's rows of the builds in use, one a month."""
    if not use:
        return empty_table(spark, schema)
    builds = [read_if_there(spark, f"{root}/build={b}/{name}", schema).withColumn("build", F.lit(b)) for b in sorted({b for *_, b in use})]
    rows = builds[0]
    for more in builds[1:]:
        rows = rows.unionByName(more)
    return rows.join(spark.createDataFrame(use, "year int, month int, build int"), [*PARTITION, "build"], "left_semi").drop("build")


# ---- sets of customers ------------------------------------------------------------------------------------------

def bitmaps(keyed: DataFrame, by: list[str], key: str = "customer_key") -> DataFrame:
    """(``by``, bucket, bits): the keys of each group, combined before the shuffle."""
    bucket = F.bitmap_bucket_number(key).alias("bucket")
    return keyed.groupBy(*by, bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("bits"))


def distinct_customers(months: Months, by: list[str]) -> DataFrame:
    """(``by``, distinct_customers) of merged months; ``by`` is a part of year and month."""
    found = months.others.join(months.known, "customer_id", "left")
    late = bitmaps(found.where("customer_key IS NOT NULL"), by)
    sets = months.buyers.select(*by, "bucket", "bits").unionByName(late)
    merged = sets.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    counted = merged.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias("n"))
    loose = found.where("customer_key IS NULL").select(*by, "customer_id").distinct().groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    return counted.unionByName(loose).groupBy(*by).agg(F.sum("n").alias("distinct_customers"))


def totals_by(months: Months, by: list[str]) -> DataFrame:
    """(``by``, total_orders, distinct_customers, total_revenue, avg_order_value) of merged months. Without ``by`` always one row."""
    total, count = F.sum("revenue").cast("double"), F.sum("amounts")
    sums = months.totals.groupBy(*by).agg(
        F.coalesce(F.sum("orders"), F.lit(0)).alias("total_orders"), total.alias("total_revenue"), round2(total / F.nullif(count, F.lit(0))).alias("avg_order_value"))
    sets = distinct_customers(months, by)
    joined = sums.join(sets, by, "left") if by else sums.withColumn("distinct_customers", sets.scalar())
    return joined.select(*by, "total_orders", F.coalesce("distinct_customers", F.lit(0)).alias("distinct_customers"), "total_revenue", "avg_order_value")


# ---- marts ------------------------------------------------------------------------------------------------------

def monthly_revenue(months: Months, calendar: DataFrame) -> DataFrame:
    """The monthly mart of ``marts``, from what is kept. ``calendar`` holds whole months; others drop out."""
    named = calendar.select(*PARTITION, "month_name").distinct()
    rows = totals_by(months, PARTITION).join(named, PARTITION)
    columns = [*PARTITION, "month_name", "total_orders", "distinct_customers", "total_revenue", "avg_order_value"]
    return rows.select(*columns).orderBy(F.desc("year"), F.desc("month"))


def executive_summary(months: Months, audit: DataFrame) -> DataFrame:
    """The KPIs of ``marts``, from what is kept."""
    score = audit.agg(money_avg(F.col("pass_rate")).alias("s")).scalar()
    revenue = F.coalesce("total_revenue", F.lit(0.0))
    mean: Column = F.when(F.col("total_orders") > 0, round2(revenue / F.col("total_orders"))).otherwise(0.0)
    return totals_by(months, []).select(
        revenue.alias("total_revenue"), "total_orders", F.col("distinct_customers").alias("active_customers"),
        mean.alias("avg_order_value"), score.alias("mean_check_pass_rate"))


def customer_retention(customers: DataFrame) -> DataFrame:
    """The retention mart of ``marts`` over the dimension: customers are counted as bitmaps of their keys, so no id is shuffled."""
    by, bucket = ["segment", "customer_tier"], F.bitmap_bucket_number("customer_key").alias("bucket")
    spend, value = F.col("total_spend"), F.col("avg_order_value")
    parts = customers.groupBy(*by, bucket).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("customer_key")).alias("bits"),
        F.sum(spend.cast(MONEY)).alias("spend"), F.count(spend).alias("spends"),
        F.sum(value.cast(MONEY)).alias("value"), F.count(value).alias("valued"))
    rows = parts.groupBy(*by).agg(
        F.sum(F.bitmap_count("bits")).alias("total_customers"),
        F.sum("spend").cast("double").alias("aggregate_spend"),
        round2(F.sum("spend").cast("double") / F.nullif(F.sum("spends"), F.lit(0))).alias("avg_customer_spend"),
        round2(F.sum("value").cast("double") / F.nullif(F.sum("valued"), F.lit(0))).alias("avg_order_value"))
    return rows.orderBy(F.desc("aggregate_spend"), *by)
