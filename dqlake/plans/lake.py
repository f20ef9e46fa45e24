"""Publishing of valid rows as the lake: two dimensions and the order facts by year and month."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from dqlake.operators.clean import clean_customers, clean_orders, clean_products
from dqlake.operators.enrich import enrich_customers, enrich_products
from dqlake.plans import lineage
from dqlake.plans.batch import Flagged
from dqlake.plans.gate import GateResult, now
from dqlake.plans.layout import Layout
from dqlake.sources.files import read_parquet, write_document, write_parquet

PARTITION = ["year", "month"]
PUBLISHED = [
    ("raw_orders", "quality_gate_orders"), ("raw_customers", "quality_gate_orders"), ("raw_products", "quality_gate_orders"),
    ("quality_gate_orders", "lake_fact_orders"), ("raw_customers", "lake_dim_customers"), ("lake_fact_orders", "lake_dim_customers"),
    ("raw_products", "lake_dim_products"), ("lake_fact_orders", "lake_dim_products"),
]


class GateClosed(Exception):
    """The batch scored below its threshold."""


def by_date(orders: DataFrame) -> DataFrame:
    """Bring the rows of a month together, so each task writes to few month folders; Spark splits a big month among many tasks.

    Unlike a range partitioning this takes no sample, which would clean all the orders a second time.
    """
    return orders.hint("rebalance", *[F.col(c) for c in PARTITION])


def publish(
    flagged: Flagged, layout: Layout, run_id: str, at: datetime | None = None
) -> DataFrame:
    """Clean, enrich and write; returns the manifest (one row). The facts are written first and read back for the rest."""
    spark = flagged.orders.sparkSession
    write_parquet(by_date(clean_orders(flagged.valid("orders"))), layout.lake("fact_orders"), PARTITION)
    orders = read_parquet(spark, layout.lake("fact_orders"))
    write_parquet(enrich_customers(clean_customers(flagged.valid("customers")), orders), layout.lake("dim_customers"))
    write_parquet(enrich_products(clean_products(flagged.valid("products")), orders), layout.lake("dim_products"))
    lineage.record(spark, layout, run_id, "publish", PUBLISHED)
    write_document(manifest(spark, layout, run_id, at), layout.manifest(run_id))
    return spark.read.json(layout.manifest(run_id))


def publish_if_passed(
    result: GateResult, layout: Layout, run_id: str, override: bool = False, at: datetime | None = None
) -> DataFrame:
    """``override`` publishes the valid rows of a batch that failed."""
    if not (result.passed or override):
        raise GateClosed(f"{result.summary['overall_quality_score']} < {result.summary['quality_threshold']}")
    return publish(result.flagged, layout, run_id, at)


def partitions(fact: DataFrame) -> DataFrame:
    return fact.select(*PARTITION).distinct()


def manifest(spark: SparkSession, layout: Layout, run_id: str, at: datetime | None = None) -> DataFrame:
    """Counts and partitions as they lie on disk, so a retried task cannot inflate them."""
    lake = {t: read_parquet(spark, layout.lake(t)) for t in ("dim_customers", "dim_products", "fact_orders")}
    months = lake["fact_orders"].groupBy(*PARTITION).agg(F.count(F.lit(1)).alias("n"))
    listed = months.agg(
        F.sum("n").alias("orders"),
        F.sort_array(F.collect_list(F.struct(*PARTITION))).alias("partitions"),
    )
    count = {t: lake[t].agg(F.count(F.lit(1))).scalar() for t in ("dim_customers", "dim_products")}
    return listed.select(
        F.lit(run_id).alias("run_id"),
        F.lit((at or now()).isoformat()).alias("timestamp"),
        F.struct(
            count["dim_customers"].alias("customers"),
            count["dim_products"].alias("products"),
            F.coalesce("orders", F.lit(0)).alias("orders"),
        ).alias("records_processed"),
        F.size("partitions").alias("partitions_created"),
        "partitions",
        F.struct(*[F.lit(layout.lake(t)).alias(t) for t in lake]).alias("paths"),
    )
