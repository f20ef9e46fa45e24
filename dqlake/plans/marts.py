"""Marts and KPIs over the star tables.

Facts are aggregated on their own key before they meet a dimension, so a hot product or month is combined on the map
side. Spark broadcasts the calendar when its size allows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from dqlake.functions import money_avg, money_sum, round2

MARTS = ("monthly_revenue", "top_products", "customer_retention", "quality_trends")
VIEW_PREFIX = "v_mart_"


def monthly_revenue(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    """Orders, customers, revenue and mean value per calendar month, newest first. Days outside the calendar drop out."""
    days = calendar.select("date_key", "year", "month", "month_name")
    amount = F.col("total_amount")
    return (
        fact.select("date_key", "customer_id", "total_amount").join(days, "date_key")
        .groupBy("year", "month", "month_name")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            F.count_distinct("customer_id").alias("distinct_customers"),
            money_sum(amount).alias("total_revenue"),
            money_avg(amount).alias("avg_order_value"),
        )
        .orderBy(F.desc("year"), F.desc("month"))
    )


def monthly_chart(mart: DataFrame) -> DataFrame:
    """The monthly mart in calendar order."""
    return mart.orderBy("year", "month")


def top_products(products: DataFrame, fact: DataFrame) -> DataFrame:
    """Every product with its sales; unsold ones have no units and no revenue. Best sellers first."""
    sales = fact.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum("quantity").alias("units_sold"),
        money_sum(F.col("total_amount")).alias("gross_revenue"),
    )
    listed = products.select("product_id", "product_name", "category", "unit_price", "profit_margin_pct")
    return (
        listed.join(sales, "product_id", "left")
        .fillna({"order_count": 0})
        .orderBy(F.col("gross_revenue").desc_nulls_last(), "product_id")
    )


def best_products(mart: DataFrame, n: int = 10) -> DataFrame:
    return mart.orderBy(F.col("gross_revenue").desc_nulls_last(), "product_id").limit(n)


def customer_retention(customers: DataFrame) -> DataFrame:
    return (
        customers.groupBy("segment", "customer_tier")
        .agg(
            F.count_distinct("customer_id").alias("total_customers"),
            money_sum(F.col("total_spend")).alias("aggregate_spend"),
            money_avg(F.col("total_spend")).alias("avg_customer_spend"),
            money_avg(F.col("avg_order_value")).alias("avg_order_value"),
        )
        .orderBy(F.desc("aggregate_spend"), "segment", "customer_tier")
    )


def segment_spend(mart: DataFrame) -> DataFrame:
    """The retention mart added up over tiers."""
    return mart.groupBy("segment").agg(money_sum(F.col("aggregate_spend")).alias("spend")).orderBy(
        F.desc("spend"), "segment")


def quality_trends(audit: DataFrame) -> DataFrame:
    return (
        audit.groupBy("run_id", F.to_date("evaluated_at").alias("audit_date"))
        .agg(
            F.count(F.lit(1)).alias("checks_executed"),
            F.sum("records_checked").alias("total_records_checked"),
            F.sum("records_passed").alias("total_records_passed"),
            F.sum("records_failed").alias("total_records_failed"),
            money_avg(F.col("pass_rate")).alias("avg_check_pass_rate"),
        )
        .orderBy(F.desc("audit_date"), "run_id")
    )


def recent_checks(audit: DataFrame, n: int = 50) -> DataFrame:
    """The newest check rows."""
    return audit.orderBy(F.desc("evaluated_at"), "audit_id").limit(n)


def recent_trends(mart: DataFrame, n: int = 20) -> DataFrame:
    return mart.orderBy(F.desc("audit_date"), "run_id").limit(n)


def executive_summary(fact: DataFrame, audit: DataFrame) -> DataFrame:
    """One row of KPIs. The quality score is the mean check rate over the audit, null without one."""
    score = audit.agg(money_avg(F.col("pass_rate")).alias("s")).scalar()
    kpis = fact.agg(
        F.coalesce(money_sum(F.col("total_amount")), F.lit(0.0)).alias("total_revenue"),
        F.count(F.lit(1)).alias("total_orders"),
        F.count_distinct("customer_id").alias("active_customers"),
    )
    mean = F.when(F.col("total_orders") > 0, round2(F.col("total_revenue") / F.col("total_orders"))).otherwise(0.0)
    return kpis.select("*", mean.alias("avg_order_value"), score.alias("mean_check_pass_rate"))


def outside_calendar(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    """Number of orders the monthly mart leaves out."""
    ends = calendar.agg(F.min("date_key").alias("a")).scalar(), calendar.agg(F.max("date_key").alias("b")).scalar()
    return fact.agg(F.count_if(~F.col("date_key").between(*ends)).alias("orders_outside_calendar"))


def build(star: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "monthly_revenue": monthly_revenue(star["fact_orders"], star["dim_date"]),
        "top_products": top_products(star["dim_products"], star["fact_orders"]),
        "customer_retention": customer_retention(star["dim_customers"]),
        "quality_trends": quality_trends(star["data_quality_audit"]),
    }


def register_views(star: dict[str, DataFrame]) -> None:
    """The star tables and the four marts as temporary views for SQL users."""
    for name, table in star.items():
        table.createOrReplaceTempView(name)
    for name, mart in build(star).items():
        mart.createOrReplaceTempView(VIEW_PREFIX + name)


def query_mart(spark: SparkSession, name: str, limit: int = 10) -> DataFrame:
    """First rows of a registered mart; the prefix may be left out."""
    short = name.removeprefix(VIEW_PREFIX)
    if short not in MARTS:
        raise ValueError(f"unknown mart {name!r}; known: {', '.join(MARTS)}")
    return spark.table(VIEW_PREFIX + short).limit(limit)
