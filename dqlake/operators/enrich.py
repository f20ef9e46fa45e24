"""Customer and product features from the clean orders.

Orders are aggregated per key before any join, so both join sides are unique by key and a hot customer or product
is combined on the map side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from dqlake.functions import money_avg, money_sum
from dqlake.operators.numbering import rank_desc
from dqlake.sources.staging import stage

NO_ORDER_DAYS = 999
# Lowest spend of a tier, highest tier first.
TIERS = [("Diamond", 10000), ("Gold", 5000), ("Silver", 1000)]
LOWEST_TIER = "Bronze"
# What a customer row holds where nothing is known.
DEFAULTS = {
    "total_spend": 0.0,
    "total_orders": 0,
    "avg_order_value": 0.0,
    "days_since_last_order": NO_ORDER_DAYS,
    "customer_tier": LOWEST_TIER,
    "name": "Unknown",
    "email": "",
    "country": "Other",
    "segment": "Consumer",
}


def tier(spend: Column) -> Column:
    out = None
    for name, least in TIERS:
        out = F.when(spend >= least, name) if out is None else out.when(spend >= least, name)
    return out.otherwise(LOWEST_TIER)


def customer_rfm(orders: DataFrame) -> DataFrame:
    """Spend, order count, mean value, last order, whole days from it to the newest order, tier."""
    newest = orders.agg(F.max("order_date")).scalar()
    agg = orders.groupBy("customer_id").agg(
        money_sum(F.col("total_amount")).alias("total_spend"),
        F.count("order_id").alias("total_orders"),
        money_avg(F.col("total_amount")).alias("avg_order_value"),
        F.max("order_date").alias("last_order_date"),
    )
    return agg.withColumns({
        "days_since_last_order": F.timestamp_diff("DAY", F.col("last_order_date"), newest).cast("int"),
        "customer_tier": tier(F.col("total_spend")),
    })


def enrich_customers(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Order features of every customer; one without orders gets the defaults, as do missing descriptions."""
    joined = customers.join(customer_rfm(orders), "customer_id", "left")
    return joined.fillna({c: v for c, v in DEFAULTS.items() if c in joined.columns})


def product_sales(orders: DataFrame) -> DataFrame:
    return orders.groupBy("product_id").agg(
        F.sum("quantity").alias("total_units_sold"),
        money_sum(F.col("total_amount")).alias("total_revenue"),
    )


def enrich_products(products: DataFrame, orders: DataFrame) -> DataFrame:
    joined = products.join(product_sales(orders), "product_id", "left")
    return joined.fillna({"total_units_sold": 0, "total_revenue": 0.0})


def rank_products(enriched: DataFrame) -> DataFrame:
    """Add the revenue rank over all products and inside the category (ties share a rank)."""
    staged = stage(enriched, "products")
    overall = stage(rank_desc(staged, "total_revenue", "revenue_rank"), "products-ranked")
    return rank_desc(overall, "total_revenue", "category_rank", ["category"])
