"""Typing and standardising of valid rows, one projection per dataset. A null text stays null."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from dqlake import schemas
from dqlake.functions import boolean_of, country, date_of, number, round2, strip, timestamp_of, title
from dqlake.functions.numbers import net_amount

UNKNOWN = "Unknown"


def profit_margin(price, cost):
    """Margin in percent of the price; 0 when the price is not positive."""
    return F.when(price > 0, round2((price - cost) / price * 100)).otherwise(F.lit(0.0))


def with_baseline(df: DataFrame, dataset: str) -> DataFrame:
    """Adds the dataset's optional columns that are absent, as null texts; a required one that is absent is an error."""
    missing = [c for c in schemas.BASELINE[dataset]["required"] if c not in df.columns]
    if missing:
        raise ValueError(f"{dataset} lack required columns: {missing}")
    absent = [c for c in schemas.RAW[dataset].fieldNames() if c not in df.columns]
    return df.withColumns({c: F.lit(None).cast("string") for c in absent}) if absent else df


def clean_customers(df: DataFrame) -> DataFrame:
    df = with_baseline(df, "customers")
    return df.withColumns({
        "customer_id": strip(F.col("customer_id")),
        "name": title(strip(F.col("name"))),
        "email": F.lower(strip(F.col("email"))),
        "country": country(F.col("country")),
        "segment": strip(F.col("segment")),
        "signup_date": date_of(F.col("signup_date")),
        "is_active": boolean_of(F.col("is_active")),
    })


def clean_products(df: DataFrame) -> DataFrame:
    df = with_baseline(df, "products")
    typed = df.withColumns({
        "product_id": strip(F.col("product_id")),
        "sku": F.upper(strip(F.col("sku"))),
        "product_name": strip(F.col("product_name")),
        "category": F.coalesce(title(strip(F.col("category"))), F.lit(UNKNOWN)),
        "unit_price": number(F.col("unit_price")),
        "cost_price": number(F.col("cost_price")),
        "in_stock": F.coalesce(number(F.col("in_stock")).try_cast("int"), F.lit(0)),
    })
    return typed.withColumn("profit_margin_pct", profit_margin(F.col("unit_price"), F.col("cost_price")))


def clean_orders(df: DataFrame) -> DataFrame:
    """The stated total is ignored: the net amount is computed from the truncated quantity."""
    df = with_baseline(df, "orders")
    at = timestamp_of(F.col("order_date"))
    typed = df.withColumns({
        "order_id": strip(F.col("order_id")),
        "customer_id": strip(F.col("customer_id")),
        "product_id": strip(F.col("product_id")),
        "quantity": number(F.col("quantity")).cast("int"),
        "unit_price": number(F.col("unit_price")),
        "discount_rate": F.coalesce(number(F.col("discount_rate")), F.lit(0.0)),
        "order_date": at,
        "order_status": strip(F.col("order_status")),
        "payment_method": F.coalesce(strip(F.col("payment_method")), F.lit(UNKNOWN)),
    })
    net = net_amount(F.col("quantity").cast("double"), F.col("unit_price"), F.col("discount_rate"))
    return typed.withColumns({
        "total_amount": net,
        "year": F.year("order_date"),
        "month": F.month("order_date"),
        "day": F.dayofmonth("order_date"),
    })
