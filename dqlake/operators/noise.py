"""Planting of named faults in clean rows, for testing a gate.

Which rows are hit depends only on a whole-number key of the row, so the result is the same on every run and every
cluster size. Of each ``period`` keys, one gets each fault of the list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Fault kinds and the texts they plant.
ORDER_FAULTS = [
    "negative_quantity", "negative_price", "null_customer_id", "duplicate_order_id",
    "invalid_date_format", "orphan_foreign_key", "corrupted_status", "zero_quantity",
]
CUSTOMER_FAULTS = ["missing_id", "invalid_email", "null_name"]
BAD_DATE = "2026-99-99 25:99:99"
BAD_STATUS = "UNKNOWN_ERROR_STATUS"
BAD_EMAIL = "not_an_email"
ORPHAN = "CUST-ORPHAN-"


def period_for(rate: float, kinds: int) -> int:
    """Period at which ``kinds`` faults hit about ``rate`` of the rows."""
    if not 0 < rate <= 1:
        raise ValueError("rate must be above 0 and at most 1")
    return max(kinds, round(kinds / rate))


def fault_of(key: Column, faults: list[str], period: int) -> Column:
    """The fault planted in the row with this key; null for most rows."""
    return F.try_element_at(F.array(*[F.lit(f) for f in faults]), (F.pmod(key, F.lit(period)) + 1).cast("int"))


def inject_orders(orders: DataFrame, key: Column, other_id: Column, period: int = 160) -> DataFrame:
    """``other_id`` is the order id of another row, taken for the duplicate fault."""
    f = F.col("fault")
    qty, price = F.col("quantity"), F.col("unit_price")
    return orders.withColumn("fault", fault_of(key, ORDER_FAULTS, period)).withColumns({
        "order_id": F.when(f == "duplicate_order_id", other_id).otherwise(F.col("order_id")),
        "customer_id": F.when(f == "null_customer_id", F.lit(None))
        .when(f == "orphan_foreign_key", F.concat(F.lit(ORPHAN), (key + 900000).cast("string")))
        .otherwise(F.col("customer_id")),
        "quantity": F.when(f == "negative_quantity", "-3").when(f == "zero_quantity", "0").otherwise(qty),
        "unit_price": F.when(f == "negative_price", F.concat(F.lit("-"), price)).otherwise(price),
        "order_date": F.when(f == "invalid_date_format", BAD_DATE).otherwise(F.col("order_date")),
        "order_status": F.when(f == "corrupted_status", BAD_STATUS).otherwise(F.col("order_status")),
    })


def inject_customers(customers: DataFrame, key: Column, period: int = 120) -> DataFrame:
    f = F.col("fault")
    return customers.withColumn("fault", fault_of(key, CUSTOMER_FAULTS, period)).withColumns({
        "customer_id": F.when(f == "missing_id", F.lit(None)).otherwise(F.col("customer_id")),
        "email": F.when(f == "invalid_email", BAD_EMAIL).otherwise(F.col("email")),
        "name": F.when(f == "null_name", F.lit(None)).otherwise(F.col("name")),
    })
