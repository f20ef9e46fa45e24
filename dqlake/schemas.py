"""Column contracts: raw tables, enums, schema baselines, report layout."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


# Raw tables: every column is a nullable string.
RAW = {
    "customers": _strings("customer_id", "name", "email", "country", "segment", "signup_date", "is_active"),
    "products": _strings("product_id", "sku", "product_name", "category", "unit_price", "cost_price", "in_stock"),
    "orders": _strings(
        "order_id", "customer_id", "product_id", "quantity", "unit_price", "discount_rate",
        "total_amount", "order_date", "order_status", "payment_method",
    ),
}
BUSINESS_KEY = {"customers": "customer_id", "products": "product_id", "orders": "order_id"}

# The business vocabularies.
SEGMENTS = ["Consumer", "Corporate", "Home Office", "Small Business"]
ORDER_STATUSES = ["Completed", "Pending", "Processing", "Shipped", "Cancelled", "Refunded"]
PAYMENT_METHODS = ["Credit Card", "Debit Card", "UPI", "Net Banking", "Wallet", "Cash on Delivery"]

# Columns a batch must have and columns it may have.
BASELINE = {
    "orders": {
        "required": ["order_id", "customer_id", "product_id", "quantity", "unit_price", "order_date"],
        "optional": ["discount_rate", "total_amount", "order_status", "payment_method"],
    },
    "customers": {
        "required": ["customer_id", "name", "email"],
        "optional": ["country", "segment", "signup_date", "is_active"],
    },
    "products": {
        "required": ["product_id", "sku", "product_name", "unit_price"],
        "optional": ["category", "cost_price", "in_stock"],
    },
}

METRIC = T.StructType([
    T.StructField("check_name", T.StringType()),
    T.StructField("dataset", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("records_checked", T.LongType()),
    T.StructField("records_passed", T.LongType()),
    T.StructField("records_failed", T.LongType()),
    T.StructField("pass_rate", T.DoubleType()),
    T.StructField("threshold", T.DoubleType()),
    T.StructField("details", T.StringType()),
])

# One document per run, as written by the gate.
REPORT = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("start_time", T.StringType()),
    T.StructField("end_time", T.StringType()),
    T.StructField("duration_seconds", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("total_records_ingested", T.LongType()),
    T.StructField("total_records_valid", T.LongType()),
    T.StructField("total_records_quarantined", T.LongType()),
    T.StructField("overall_quality_score", T.DoubleType()),
    T.StructField("quality_threshold", T.DoubleType()),
    T.StructField("metrics", T.ArrayType(METRIC)),
])

DIM_CUSTOMERS = (
    "customer_key bigint, customer_id string, name string, email string, country string, segment string, "
    "signup_date date, is_active boolean, customer_tier string, total_spend double, total_orders bigint, "
    "avg_order_value double, created_at timestamp_ntz"
)
DIM_PRODUCTS = (
    "product_key bigint, product_id string, sku string, product_name string, category string, unit_price double, "
    "cost_price double, profit_margin_pct double, in_stock int, total_units_sold bigint, total_revenue double, "
    "created_at timestamp_ntz"
)
FACT_ORDERS = (
    "order_key bigint, order_id string, customer_id string, product_id string, date_key int, order_date timestamp_ntz, "
    "quantity int, unit_price double, discount_rate double, total_amount double, order_status string, "
    "payment_method string, loaded_at timestamp_ntz, year int, month int"
)
AUDIT = (
    "audit_id bigint, run_id string, check_name string, dataset string, status string, records_checked bigint, "
    "records_passed bigint, records_failed bigint, pass_rate double, evaluated_at timestamp_ntz"
)
QUARANTINE_AUDIT = (
    "quarantine_key bigint, quarantine_id string, run_id string, dataset string, error_reasons string, "
    "raw_record string, quarantine_timestamp timestamp_ntz, is_resolved boolean"
)
