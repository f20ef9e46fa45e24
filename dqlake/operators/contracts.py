"""Contracts of the clean tables as column expressions: one list of violations per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from dqlake import schemas
from dqlake.functions import boolean_of, date_of, number, round2, strip, timestamp_of, title
from dqlake.functions.text import lookup

# Title-case spellings mapped by the record-level country rule. Others stay as they are.
COUNTRY_SPELLINGS = {
    "Us": "United States",
    "Usa": "United States",
    "United States Of America": "United States",
    "Uk": "United Kingdom",
    "In": "India",
    "Ind": "India",
    "De": "Germany",
    "Ca": "Canada",
}


def standard_country(c: Column) -> Column:
    """Trimmed, title case, known spellings mapped, everything else kept."""
    name = title(strip(c))
    return F.coalesce(lookup(name, COUNTRY_SPELLINGS), name)


def _length(column: str, least: int, most: int) -> tuple[str, Column]:
    c = F.col(column)
    return f"{column} length not in {least}..{most}", ~F.coalesce(F.char_length(c).between(least, most), F.lit(False))


def _holds(text: str, condition: Column) -> tuple[str, Column]:
    """A requirement; null counts as broken."""
    return text, ~F.coalesce(condition, F.lit(False))


def _one_of(column: str, values: Sequence[str]) -> tuple[str, Column]:
    return _holds(f"{column} not allowed", F.col(column).isin(list(values)))


def requirements(dataset: str) -> list[tuple[str, Column]]:
    """Violation text and failing condition of each field of a raw row."""
    n = {c: number(F.col(c)) for c in ("unit_price", "cost_price", "in_stock", "quantity", "total_amount")}
    discount = F.col("discount_rate")
    if dataset == "customers":
        return [
            _length("customer_id", 3, 50),
            _length("name", 1, 255),
            _length("email", 5, 255),
            _length("country", 2, 100),
            _one_of("segment", schemas.SEGMENTS),
            _holds("signup_date is not a date", date_of(F.col("signup_date")).isNotNull()),
        ]
    if dataset == "products":
        return [
            _length("product_id", 3, 50),
            _length("sku", 3, 50),
            _length("product_name", 1, 255),
            _length("category", 1, 100),
            _holds("unit_price not above 0", n["unit_price"] > 0),
            _holds("cost_price below 0", n["cost_price"] >= 0),
            _holds("in_stock not a whole number from 0", (n["in_stock"] >= 0) & (n["in_stock"] == F.floor(n["in_stock"]))),
        ]
    if dataset == "orders":
        return [
            _length("order_id", 3, 50),
            _length("customer_id", 3, 50),
            _length("product_id", 3, 50),
            _holds("quantity not a whole number above 0", (n["quantity"] > 0) & (n["quantity"] == F.floor(n["quantity"]))),
            _holds("unit_price not above 0", n["unit_price"] > 0),
            _holds("discount_rate not in 0..1", discount.isNull() | number(discount).between(0.0, 1.0)),
            _holds("total_amount below 0", n["total_amount"] >= 0),
            _holds("order_date is not a timestamp", timestamp_of(F.col("order_date")).isNotNull()),
            _one_of("order_status", schemas.ORDER_STATUSES),
            _one_of("payment_method", schemas.PAYMENT_METHODS),
        ]
    raise ValueError(f"unknown dataset {dataset!r}")


def violations(dataset: str) -> Column:
    return F.array_compact(F.array(*[F.when(bad, F.lit(text)) for text, bad in requirements(dataset)]))


def check_contract(rows: DataFrame, dataset: str) -> DataFrame:
    """Add ``violations`` and the fields a record derives from itself."""
    out = rows.withColumn("violations", violations(dataset))
    if dataset == "customers":
        active = F.when(F.col("is_active").isNull(), True).otherwise(boolean_of(F.col("is_active")))
        return out.withColumns({"standard_country": standard_country(F.col("country")), "active": active})
    if dataset == "products":
        price, cost = number(F.col("unit_price")), number(F.col("cost_price"))
        margin = F.when(price > 0, round2((price - cost) / price * 100)).otherwise(F.lit(0.0))
        return out.withColumn("profit_margin", margin)
    at = timestamp_of(F.col("order_date"))
    return out.withColumns({"year": F.year(at), "month": F.month(at), "day": F.dayofmonth(at)})
