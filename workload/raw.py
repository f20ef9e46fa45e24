"""Raw tables with deterministic faults, derived from the shared test tables. The SQL runs in Spark and DuckDB alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dqlake.operators.keyed import ROW_ID
from dqlake.session import prepare

RAW_CUSTOMERS = """
SELECT CASE WHEN c_custkey % 397 = 13 THEN NULL WHEN c_custkey % 331 = 17 THEN 'CUST-' || lpad(cast(c_custkey + 1 AS string), 6, '0')
            ELSE 'CUST-' || lpad(cast(c_custkey AS string), 6, '0') END AS customer_id,
       CASE c_custkey % 3 WHEN 0 THEN '  ' || lower(c_name) || ' ' WHEN 1 THEN 'MARY-JANE O''BRIEN' ELSE c_name END AS name,
       CASE WHEN c_custkey % 389 = 5 THEN '  ' WHEN c_custkey % 383 = 6 THEN 'not_an_email' ELSE ' User' || cast(c_custkey AS string) || '@Example.COM' END AS email,
       CASE c_nationkey % 11 WHEN 0 THEN 'United States' WHEN 1 THEN 'USA' WHEN 2 THEN ' us ' WHEN 3 THEN 'United Kingdom' WHEN 4 THEN 'UK'
            WHEN 5 THEN 'India' WHEN 6 THEN 'Ind' WHEN 7 THEN 'Germany' WHEN 8 THEN 'Canada' WHEN 9 THEN 'France' END AS country,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'Corporate' WHEN 'FURNITURE' THEN 'Home Office' WHEN 'HOUSEHOLD' THEN 'Small Business' ELSE 'Consumer' END AS segment,
       '2022-' || lpad(cast(1 + c_custkey % 12 AS string), 2, '0') || '-' || lpad(cast(1 + c_custkey % 28 AS string), 2, '0') AS signup_date,
       CASE c_custkey % 4 WHEN 0 THEN 'True' WHEN 1 THEN '1' WHEN 2 THEN 'no' ELSE 'YES' END AS is_active
FROM customer
"""

RAW_PRODUCTS = """
SELECT 'P-PRD-' || cast(p_partkey AS string) AS product_id, ' prd-' || cast(p_partkey AS string) AS sku, p_name AS product_name, lower(p_type) AS category,
       CASE WHEN p_partkey % 211 = 3 THEN '-1' WHEN p_partkey % 223 = 9 THEN '5d' ELSE cast(cast(p_retailprice AS decimal(12,2)) AS string) END AS unit_price,
       cast(100 + p_size * 10 AS string) || '.25' AS cost_price,
       CASE WHEN p_size = 50 THEN NULL ELSE cast(p_size AS string) END AS in_stock
FROM part
"""

RAW_ORDERS = """
SELECT 'ORD-' || lpad(cast(CASE WHEN m = 3 THEN o_orderkey + 10 ELSE o_orderkey END AS string), 7, '0') AS order_id,
       CASE WHEN m = 2 THEN NULL WHEN m = 5 THEN 'CUST-ORPHAN-' || cast(900000 + o_orderkey AS string)
            ELSE 'CUST-' || lpad(cast(CASE WHEN o_custkey % 10 = 9 THEN o_custkey - 1 ELSE o_custkey END AS string), 6, '0') END AS customer_id,
       'P-PRD-' || cast((o_orderkey * 13) % 150 AS string) AS product_id,
       CASE WHEN m = 0 THEN '-3' WHEN m = 7 THEN '0' WHEN m = 20 THEN '2.5' ELSE cast(1 + o_orderkey % 5 AS string) END AS quantity,
       CASE WHEN m = 1 THEN '-' ELSE '' END || cast(1 + cast(floor(o_totalprice) AS bigint) % 400 AS string) || '.' || lpad(cast(o_orderkey % 100 AS string), 2, '0') AS unit_price,
       CASE WHEN m = 30 THEN NULL ELSE '0.' || lpad(cast((cast(floor(o_totalprice) AS bigint) % 7 % 5) * 5 AS string), 2, '0') END AS discount_rate,
       '0.0' AS total_amount,
       CASE WHEN m = 4 THEN '2026-99-99 25:99:99' ELSE
         cast(year(o_orderdate) + 28 AS string) || '-' || lpad(cast(month(o_orderdate) AS string), 2, '0') || '-' || lpad(cast(day(o_orderdate) AS string), 2, '0')
         || ' ' || lpad(cast(cast(floor(sod / 3600) AS int) AS string), 2, '0') || ':' || lpad(cast(cast(floor((sod % 3600) / 60) AS int) AS string), 2, '0') || ':' || lpad(cast(sod % 60 AS string), 2, '0') END AS order_date,
       CASE WHEN m = 6 THEN 'UNKNOWN_ERROR_STATUS' WHEN o_orderkey % 9 = 0 THEN 'Cancelled' WHEN o_orderstatus = 'F' THEN 'Completed' WHEN o_orderstatus = 'O' THEN 'Pending' ELSE 'Shipped' END AS order_status,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'UPI' WHEN '2-HIGH' THEN 'Wallet' WHEN '3-MEDIUM' THEN 'Credit Card' WHEN '4-NOT SPECIFIED' THEN 'Net Banking' ELSE 'Cash on Delivery' END AS payment_method
FROM (SELECT *, o_orderkey % 160 AS m, (o_orderkey * 3607) % 86400 AS sod FROM orders) o
"""

SQL = {"customers": RAW_CUSTOMERS, "products": RAW_PRODUCTS, "orders": RAW_ORDERS}
SOURCE = {"customers": "customer", "products": "part", "orders": "orders"}


KEY = {"customers": "c_custkey", "products": "p_partkey", "orders": "o_orderkey"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_table(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    """The raw table; the source's own key serves as row id."""
    source, key = SOURCE[dataset], KEY[dataset]
    text = SQL[dataset].strip().replace(f"FROM {source}", "FROM {src}")
    text = text.replace("SELECT ", f"SELECT {key} AS {ROW_ID}, ", 1)
    return spark.sql(text, src=table(spark, sf_dir, source))


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    prepare(spark).conf.set("spark.sql.session.timeZone", "UTC")
    return {d: raw_table(spark, sf_dir, d) for d in SQL}


def plain_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The raw tables without row id, as files would hold them."""
    return {d: df.drop(ROW_ID) for d, df in raw_tables(spark, sf_dir).items()}
