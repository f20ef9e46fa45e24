"""Marts kept by month: only touched months are read, merged sets are exact, a refresh that dies changes nothing."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from dqlake.plans import marts, months, warehouse
from dqlake.plans.layout import Layout

AT = datetime(2024, 6, 1, 8)
ORDER = (
    "order_id string, customer_id string, product_id string, quantity int, unit_price double, discount_rate double, total_amount double, "
    "order_date timestamp_ntz, order_status string, payment_method string, year int, month int")
CUSTOMER = (
    "customer_id string, name string, email string, country string, segment string, signup_date date, is_active boolean, customer_tier string, "
    "total_spend double, total_orders bigint, avg_order_value double")
PRODUCT = (
    "product_id string, sku string, product_name string, category string, unit_price double, cost_price double, profit_margin_pct double, "
    "in_stock int, total_units_sold bigint, total_revenue double")


def load(spark, layout, orders, customers, run, full_refresh=False):
    """``orders``: (order id, customer id, month of 2024, amount)."""
    rows = [(o, c, "P", 1, a, 0.0, a, datetime(2024, m, 1 + len(o)), "Completed", "UPI", 2024, m) for o, c, m, a in orders]
    spark.createDataFrame(rows, ORDER).write.mode("overwrite").partitionBy("year", "month").parquet(layout.lake("fact_orders"))
    people = [(c, c, "e", "X", "Consumer", date(2024, 1, 1), True, "Gold" if c < "C-4" else "Bronze", 10.25, 1, 10.25) for c in customers]
    spark.createDataFrame(people, CUSTOMER).write.mode("overwrite").parquet(layout.lake("dim_customers"))
    spark.createDataFrame([("P", "s", "n", "c", 1.0, 1.0, 0.0, 1, 1, 1.0)], PRODUCT).write.mode("overwrite").parquet(layout.lake("dim_products"))
    warehouse.load(spark, layout, run, AT, full_refresh)


def agree(spark, layout, kept):
    """All three marts from what is kept are those from the whole star."""
    star = warehouse.star(spark, layout)
    pairs = [
        (months.monthly_revenue(kept, star["dim_date"]), marts.monthly_revenue(star["fact_orders"], star["dim_date"])),
        (months.executive_summary(kept, star["data_quality_audit"]), marts.executive_summary(star["fact_orders"], star["data_quality_audit"])),
        (months.customer_retention(star["dim_customers"]), marts.customer_retention(star["dim_customers"])),
    ]
    for got, want in pairs:
        assert got.columns == want.columns
        assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()]


def test_refreshed_months_are_the_whole(spark, tmp_path, monkeypatch):
    layout = Layout(str(tmp_path))
    none = months.refresh(spark, layout)
    assert none.rebuilt == [] and months.totals_by(none, []).first()["total_orders"] == 0
    orders = [("O-1", "C-1", 1, 10.1), ("O-2", "C-1", 1, 20.2), ("O-3", "C-2", 2, 5.0), ("O-4", "C-1", 2, 7.0), ("O-5", "X-9", 2, 1.0), ("O-6", None, 2, 1.5)]
    load(spark, layout, orders, ["C-1", "C-2"], "r1")
    kept = months.refresh(spark, layout)
    assert kept.rebuilt == [(2024, 1), (2024, 2)]
    agree(spark, layout, kept)
    assert months.refresh(spark, layout).rebuilt == []
    # X-9 gets a key; February still names it by its id, March by its key, and it stays one customer.
    load(spark, layout, [("O-7", "X-9", 3, 2.0), ("O-8", "C-5", 3, None)], ["C-1", "C-2", "C-5", "X-9"], "r2")
    march = [m for m in warehouse.fact_months(spark, layout) if m["month"] == 3]
    assert all("month=3" in f for f in warehouse.facts_of(spark, layout, march).inputFiles())
    kept = months.refresh(spark, layout)
    assert kept.rebuilt == [(2024, 3)]
    assert sorted(r["month"] for r in kept.others.collect()) == [2]
    agree(spark, layout, kept)
    assert months.executive_summary(kept, warehouse.read_table(spark, layout, "data_quality_audit")).first()["active_customers"] == 4
    # An order moves from January to March. A refresh that dies half-way leaves nothing that counts.
    load(spark, layout, [("O-1", "C-1", 3, 10.1)], ["C-1", "C-2", "C-5", "X-9"], "r3")
    write = months.write_parquet

    def killed(df, path, cols=()):
        if path.endswith("others"):
            raise RuntimeError("killed")
        write(df, path, cols)

    with monkeypatch.context() as m:
        m.setattr(months, "write_parquet", killed)
        with pytest.raises(RuntimeError, match="killed"):
            months.refresh(spark, layout)
    kept = months.refresh(spark, layout)
    assert kept.rebuilt == [(2024, 1), (2024, 3)]
    agree(spark, layout, kept)
    # A full refresh may give keys anew, so nothing that was kept counts; C-1 goes, another takes a number.
    load(spark, layout, [("O-3", "C-2", 2, 5.0), ("O-9", "C-7", 2, 6.0)], ["C-2", "C-7"], "r4", full_refresh=True)
    kept = months.refresh(spark, layout)
    assert kept.rebuilt == [(2024, 2)]
    agree(spark, layout, kept)


def test_a_full_refresh_without_orders_and_a_load_after_it(spark, tmp_path):
    layout = Layout(str(tmp_path))
    load(spark, layout, [("O-1", "C-1", 1, 1.0)], ["C-1"], "r1")
    months.refresh(spark, layout)
    spark.createDataFrame([], ORDER).drop("year", "month").withColumns({"year": F.lit(2024), "month": F.lit(1)}).write.mode("overwrite").parquet(layout.lake("fact_orders"))
    warehouse.load(spark, layout, "r2", AT, full_refresh=True)
    kept = months.refresh(spark, layout)
    assert kept.rebuilt == [] and months.totals_by(kept, []).first()["total_orders"] == 0
    load(spark, layout, [("O-2", "C-1", 1, 3.0)], ["C-1"], "r3")
    kept = months.refresh(spark, layout)
    assert kept.rebuilt == [(2024, 1)]
    agree(spark, layout, kept)


def test_keys_over_many_buckets(spark):
    keyed = spark.range(0, 200_000, 7).select((F.col("id") + 1).alias("customer_key"), (F.col("id") % 3).cast("int").alias("month"))
    both = keyed.unionByName(keyed)
    got = months.bitmaps(both, ["month"]).groupBy("month").agg(F.sum(F.bitmap_count("bits")).alias("n")).orderBy("month").collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in keyed.groupBy("month").count().orderBy("month").collect()]
