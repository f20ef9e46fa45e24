"""Gate, lake, star schema, marts and replay on small batches."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from dqlake import schemas
from dqlake.operators.clean import clean_customers, clean_orders, clean_products
from dqlake.operators.enrich import enrich_customers, enrich_products, tier
from dqlake.plans import lake, marts, warehouse
from dqlake.plans.gate import evaluate_batch, quarantine_page, read_history, read_quarantine, snapshot
from dqlake.plans.job import replay, run_batch, run_files
from dqlake.plans.layout import Layout
from dqlake.sources.files import read_documents, write_csv

AT = datetime(2024, 6, 1, 8)
CUSTOMER = " ".join(schemas.RAW["customers"].fieldNames())
PRODUCT = " ".join(schemas.RAW["products"].fieldNames())
ORDER = " ".join(schemas.RAW["orders"].fieldNames())


def order(oid, customer="C-1", product="P-1", quantity="2", price="1500.0", when="2024-03-15 10:00:00",
          status="Completed", discount="0.0"):
    return (oid, customer, product, quantity, price, discount, "0", when, status, "UPI")


@pytest.fixture(scope="module")
def make(table):
    def batch(orders, customers=None, products=None):
        customers = customers or [("C-1", "john doe", "J@X.com", "usa", "Corporate", "2024-01-01", "True")]
        products = products or [("P-1", "sku-1", "Laptop", "hardware", "1500.0", "1000.0", "5"),
                                ("P-2", "sku-2", "Mouse", "hardware", "20", None, None)]
        return {"customers": table(CUSTOMER, customers), "products": table(PRODUCT, products),
                "orders": table(ORDER, orders)}

    return batch


def test_cleaning(table):
    got = clean_customers(table(CUSTOMER, [
        (" c1 ", "jane o'neil", " A@B.Com", "usa", " Consumer ", "2024-01-05", "True"),
        ("c2", None, "x@y", "ind", "Corporate", "bad", "false"),
    ])).orderBy("customer_id").collect()
    assert tuple(got[0]) == ("c1", "Jane O'Neil", "a@b.com", "United States", "Consumer", date(2024, 1, 5), True)
    assert tuple(got[1]) == ("c2", None, "x@y", "India", "Corporate", None, False)
    p = clean_products(table(PRODUCT, [("p", " ab ", "n ", None, "3", "1", "2.9")])).first()
    assert (p["sku"], p["category"], p["in_stock"], p["profit_margin_pct"]) == ("AB", "Unknown", 2, 66.67)
    o = clean_orders(table(ORDER, [order("o", quantity="2.9", price="10.005", discount=None)])).first()
    assert (o["quantity"], o["discount_rate"], o["total_amount"], o["year"], o["month"], o["day"]) == (
        2, 0.0, 20.01, 2024, 3, 15)


def test_rfm_tiers_and_recency(spark):
    customers = spark.createDataFrame([("a", "A"), ("b", None), ("c", "C")], "customer_id string, name string")
    orders = spark.createDataFrame(
        [("1", "a", 10000.0, datetime(2024, 1, 1, 10)), ("2", "a", 1000.0, datetime(2024, 1, 3, 9)),
         ("3", "b", 200.0, datetime(2024, 1, 1, 9, 30))],
        "order_id string, customer_id string, total_amount double, order_date timestamp_ntz")
    got = {r["customer_id"]: r for r in enrich_customers(customers, orders).collect()}
    assert (got["a"]["total_spend"], got["a"]["total_orders"], got["a"]["avg_order_value"]) == (11000.0, 2, 5500.0)
    assert (got["a"]["customer_tier"], got["a"]["days_since_last_order"]) == ("Diamond", 0)
    assert (got["b"]["customer_tier"], got["b"]["days_since_last_order"], got["b"]["name"]) == ("Bronze", 1, "Unknown")
    assert (got["c"]["total_spend"], got["c"]["days_since_last_order"], got["c"]["customer_tier"]) == (0.0, 999, "Bronze")
    none = enrich_customers(customers, orders.limit(0))
    assert none.columns == enrich_customers(customers, orders).columns
    assert {r["days_since_last_order"] for r in none.collect()} == {999}
    edges = spark.createDataFrame([(9999.99,), (10000.0,), (5000.0,), (1000.0,), (999.99,)], "s double")
    assert [r[0] for r in edges.select(tier(F.col("s"))).collect()] == ["Gold", "Diamond", "Gold", "Silver", "Bronze"]


def test_calendar(spark):
    days = warehouse.dim_date(spark)
    assert days.count() == 1826
    row = days.where("date_key = 20240302").first()
    assert (row["quarter"], row["month_name"], row["day_of_week"], row["day_name"], row["is_weekend"]) == (
        1, "March", 5, "Saturday", True)
    assert warehouse.dim_date(spark, date(1, 1, 1), date(9999, 12, 31)).count() == 3652059


def test_lake_and_star(spark, make, tmp_path):
    root = str(tmp_path)
    batch = make([order("O-1"), order("O-2", when="2024-04-02 00:00:00", quantity="1", price="10")])
    out = run_batch(batch, root, "r1", 90.0, AT)
    assert (out["status"], out["quality_score"], out["orders_processed"], out["partitions_created"]) == (
        "SUCCESS", 100.0, 2, 2)
    assert out["load_stats"] == {
        "customers_loaded": 1, "products_loaded": 2, "orders_loaded": 2, "audit_records_loaded": 15,
        "quarantine_records_loaded": 0}
    star = warehouse.star(spark, Layout(root))
    marts.register_views(star)
    months = marts.query_mart(spark, "monthly_revenue").collect()
    assert [(r["year"], r["month"], r["month_name"], r["total_orders"], r["total_revenue"], r["avg_order_value"])
            for r in months] == [(2024, 4, "April", 1, 10.0, 10.0), (2024, 3, "March", 1, 3000.0, 3000.0)]
    assert [r["month"] for r in marts.monthly_chart(marts.query_mart(spark, "monthly_revenue")).collect()] == [3, 4]
    products = marts.query_mart(spark, "v_mart_top_products").collect()
    assert [(r["product_id"], r["order_count"], r["units_sold"], r["gross_revenue"]) for r in products] == [
        ("P-1", 2, 3, 3010.0), ("P-2", 0, None, None)]
    assert marts.query_mart(spark, "customer_retention").first()["aggregate_spend"] == 3010.0
    trend = marts.recent_trends(marts.query_mart(spark, "quality_trends")).first()
    assert (trend["run_id"], trend["checks_executed"], trend["avg_check_pass_rate"]) == ("r1", 15, 100.0)
    kpis = marts.executive_summary(star["fact_orders"], star["data_quality_audit"]).first()
    assert tuple(kpis) == (3010.0, 2, 1, 1505.0, 100.0)
    with pytest.raises(ValueError):
        marts.query_mart(spark, "secrets; drop table x")
    none = marts.executive_summary(star["fact_orders"].limit(0), star["data_quality_audit"].limit(0)).first()
    assert tuple(none) == (0.0, 0, 0, 0.0, None)


def snapshot_of(spark, layout, table):
    df = warehouse.read_table(spark, layout, table)
    return sorted((str(r.asDict()) for r in df.drop("created_at", "loaded_at").collect()))


def test_loading_twice_changes_nothing(spark, make, tmp_path):
    layout = Layout(str(tmp_path))
    run_batch(make([order("O-1"), order("O-2"), order("O-2"), order("O-3", when="2029-01-01")]), layout.root, "r1", 0.0, AT)
    before = {t: snapshot_of(spark, layout, t) for t in warehouse.TABLES}
    assert len(before["quarantine_audit"]) == 2 and len(before["fact_orders"]) == 2
    warehouse.load(spark, layout, "r1", AT)
    assert {t: snapshot_of(spark, layout, t) for t in warehouse.TABLES} == before
    star = warehouse.star(spark, layout)
    assert marts.outside_calendar(star["fact_orders"], star["dim_date"]).first()[0] == 1
    assert warehouse.orphans(star["fact_orders"], star["dim_customers"], star["dim_products"]).count() == 0


def test_upsert_keeps_old_rows_and_moves_months(spark, make, tmp_path):
    layout = Layout(str(tmp_path))
    two = [("C-1", "a", "a@x", "us", "Consumer", "2024-01-01", "1"), ("C-2", "b", "b@x", "us", "Consumer", "2024-01-01", "1")]
    run_batch(make([order("O-1"), order("O-2", when="2024-05-01")], two), layout.root, "r1", 0.0, AT)
    keys = {r["order_id"]: r["order_key"] for r in warehouse.read_table(spark, layout, "fact_orders").collect()}
    # O-1 moves to another month, so March is left without orders; O-2 is not sent again; O-3 is new.
    run_batch(make([order("O-1", when="2024-05-09"), order("O-3", when="2024-06-01")]), layout.root, "r2", 0.0, AT)
    facts = {r["order_id"]: r for r in warehouse.read_table(spark, layout, "fact_orders").collect()}
    assert {k: (r["date_key"], r["order_key"]) for k, r in facts.items()} == {
        "O-1": (20240509, keys["O-1"]), "O-2": (20240501, keys["O-2"]), "O-3": (20240601, facts["O-3"]["order_key"])}
    assert len({r["order_key"] for r in facts.values()}) == 3
    assert {m["month"] for m in warehouse.fact_months(spark, layout)} == {5, 6}
    customers = {r["customer_id"]: r["customer_key"] for r in warehouse.read_table(spark, layout, "dim_customers").collect()}
    assert customers == {"C-1": 1, "C-2": 2}
    # A later batch that keeps every month occupied rewrites only the months it touches.
    run_batch(make([order("O-4", when="2024-06-02")]), layout.root, "r3", 0.0, AT)
    facts = warehouse.read_table(spark, layout, "fact_orders")
    assert sorted(r["order_id"] for r in facts.collect()) == ["O-1", "O-2", "O-3", "O-4"]
    runs = warehouse.read_table(spark, layout, "data_quality_audit").groupBy("run_id").count().collect()
    assert {r["run_id"]: r["count"] for r in runs} == {"r1": 15, "r2": 15, "r3": 15}
    warehouse.load(spark, layout, "r3", AT, full_refresh=True)
    assert warehouse.read_table(spark, layout, "fact_orders").count() == 1


@pytest.mark.parametrize("full_refresh", [False, True])
def test_a_load_that_dies_leaves_the_facts_as_they_were(spark, make, tmp_path, monkeypatch, full_refresh):
    layout = Layout(str(tmp_path))
    run_batch(make([order("O-1"), order("O-2", when="2024-05-01")]), layout.root, "r1", 0.0, AT)
    before = snapshot_of(spark, layout, "fact_orders")

    def killed(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(warehouse, "_publish_months", killed)  # all months are written, none is named yet
        with pytest.raises(RuntimeError, match="killed"):
            run_batch(make([order("O-1", when="2024-05-09"), order("O-3", when="2024-06-01")]), layout.root, "r2", 0.0, AT)
    assert snapshot_of(spark, layout, "fact_orders") == before
    warehouse.load(spark, layout, "r2", AT, full_refresh)  # the next attempt writes over what the dead one left
    left = ["O-1", "O-3"] if full_refresh else ["O-1", "O-2", "O-3"]
    assert sorted(r["order_id"] for r in warehouse.read_table(spark, layout, "fact_orders").collect()) == left


def test_orders_that_share_a_key_stop_the_load(spark, make, tmp_path, monkeypatch):
    layout = Layout(str(tmp_path))
    run_batch(make([order("O-1")]), layout.root, "r1", 0.0, AT)
    monkeypatch.setattr(warehouse, "fact_key", lambda: warehouse.hash_key(F.lit("O-1")))
    with pytest.raises(ValueError, match="'O-1' and 'O-9' have the same key"):
        run_batch(make([order("O-9")]), layout.root, "r2", 0.0, AT)
    assert [r["order_id"] for r in warehouse.read_table(spark, layout, "fact_orders").collect()] == ["O-1"]


def test_a_month_filter_reads_its_own_files_only(spark, make, tmp_path):
    layout = Layout(str(tmp_path))
    run_batch(make([order("O-1"), order("O-2", when="2024-05-01")]), layout.root, "r1", 0.0, AT)
    facts = warehouse.read_table(spark, layout, "fact_orders")
    assert "PartitionFilters: [isnotnull(year" in facts.where("year = 2024 AND month = 5").select("order_id")._jdf.queryExecution().executedPlan().toString()
    assert "load" not in facts.columns and facts.where("month = 5").count() == 1


def test_raw_rows_of_all_runs_are_one_table(spark, make, tmp_path):
    layout = Layout(str(tmp_path))
    for n, extra in enumerate(("a", "b")):
        raw = make([order(f"O-{n}")])
        snapshot({**raw, "orders": raw["orders"].withColumn(extra, F.lit(n).cast("string"))}, layout, f"r{n}")
    rows = read_history(spark, layout, "orders").select("run_id", "order_id", "a", "b").collect()
    assert sorted(map(tuple, rows), key=repr) == [("r0", "O-0", "0", None), ("r1", "O-1", None, "1")]


def test_keys_that_collide_after_trimming_load_once(spark, make, tmp_path):
    layout = Layout(str(tmp_path))
    run_batch(make([order("O-1", when="2024-03-02"), order(" O-1 ", when="2024-03-01")]), layout.root, "r1", 0.0, AT)
    facts = warehouse.read_table(spark, layout, "fact_orders").collect()
    assert [(r["order_id"], r["date_key"]) for r in facts] == [("O-1", 20240301)]


def test_breaker_stops_after_quarantine_and_report(spark, make, tmp_path):
    layout = Layout(str(tmp_path))
    batch = make([order("O-1"), order("O-2", quantity="-1"), order("O-3", customer="ghost")])
    out = run_batch(batch, layout.root, "r1", 99.0, AT)
    assert out["status"] == "BLOCKED_BY_QUALITY_GATE" and out["load_stats"] is None
    assert not (tmp_path / "processed").exists() and not (tmp_path / "warehouse").exists()
    report = read_documents(spark, layout.reports, schemas.REPORT).first()
    assert report["status"] == "FAILED_QUALITY_GATE" and len(report["metrics"]) == 15
    total, page = quarantine_page(read_quarantine(spark, layout, "orders", "r1"), 1)
    assert (total, page.count()) == (2, 1)
    with pytest.raises(ValueError):
        quarantine_page(page, 501)
    assert read_quarantine(spark, layout, "products", "r1").count() == 0


def test_override_publishes_a_failed_batch(make, tmp_path):
    layout = Layout(str(tmp_path))
    result = evaluate_batch(make([order("O-1"), order("O-2", quantity="0")]), layout, "r1", 99.0, AT)
    with pytest.raises(lake.GateClosed):
        lake.publish_if_passed(result, layout, "r1")
    manifest = lake.publish_if_passed(result, layout, "r1", override=True, at=AT).first()
    assert manifest["records_processed"]["orders"] == 1
    assert [(p["year"], p["month"]) for p in manifest["partitions"]] == [(2024, 3)]


def test_replay_uses_the_kept_rows(spark, make, tmp_path):
    root = str(tmp_path)
    batch = make([order("O-1"), order("O-2", quantity="-1")])
    assert run_batch(batch, root, "r1", 95.0, AT)["status"] == "BLOCKED_BY_QUALITY_GATE"
    again = replay(spark, root, "r1", threshold=50.0, at=AT)
    assert (again["status"], again["checkpoint"], again["orders_processed"]) == ("SUCCESS", "VALIDATION", 1)
    assert read_quarantine(spark, Layout(root), "orders", "r1").count() == 1
    mended = replay(spark, root, "r1", raw=make([order("O-1"), order("O-2")]), at=AT)
    assert (mended["total_quarantined"], mended["load_stats"]["quarantine_records_loaded"]) == (0, 0)
    assert read_quarantine(spark, Layout(root), "orders", "r1").count() == 0
    assert warehouse.read_table(spark, Layout(root), "quarantine_audit").count() == 0
    assert replay(spark, root, "r3", source_run="r1", threshold=50.0, at=AT)["total_quarantined"] == 1  # the kept rows are as they were
    given = replay(spark, root, "r2", raw=make([order("O-9")]), at=AT)
    assert (given["quality_score"], given["load_stats"]["orders_loaded"]) == (100.0, 1)


def test_run_from_csv_files(spark, make, tmp_path):
    batch = make([order("O-1"), order("O-2", customer=None)])
    paths = {d: str(tmp_path / "in" / d) for d in batch}
    for d, df in batch.items():
        write_csv(df, paths[d])
    out = run_files(spark, paths, str(tmp_path / "lake"), "r1", 60.0, AT)
    assert (out["status"], out["total_quarantined"]) == ("SUCCESS", 1)
    write_csv(batch["orders"].drop("quantity"), paths["orders"])
    with pytest.raises(ValueError):
        run_files(spark, paths, str(tmp_path / "lake"), "r2", 60.0, AT)


def test_products_keep_defaults(spark, make):
    batch = make([order("O-1")])
    got = {r["product_id"]: r for r in enrich_products(
        clean_products(batch["products"]), clean_orders(batch["orders"])).collect()}
    assert (got["P-2"]["total_units_sold"], got["P-2"]["total_revenue"], got["P-2"]["in_stock"]) == (0, 0.0, 0)
    assert got["P-2"]["profit_margin_pct"] is None and got["P-1"]["profit_margin_pct"] == 33.33


def test_noise_hits_the_stated_share(spark):
    from dqlake.operators import noise

    ids = spark.range(1600).select(
        F.col("id"), F.concat(F.lit("O-"), "id").alias("order_id"), F.lit("C").alias("customer_id"),
        F.lit("1").alias("quantity"), F.lit("5").alias("unit_price"), F.lit("2024-01-01").alias("order_date"),
        F.lit("Completed").alias("order_status"))
    period = noise.period_for(0.05, len(noise.ORDER_FAULTS))
    assert period == 160
    hit = noise.inject_orders(ids, F.col("id"), F.concat(F.lit("O-"), F.col("id") + 10), period)
    counts = {r["fault"]: r["count"] for r in hit.groupBy("fault").count().collect()}
    assert counts.pop(None) == 1520 and set(counts.values()) == {10} and set(counts) == set(noise.ORDER_FAULTS)
    people = spark.range(240).select("id", F.lit("C").alias("customer_id"), F.lit("n").alias("name"), F.lit("e@x").alias("email"))
    flaws = noise.inject_customers(people, F.col("id")).where("fault IS NOT NULL")
    assert flaws.count() == 6 and flaws.where("customer_id IS NULL").count() == 2
    with pytest.raises(ValueError):
        noise.period_for(0, 8)
