"""The shape of the physical plans: no Python, no nested loops, pruned scans, spread keys."""

import pytest

from dqlake.plans import lake, marts, warehouse
from dqlake.plans.batch import flag_batch
from workload.queries import queries
from workload.raw import raw_tables

SF = "/root/testdata/sf0.001"
LAZY = ["orders_flagged_reasons", "orders_valid", "quality_metrics", "enrich_products", "clean_orders", "mart_monthly_revenue",
        "mart_top_products", "orphan_report", "contract_orders", "outside_calendar"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_nested_loops(spark, name):
    text = plan(queries()[name](spark, SF))
    for word in ("Python", "Pandas", "NestedLoop", "CartesianProduct"):
        assert word not in text


def exchanges(df):
    """The shuffles of a plan with the number of columns that each moves."""
    executed = df._jdf.queryExecution().executedPlan()
    found, todo = [], [executed.initialPlan() if "AdaptiveSparkPlan" in executed.getClass().getName() else executed]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "ShuffleExchangeExec":
            found.append(node.output().size())
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return found


@pytest.mark.parametrize("name", ["orders_flagged_reasons", "orders_valid", "clean_orders", "outside_calendar", "mart_monthly_revenue"])
def test_whole_orders_move_at_most_once_to_be_checked(spark, name):
    """Without broadcasts: key columns are looked up on their own, and only the failing ones meet the rows again."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        orders = flag_batch(raw_tables(spark, SF)).orders
        wide = [n for n in exchanges(orders) if n > 6]
        text = plan(orders)
        assert len(wide) == 1 and "BroadcastHashJoin" not in text
        assert "RoundRobinPartitioning" not in text  # no shuffle before the first key
        assert len([n for n in exchanges(queries()[name](spark, SF)) if n > 8]) <= 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_publishing_does_not_compute_the_orders_twice_to_sample_them(spark):
    orders = spark.range(9).selectExpr("cast(id % 2 as int) AS year", "1 AS month", "id")
    text = plan(lake.by_date(orders))
    assert "rangepartitioning" not in text and "REBALANCE" in text


def test_masters_are_scanned_once_for_their_keys(spark):
    text = plan(flag_batch(raw_tables(spark, SF)).orders)
    assert text.count("/customer.parquet") == 1 and text.count("/part.parquet") == 1
    assert text.count("/orders.parquet") <= 3  # whole rows; key columns, whose count is reused where plans allow it


def test_scans_read_only_the_needed_columns(spark, tmp_path):
    schema = warehouse.TABLES["fact_orders"]
    path = str(tmp_path / "fact")
    one_row = spark.range(1).selectExpr(
        *[f"cast({2024 if n == 'year' else 3 if n == 'month' else 'null'} as {t}) as {n}"
          for n, t in (f.strip().split(" ") for f in schema.split(","))])
    one_row.write.partitionBy("year", "month").parquet(path)
    fact = spark.read.schema(schema).parquet(path)
    text = plan(marts.monthly_revenue(fact, warehouse.dim_date(spark)))
    assert "ReadSchema: struct<customer_id:string,date_key:int,total_amount:double>" in text
    one = plan(fact.where("year = 2024 and month = 3").select("order_id"))
    assert "PartitionFilters: [isnotnull(year" in one


def test_nothing_is_broadcast_by_force_in_the_monthly_mart(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert "BroadcastExchange" not in plan(queries()["mart_monthly_revenue"](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
