"""The registered queries: library operators over the shared tables. Dates and lists leave as text."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from dqlake import schemas
from dqlake.operators import contracts, noise, splits
from dqlake.operators.clean import clean_customers, clean_orders, clean_products
from dqlake.operators.enrich import customer_rfm, enrich_customers, enrich_products, rank_products
from dqlake.operators.keyed import ROW_ID, with_row_id
from dqlake.operators.numbering import number_rows
from dqlake.operators.rules import CHECKS, EMAIL_FORMAT, Check, flag_name, flag_rows, joined_reasons, unique
from dqlake.operators.upsert import keep_or_number, replace_by_key
from dqlake.plans import evolution, lake, lineage, marts, months, warehouse
from dqlake.plans.batch import DATASETS, Flagged, flag_batch, stage_batch, valid_keys
from dqlake.plans.gate import evaluate_batch, quarantine_page, read_history, read_quarantine, snapshot
from dqlake.plans.job import replay, run_batch, run_files
from dqlake.plans.layout import Layout
from dqlake.sources.files import NULL_TOKENS, empty_table, read_csv, read_csv_batches, write_csv
from dqlake.sources.staging import shared_folder, stage
from workload.raw import SQL, plain_tables, raw_table, raw_tables, table

RUN = "R1"
AT = datetime(2027, 6, 1, 6, 0, 0)
Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(f: Query) -> Query:
    REGISTRY[f.__name__] = f
    return f


def as_text(df: DataFrame) -> DataFrame:
    """Dates, timestamps and text lists as text, the same in every engine."""
    def one(field: T.StructField):
        c = F.col(field.name)
        if isinstance(field.dataType, T.DateType):
            return F.date_format(c, "yyyy-MM-dd").alias(field.name)
        if isinstance(field.dataType, (T.TimestampNTZType, T.TimestampType)):
            return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(field.name)
        if isinstance(field.dataType, T.ArrayType):
            return F.array_join(c, ",").alias(field.name)
        return c

    return df.select(*[one(f) for f in df.schema])


def literal_time(at: datetime):
    return F.lit(at).cast("timestamp_ntz")


# ---- rules ------------------------------------------------------------------------------------------------------

def _with_flags(rows: DataFrame, checks: list[Check], keep: list[str], parents=None) -> DataFrame:
    """The kept columns and one ``<column>_fails`` per check."""
    flagged = flag_rows(rows, checks, parents)
    return flagged.select(*keep, *[F.col(flag_name(i)).alias(f"{c.column}_fails") for i, c in enumerate(checks)])


@query
def rule_not_null(spark, sf):
    checks = [Check("not_null", c, "") for c in ("customer_id", "email", "name", "loyalty_code")]
    return _with_flags(raw_tables(spark, sf)["customers"], checks, ["customer_id", "email", "name"])


@query
def rule_unique(spark, sf):
    return _with_flags(raw_tables(spark, sf)["orders"], [Check("unique", "order_id", "")], ["order_id", "customer_id"])


@query
def rule_unique_two_columns(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    key = ["l_orderkey", "l_linenumber"]
    return unique(with_row_id(rows), key, "key_fails").drop(ROW_ID)


@query
def rule_large_amounts(spark, sf):
    """Prices of any size are prices; a net amount beyond the money type has a reason of its own."""
    raw = raw_tables(spark, sf)["orders"]
    wild = raw.withColumns({
        "unit_price": F.when(F.col("order_status") == "Pending", F.concat("unit_price", F.lit("e17"))).otherwise(F.col("unit_price")),
        "discount_rate": F.when(F.col("order_status") == "Shipped", F.lit("-1e30")).otherwise(F.col("discount_rate")),
    })
    checks = [CHECKS["orders"][4], CHECKS["orders"][9]]
    return _with_flags(wild, checks, ["order_id", "unit_price", "discount_rate"])


@query
def rule_positive_numeric(spark, sf):
    checks = [CHECKS["orders"][3], CHECKS["orders"][4], Check("positive_numeric", "discount_rate", "", strict=False)]
    return _with_flags(
        raw_tables(spark, sf)["orders"], checks, ["order_id", "quantity", "unit_price", "discount_rate"])


@query
def rule_positive_numeric_products(spark, sf):
    checks = [CHECKS["products"][2], Check("positive_numeric", "in_stock", "", strict=False)]
    return _with_flags(raw_tables(spark, sf)["products"], checks, ["product_id", "unit_price", "in_stock"])


@query
def rule_valid_datetime(spark, sf):
    return _with_flags(raw_tables(spark, sf)["orders"], [CHECKS["orders"][5]], ["order_id", "order_date"])


@query
def rule_referential_integrity(spark, sf):
    raw = raw_tables(spark, sf)
    parents = {
        "customers": valid_keys(flag_rows(raw["customers"], CHECKS["customers"]), "customer_id"),
        "products": valid_keys(flag_rows(raw["products"], CHECKS["products"]), "product_id"),
    }
    return _with_flags(raw["orders"], CHECKS["orders"][6:8], ["order_id", "customer_id", "product_id"], parents)


@query
def rule_allowed_values(spark, sf):
    checks = [CHECKS["orders"][8], Check("allowed_values", "payment_method", "", tuple(schemas.PAYMENT_METHODS))]
    return _with_flags(raw_tables(spark, sf)["orders"], checks, ["order_id", "order_status", "payment_method"])


@query
def rule_email_format(spark, sf):
    return _with_flags(raw_tables(spark, sf)["customers"], [EMAIL_FORMAT], ["customer_id", "email"])


# ---- split, quarantine, score -----------------------------------------------------------------------------------

def _flagged(spark: SparkSession, sf: str) -> Flagged:
    """The batch flagged once and stored; a query derives everything from that."""
    return stage_batch(raw_tables(spark, sf), shared_folder(spark, "flagged"))


def _flagged_one(spark: SparkSession, sf: str, dataset: str) -> DataFrame:
    if dataset == "orders":
        return flag_batch(raw_tables(spark, sf)).orders
    return flag_rows(raw_tables(spark, sf)[dataset], CHECKS[dataset])


def _quarantine(spark: SparkSession, sf: str, dataset: str) -> DataFrame:
    return splits.quarantine_records(_flagged_one(spark, sf, dataset), dataset, RUN, literal_time(AT))


def _register_dataset(dataset: str) -> None:
    columns = schemas.RAW[dataset].fieldNames()

    def flagged_reasons(spark, sf):
        reasons = joined_reasons(CHECKS[dataset]).alias("error_reasons")
        return _flagged_one(spark, sf, dataset).select(*columns, reasons)

    REGISTRY[f"{dataset}_flagged_reasons"] = flagged_reasons
    REGISTRY[f"{dataset}_valid"] = lambda spark, sf: splits.valid_rows(_flagged_one(spark, sf, dataset))
    REGISTRY[f"{dataset}_quarantine"] = lambda spark, sf: as_text(_quarantine(spark, sf, dataset))


for _d in DATASETS:
    _register_dataset(_d)


@query
def quality_metrics(spark, sf):
    return _flagged(spark, sf).metrics().drop("seq")


@query
def gate_score(spark, sf):
    totals = stage(_flagged(spark, sf).all_totals(), "totals")
    return splits.score(totals, 90.0).unionByName(splits.score(totals, 95.0))


@query
def failure_breakdown(spark, sf):
    return splits.failure_breakdown(_flagged(spark, sf).metrics())


@query
def reason_counts(spark, sf):
    flagged = _flagged(spark, sf)
    return reduce(DataFrame.unionByName, [splits.reason_counts(flagged[d], d, CHECKS[d]) for d in DATASETS])


@query
def rate_limits(spark, sf):
    flagged = _flagged(spark, sf)
    return reduce(
        DataFrame.unionByName, [splits.rate_limits(flagged.totals(d), d, CHECKS[d]) for d in DATASETS])


@query
def quarantine_first_page(spark, sf):
    records = stage(_quarantine(spark, sf, "orders"), "quarantine")
    total, page = quarantine_page(records, 25)
    return page.select("quarantine_id", "error_reasons", "order_id", "customer_id",
                       F.lit(total).alias("total_quarantined"))


REGISTRY["quarantine_page"] = REGISTRY.pop("quarantine_first_page")


@query
def quarantine_audit(spark, sf):
    flagged = _flagged(spark, sf)
    parts = [splits.quarantine_audit(splits.quarantine_records(flagged[d], d, RUN, literal_time(AT))) for d in DATASETS]
    records = reduce(DataFrame.unionByName, parts)
    return as_text(number_rows(records, [F.col("dataset"), F.col("quarantine_id")], "quarantine_key", 1))


# ---- cleaning and enrichment ------------------------------------------------------------------------------------

def _clean(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Clean customers, products and orders; the orders are written once, because several steps read them."""
    flagged = _flagged(spark, sf)
    orders = stage(clean_orders(flagged.valid("orders")), "clean_orders")
    return clean_customers(flagged.valid("customers")), clean_products(flagged.valid("products")), orders


def _clean_orders(spark: SparkSession, sf: str) -> DataFrame:
    return clean_orders(splits.valid_rows(_flagged_one(spark, sf, "orders")))


REGISTRY["clean_customers"] = lambda spark, sf: as_text(
    clean_customers(splits.valid_rows(_flagged_one(spark, sf, "customers"))))
REGISTRY["clean_products"] = lambda spark, sf: clean_products(
    splits.valid_rows(_flagged_one(spark, sf, "products")))
REGISTRY["clean_orders"] = lambda spark, sf: as_text(_clean_orders(spark, sf))


REGISTRY["customer_rfm"] = lambda spark, sf: as_text(customer_rfm(_clean(spark, sf)[2]))


def _lake_customers(spark: SparkSession, sf: str) -> DataFrame:
    customers, _, orders = _clean(spark, sf)
    return enrich_customers(customers, orders)


def _lake_products(spark: SparkSession, sf: str) -> DataFrame:
    flagged = _flagged(spark, sf)
    return enrich_products(clean_products(flagged.valid("products")), clean_orders(flagged.valid("orders")))


REGISTRY["enrich_customers"] = lambda spark, sf: as_text(_lake_customers(spark, sf))
REGISTRY["enrich_products"] = _lake_products


@query
def product_revenue_rank(spark, sf):
    return rank_products(_lake_products(spark, sf)).select(
        "product_id", "category", "total_revenue", "revenue_rank", "category_rank")


# ---- star schema ------------------------------------------------------------------------------------------------

def _empty(spark: SparkSession, name: str) -> DataFrame:
    return empty_table(spark, warehouse.TABLES[name])


def _fact(spark: SparkSession, sf: str) -> DataFrame:
    """Facts without the surrogate key, which no mart reads."""
    return _fact_of(_flagged(spark, sf))


def _fact_of(flagged: Flagged) -> DataFrame:
    return warehouse.fact_rows(stage(clean_orders(flagged.valid("orders")), "clean_orders"))


def _keyed_fact(spark: SparkSession, sf: str) -> DataFrame:
    return _fact(spark, sf).withColumn("order_key", warehouse.fact_key())


@query
def dim_date(spark, sf):
    """The calendar over the years the valid orders span."""
    orders = _clean_orders(spark, sf)
    first, last = orders.agg(F.min("year"), F.max("year")).first()
    return as_text(warehouse.dim_date(spark, date(first, 1, 1), date(last, 12, 31)))


@query
def dim_date_to_the_end(spark, sf):
    """The calendar when one order is dated in the last year there is: days per year."""
    first = _clean_orders(spark, sf).agg(F.min("year")).first()[0]
    days = warehouse.dim_date(spark, date(first, 1, 1), date(9999, 12, 31))
    return days.groupBy("year").agg(F.count(F.lit(1)).alias("days"), F.count_if("is_weekend").alias("weekend_days"))


@query
def dim_customers(spark, sf):
    rows = warehouse.customer_rows(_lake_customers(spark, sf))
    return as_text(
        keep_or_number(stage(rows, "rows"), _empty(spark, "dim_customers"), "customer_id", "customer_key", ["customer_id"]))


@query
def dim_products(spark, sf):
    rows = warehouse.product_rows(_lake_products(spark, sf))
    return keep_or_number(
        stage(rows, "rows"), _empty(spark, "dim_products"), "product_id", "product_key", ["product_id"])


@query
def fact_orders(spark, sf):
    return as_text(_keyed_fact(spark, sf).drop("year", "month"))


@query
def star_upsert(spark, sf):
    """Facts before 2026 loaded first, then a batch from July 2025 on with changed status."""
    facts = _fact(spark, sf).drop("year", "month")
    order = ["order_date", "order_id"]
    first = facts.where(F.col("order_date") < literal_time(datetime(2026, 1, 1)))
    day1 = stage(number_rows(first, [F.col(c) for c in order], "order_key", 1), "day1")
    batch = facts.where(F.col("order_date") >= literal_time(datetime(2025, 7, 1)))
    day2 = keep_or_number(
        batch.withColumn("order_status", F.lit("Refunded")), day1, "order_id", "order_key", order)
    return as_text(replace_by_key(day1, stage(day2, "day2"), "order_id"))


@query
def orphan_report(spark, sf):
    """Raw orders against the valid masters: before the gate there are orphans to report."""
    flagged = _flagged(spark, sf)
    return warehouse.orphans(
        raw_table(spark, sf, "orders"), flagged.valid("customers"), flagged.valid("products"))


@query
def outside_calendar(spark, sf):
    return marts.outside_calendar(_fact(spark, sf), warehouse.dim_date(spark))


# ---- marts and KPIs ---------------------------------------------------------------------------------------------

def _monthly(spark: SparkSession, sf: str) -> DataFrame:
    return marts.monthly_revenue(_fact(spark, sf), warehouse.dim_date(spark))


def _products_mart(spark: SparkSession, sf: str) -> DataFrame:
    flagged = _flagged(spark, sf)
    return marts.top_products(clean_products(flagged.valid("products")), _fact_of(flagged))


def _audit(flagged: Flagged) -> DataFrame:
    """The checks of two runs a day apart."""
    checks = stage(flagged.metrics(), "metrics")
    runs = [
        checks.withColumns({"run_id": F.lit(run), "evaluated_at": literal_time(datetime(2027, 6, day, 6))})
        for run, day in (("run-a", 1), ("run-b", 2))
    ]
    both = runs[0].unionByName(runs[1]).drop("threshold", "details")
    return number_rows(both, [F.col("run_id"), F.col("seq")], "audit_id", 1).drop("seq")


REGISTRY["mart_monthly_revenue"] = _monthly


@query
def query_mart_newest_months(spark, sf):
    _monthly(spark, sf).createOrReplaceTempView("v_mart_monthly_revenue")
    return marts.query_mart(spark, "monthly_revenue", 10)


@query
def mart_monthly_chart(spark, sf):
    """The monthly mart with its place in calendar order; a row per month."""
    chart = marts.monthly_chart(stage(_monthly(spark, sf), "monthly"))
    return number_rows(chart, [F.col("year"), F.col("month")], "place", 1).select("place", "year", "month", "total_orders", "total_revenue")


REGISTRY["mart_top_products"] = lambda spark, sf: marts.best_products(_products_mart(spark, sf))
REGISTRY["mart_product_performance"] = _products_mart
REGISTRY["top5_products"] = lambda spark, sf: marts.best_products(_products_mart(spark, sf), 5).select(
    "product_name", "gross_revenue")
REGISTRY["mart_customer_retention"] = lambda spark, sf: marts.customer_retention(_lake_customers(spark, sf))
REGISTRY["segment_spend"] = lambda spark, sf: marts.segment_spend(
    marts.customer_retention(_lake_customers(spark, sf)))
REGISTRY["mart_quality_trends"] = lambda spark, sf: as_text(
    marts.recent_trends(marts.quality_trends(_audit(_flagged(spark, sf)))))
REGISTRY["recent_quality_checks"] = lambda spark, sf: as_text(marts.recent_checks(_audit(_flagged(spark, sf)), 20))


@query
def executive_summary(spark, sf):
    flagged = _flagged(spark, sf)
    return marts.executive_summary(_fact_of(flagged), _audit(flagged))


@query
def entity_customers(spark, sf):
    rows = warehouse.customers(_lake_customers(spark, sf), active=True)
    return rows.select("customer_id", "name", "country", "segment", "customer_tier")


@query
def entity_products(spark, sf):
    rows = warehouse.products(_lake_products(spark, sf), category="Economy")
    return rows.select("product_id", "product_name", "category", "unit_price", "total_revenue")


@query
def entity_orders(spark, sf):
    return as_text(warehouse.orders(_keyed_fact(spark, sf), status="Completed").drop("year", "month"))


# ---- contracts, drift, lineage, noise ---------------------------------------------------------------------------

def _contract(spark: SparkSession, sf: str, dataset: str, keep: list[str]) -> DataFrame:
    checked = contracts.check_contract(raw_tables(spark, sf)[dataset], dataset)
    return checked.withColumn("violations", F.array_join("violations", " | ")).select(*keep)


REGISTRY["contract_customers"] = lambda spark, sf: _contract(
    spark, sf, "customers", ["customer_id", "email", "violations", "active"])
REGISTRY["contract_products"] = lambda spark, sf: _contract(
    spark, sf, "products", ["product_id", "unit_price", "violations", "profit_margin"])
REGISTRY["contract_orders"] = lambda spark, sf: _contract(
    spark, sf, "orders", ["order_id", "customer_id", "violations", "year", "month", "day"])
REGISTRY["contract_country"] = lambda spark, sf: _contract(
    spark, sf, "customers", ["customer_id", "country", "standard_country"])


@query
def schema_drift(spark, sf):
    """Four order batches as CSV folders, judged file by file; one row per batch and verdict."""
    orders = plain_tables(spark, sf)["orders"]
    folder = shared_folder(spark, "incoming")
    batches = {
        "exact": orders,
        "extended": orders.withColumn("coupon_code", F.concat(F.lit("C-"), "order_status")),
        "reduced": orders.drop("payment_method"),
        "broken": orders.drop("customer_id"),
    }
    for name, batch in batches.items():
        write_csv(batch, f"{folder}/{name}")
    report = evolution.file_drift(spark, folder, "orders")
    batch = F.element_at(F.split("path", "/"), -2).alias("batch")
    return as_text(report.select(
        batch, "dataset", "verdict", "action", "added_columns", "removed_columns", "missing_required_columns")).distinct()


@query
def compatible_extension_union(spark, sf):
    """A folder of two CSV batches, one with an added column, read as one table."""
    orders = plain_tables(spark, sf)["orders"]
    folder = shared_folder(spark, "extended")
    write_csv(orders.where("payment_method <> 'UPI'"), f"{folder}/old")
    extended = orders.where("payment_method = 'UPI'").withColumn("coupon_code", F.concat(F.lit("C-"), "order_status"))
    write_csv(extended, f"{folder}/new")
    return read_csv_batches(spark, folder)


def _edges(spark: SparkSession, sf: str) -> DataFrame:
    return lineage.edges(spark).unionByName(lineage.order_flow(_clean_orders(spark, sf)))


@query
def lineage_upstream(spark, sf):
    return lineage.trace_upstream(_edges(spark, sf), "bi_executive_kpis")


@query
def lineage_edges(spark, sf):
    edges = stage(_edges(spark, sf), "edges")
    return lineage.edges_within(edges, lineage.trace_upstream(edges, "v_mart_monthly_revenue"))


@query
def noise_injection(spark, sf):
    raw_tables(spark, sf)
    text = SQL["orders"].replace("o_orderkey % 160 AS m", "CASE WHEN o_orderkey % 160 >= 8 THEN o_orderkey % 160 END AS m")
    text = text.replace("SELECT 'ORD-'", "SELECT o_orderkey, 'ORD-'").replace("FROM orders", "FROM {src}")
    clean = spark.sql(text, src=table(spark, sf, "orders"))
    key = F.col("o_orderkey")
    other = F.concat(F.lit("ORD-"), F.lpad((key + 10).cast("string"), 7, "0"))
    return noise.inject_orders(clean, key, other).select(
        "order_id", "customer_id", "quantity", "unit_price", "order_date", "order_status", "fault")


# ---- files and whole runs ---------------------------------------------------------------------------------------

@query
def csv_null_tokens(spark, sf):
    """Raw orders written with every spelling of null and read back."""
    orders = plain_tables(spark, sf)["orders"]
    tokens = F.array(*[F.lit(t) for t in NULL_TOKENS])
    spelled = F.element_at(tokens, (F.pmod(F.xxhash64("order_id"), F.lit(len(NULL_TOKENS))) + 1).cast("int"))
    path = shared_folder(spark, "csv")
    write_csv(orders.select(*[F.coalesce(c, spelled).alias(c) for c in orders.columns]), path)
    return read_csv(spark, path)


def _published(spark: SparkSession, sf: str) -> tuple[Layout, DataFrame]:
    layout = Layout(shared_folder(spark, "lake"))
    result = evaluate_batch(snapshot(plain_tables(spark, sf), layout, RUN), layout, RUN, 90.0, AT)
    return layout, lake.publish_if_passed(result, layout, RUN, at=AT)


@query
def lake_round_trip(spark, sf):
    layout, _ = _published(spark, sf)
    facts = spark.read.parquet(layout.lake("fact_orders"))
    return facts.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum(F.col("total_amount").cast("decimal(28,2)")).cast("double").alias("revenue"),
    )


@query
def lake_manifest(spark, sf):
    _, manifest = _published(spark, sf)
    return manifest.select("run_id", "records_processed.*", "partitions_created").select(
        "run_id", "customers", "products", "orders", "partitions_created")


@query
def audit_load_idempotent(spark, sf):
    """Two runs' reports loaded into the audit, then loaded once more."""
    layout = Layout(shared_folder(spark, "audit"))
    raw = snapshot(plain_tables(spark, sf), layout, "run-a")
    for run in ("run-a", "run-b"):
        evaluate_batch(raw, layout, run, 90.0, AT)
    for _ in range(2):
        warehouse.load_audit(spark, layout, literal_time(AT))
    return warehouse.read_table(spark, layout, "data_quality_audit").drop("evaluated_at")


@query
def replay_run(spark, sf):
    """A run blocked at 95, replayed from its snapshot at 90."""
    root = shared_folder(spark, "replay")
    first = run_batch(plain_tables(spark, sf), root, "run-1", 95.0, AT)
    second = replay(spark, root, "run-2", source_run="run-1", threshold=90.0, at=AT)
    rows = [
        (name, r["status"], r["quality_score"], r["orders_processed"], r["partitions_created"],
         r["load_stats"] and r["load_stats"]["orders_loaded"])
        for name, r in (("first", first), ("replay", second))
    ]
    return spark.createDataFrame(
        rows, "attempt string, status string, quality_score double, orders_processed long, partitions_created long, "
              "orders_loaded long")


@query
def csv_mixed_headers(spark, sf):
    """Orders in four CSV folders whose columns differ, through the whole job; valid and quarantined rows read back."""
    raw = plain_tables(spark, sf)
    root, incoming = shared_folder(spark, "mixed"), shared_folder(spark, "incoming")
    orders, status = raw["orders"], F.col("order_status")
    rest = ~status.isin("Completed", "Pending", "Cancelled")
    write_csv(orders.where(status == "Completed"), f"{incoming}/orders/exact")
    write_csv(orders.where(status == "Pending").select(*orders.columns[::-1]), f"{incoming}/orders/swapped")
    write_csv(orders.where(status == "Cancelled").drop("payment_method"), f"{incoming}/orders/reduced")
    write_csv(orders.where(rest).withColumn("coupon_code", F.concat(F.lit("C-"), status)), f"{incoming}/orders/extended")
    for d in ("customers", "products"):
        write_csv(raw[d], f"{incoming}/{d}")
    run_files(spark, {d: f"{incoming}/{d}" for d in DATASETS}, root, RUN, 0.0, AT)
    layout = Layout(root)
    columns = ["order_id", "customer_id", "quantity", "order_date", "payment_method", "coupon_code"]
    valid = splits.valid_rows(spark.read.parquet(f"{layout.flagged(RUN)}/orders")).select(*columns, F.lit(None).cast("string").alias("error_reasons"))
    return valid.unionByName(read_quarantine(spark, layout, "orders", RUN).select(*columns, "error_reasons"))


@query
def raw_history(spark, sf):
    """Three runs whose orders have other added columns, read as one table."""
    orders, root = plain_tables(spark, sf)["orders"], shared_folder(spark, "history")
    layout, rest = Layout(root), plain_tables(spark, sf)
    status = F.col("order_status")
    runs = [
        orders.where(status == "Completed"),
        orders.where(status == "Pending").withColumn("coupon", F.concat(F.lit("C-"), "payment_method")),
        orders.where(status == "Shipped").withColumn("channel", F.lit("web")).drop("payment_method"),
    ]
    for n, rows in enumerate(runs):
        snapshot({**rest, "orders": rows}, layout, f"run-{n}")
    return read_history(spark, layout, "orders").select("run_id", "order_id", "order_status", "payment_method", "coupon", "channel")


@query
def csv_line_breaks(spark, sf):
    """Orders with a note of several lines, in CSV folders whose columns differ, through the whole job."""
    raw = plain_tables(spark, sf)
    root, incoming = shared_folder(spark, "breaks"), shared_folder(spark, "incoming")
    note = F.concat(F.lit('status "'), "order_status", F.lit('",\n\nby '), "payment_method", F.lit("\n"))
    orders, done = raw["orders"].withColumn("note", note), F.col("order_status") == "Completed"
    write_csv(orders.where(done), f"{incoming}/orders/first")
    write_csv(orders.where(~done).select(*orders.columns[::-1]), f"{incoming}/orders/swapped")
    write_csv(raw["orders"].where(F.col("order_status").isNull()), f"{incoming}/orders/plain")
    for d in ("customers", "products"):
        write_csv(raw[d], f"{incoming}/{d}")
    run_files(spark, {d: f"{incoming}/{d}" for d in DATASETS}, root, RUN, 0.0, AT)
    columns = ["order_id", "customer_id", "quantity", "order_date", "note"]
    valid = splits.valid_rows(spark.read.parquet(f"{Layout(root).flagged(RUN)}/orders")).select(*columns, F.lit(None).cast("string").alias("error_reasons"))
    return valid.unionByName(read_quarantine(spark, Layout(root), "orders", RUN).select(*columns, "error_reasons"))


@query
def csv_documents(spark, sf):
    """Whole documents, line breaks and quotes included, written as CSV with two headers and read back."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), "lang", "source", "text")
    path, english = shared_folder(spark, "documents"), F.coalesce(F.col("lang") == "en", F.lit(False))
    write_csv(docs.where(english), f"{path}/english")
    write_csv(docs.where(~english).select("text", "doc_id", "lang"), f"{path}/others")
    return read_csv(spark, path).select("doc_id", "lang", "source", "text")


@query
def replay_mended_rows(spark, sf):
    """A run, then the same run again with unknown statuses mended: quarantine audit by reasons."""
    raw = plain_tables(spark, sf)
    root = shared_folder(spark, "mended")
    run_batch(raw, root, "run-1", 0.0, AT)
    status = F.when(F.col("order_status") == "UNKNOWN_ERROR_STATUS", F.lit("Completed")).otherwise(F.col("order_status"))
    replay(spark, root, "run-1", raw={**raw, "orders": raw["orders"].withColumn("order_status", status)}, threshold=0.0, at=AT)
    audit = warehouse.read_table(spark, Layout(root), "quarantine_audit")
    return audit.groupBy("run_id", "dataset", "error_reasons").agg(
        F.count(F.lit(1)).alias("records"), F.count_distinct("quarantine_key").alias("audit_keys"))


def _two_loads(spark: SparkSession, sf: str, between: Callable[[Layout], None] = lambda layout: None) -> Layout:
    """Two lakes through the loader: orders before 2026, then those from July 2025 on with a new status."""
    flagged = _flagged(spark, sf)
    layout = Layout(shared_folder(spark, "two-runs"))
    orders = stage(clean_orders(flagged.valid("orders")), "clean_orders")
    enrich_customers(clean_customers(flagged.valid("customers")), orders).write.parquet(layout.lake("dim_customers"))
    enrich_products(clean_products(flagged.valid("products")), orders).write.parquet(layout.lake("dim_products"))
    at = F.col("order_date")
    first = orders.where(at < literal_time(datetime(2026, 1, 1)))
    second = orders.where(at >= literal_time(datetime(2025, 7, 1))).withColumn("order_status", F.lit("Refunded"))
    for run, batch in (("run-1", first), ("run-2", second)):
        batch.write.mode("overwrite").partitionBy("year", "month").parquet(layout.lake("fact_orders"))
        warehouse.load(spark, layout, run, AT)
        between(layout)
    return layout


@query
def star_load_two_runs(spark, sf):
    """The facts read back after two loads."""
    layout = _two_loads(spark, sf)
    return as_text(warehouse.read_table(spark, layout, "fact_orders").drop("loaded_at", "year", "month"))


@query
def mart_months_refreshed(spark, sf):
    """The monthly mart from what is kept by month, brought up after each of two loads."""
    layout = _two_loads(spark, sf, lambda layout: months.refresh(spark, layout))
    return months.monthly_revenue(months.refresh(spark, layout), warehouse.dim_date(spark))


@query
def buyers_by_year(spark, sf):
    """Years and the whole (year null) merged from kept months: orders, distinct customers, revenue."""
    kept = months.refresh(spark, _two_loads(spark, sf))
    whole = months.totals_by(kept, []).withColumn("year", F.lit(None).cast("int"))
    return months.totals_by(kept, ["year"]).unionByName(whole)


@query
def retention_by_key(spark, sf):
    """The retention mart over the numbered customer dimension."""
    rows = stage(warehouse.customer_rows(_lake_customers(spark, sf)), "customer_rows")
    return months.customer_retention(stage(number_rows(rows, [F.col("customer_id")], "customer_key", 1), "numbered"))


@query
def lineage_of_run(spark, sf):
    """What the customer dimension of a real run is made from, by the edges that publish and load recorded."""
    layout, _ = _published(spark, sf)
    warehouse.load(spark, layout, RUN, AT)
    reached = lineage.trace_upstream(lineage.recorded(spark, layout), "dw_dim_customers")
    return reached.join(lineage.nodes(spark).select("name", "tier"), "name")


def queries() -> dict[str, Query]:
    return dict(REGISTRY)
