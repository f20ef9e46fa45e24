"""The star schema: calendar, dimensions and facts kept by key, quality and quarantine audits.

Dimensions are written as new snapshots; a load log names the current one, so a reader never sees a half-written
table. Facts lie by year and month; a load writes the months it touches anew, beside the old ones, and then names them, so a load
that fails leaves the facts as they were. Audits lie by run.
"""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from dqlake import schemas
from dqlake.functions import date_key, strip
from dqlake.operators.numbering import number_rows
from dqlake.operators.splits import quarantine_audit
from dqlake.operators.upsert import first_per_key, keep_or_number, replace_by_key
from dqlake.plans import lineage
from dqlake.plans.batch import DATASETS
from dqlake.plans.gate import as_column, read_quarantine
from dqlake.plans.lake import PARTITION, by_date
from dqlake.plans.layout import Layout
from dqlake.sources.files import (
    empty_table, read_documents, read_if_there, read_parquet, remove, write_parquet,
)
from dqlake.sources.staging import stage

TABLES = {
    "dim_customers": schemas.DIM_CUSTOMERS,
    "dim_products": schemas.DIM_PRODUCTS,
    "fact_orders": schemas.FACT_ORDERS,
    "data_quality_audit": schemas.AUDIT,
    "quarantine_audit": schemas.QUARANTINE_AUDIT,
}
LOADED = [("lake_fact_orders", "dw_fact_orders"), ("lake_dim_customers", "dw_dim_customers"), ("lake_dim_products", "dw_dim_products")]
SNAPSHOTS = ("dim_customers", "dim_products")
LOAD_LOG = "table string, load_id int, path string, run_id string, records bigint, renewed boolean"  # renewed: by a full refresh
FACT_MONTHS = "year int, month int, load_id int, path string, run_id string"  # no path: the month holds no order any more
MONTHS_SENT = 10_000  # months that a load may broadcast; more meet in a shuffle
CALENDAR = (date(2023, 1, 1), date(2027, 12, 31))


# ---- the rows of each table -------------------------------------------------------------------------------------

def dim_date(spark: SparkSession, first: date = CALENDAR[0], last: date = CALENDAR[1]) -> DataFrame:
    """One row per day, both ends included."""
    count = (last - first).days + 1
    days = spark.range(max(0, count)).select(F.date_add(F.lit(first.isoformat()).cast("date"), F.col("id").cast("int")).alias("full_date"))
    d = F.col("full_date")
    return days.select(
        date_key(d).alias("date_key"),
        "full_date",
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day"),
        F.weekday(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        (F.weekday(d) >= 5).alias("is_weekend"),
    )


def customer_rows(lake: DataFrame) -> DataFrame:
    """Defaults for required columns, no row without an id."""
    filled = lake.withColumns({
        "customer_id": strip(F.col("customer_id")),
        "name": F.coalesce(strip(F.col("name")), F.lit("Unknown")),
        "email": F.coalesce(strip(F.col("email")), F.lit("")),
        "country": F.coalesce(strip(F.col("country")), F.lit("Other")),
        "segment": F.coalesce(strip(F.col("segment")), F.lit("Consumer")),
        "customer_tier": F.coalesce("customer_tier", F.lit("Bronze")),
        "total_spend": F.coalesce("total_spend", F.lit(0.0)),
        "total_orders": F.coalesce("total_orders", F.lit(0)),
        "avg_order_value": F.coalesce("avg_order_value", F.lit(0.0)),
    }).where(F.length("customer_id") > 0)
    rows = filled.select(
        "customer_id", "name", "email", "country", "segment", "signup_date", "is_active", "customer_tier",
        "total_spend", "total_orders", "avg_order_value",
    )
    return rows


def product_rows(lake: DataFrame) -> DataFrame:
    rows = lake.select(
        "product_id", "sku", "product_name", "category", "unit_price", "cost_price",
        F.coalesce("profit_margin_pct", F.lit(0.0)).alias("profit_margin_pct"),
        F.coalesce("in_stock", F.lit(0)).alias("in_stock"),
        F.coalesce("total_units_sold", F.lit(0)).cast("bigint").alias("total_units_sold"),
        F.coalesce("total_revenue", F.lit(0.0)).alias("total_revenue"),
    )
    return rows


def fact_rows(clean: DataFrame) -> DataFrame:
    """First row per order with its calendar key. ``clean`` is a stored table."""
    first = first_per_key(clean, "order_id", ["order_date", "customer_id", "product_id"])
    return first.select(
        "order_id", "customer_id", "product_id", date_key(F.col("order_date")).alias("date_key"), "order_date",
        "quantity", "unit_price", "discount_rate", "total_amount", "order_status", "payment_method",
        F.year("order_date").alias("year"), F.month("order_date").alias("month"),
    )


def audit_rows(reports: DataFrame, loaded: DataFrame, evaluated_at) -> DataFrame:
    """One row per check of every report whose run is not loaded yet."""
    fresh = reports.join(loaded.select("run_id").distinct(), "run_id", "left_anti")
    checks = fresh.select("run_id", F.posexplode("metrics").alias("seq", "m"))
    names = ["check_name", "dataset", "status", "records_checked", "records_passed", "records_failed", "pass_rate"]
    return checks.select("run_id", "seq", *[F.col(f"m.{n}").alias(n) for n in names],
                         evaluated_at.alias("evaluated_at"))


def orphans(fact: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Fact keys without a dimension row, with their order counts. Facts are counted per key before the join."""
    def missing(column: str, dim: DataFrame) -> DataFrame:
        per_key = fact.groupBy(column).agg(F.count(F.lit(1)).alias("orders"))
        return per_key.join(dim.select(column), column, "left_anti").select(
            F.lit(column).alias("key_column"), F.col(column).alias("key_value"), "orders"
        )

    return missing("customer_id", customers).unionByName(missing("product_id", products))


# ---- stored tables ----------------------------------------------------------------------------------------------

def _load_log(spark: SparkSession, layout: Layout) -> DataFrame:
    return read_if_there(spark, layout.warehouse("load_log"), LOAD_LOG)


def _current(spark: SparkSession, layout: Layout, table: str):
    """Load id and path of the table's current snapshot; one log row comes to the driver."""
    row = (
        _load_log(spark, layout).where(F.col("table") == table)
        .orderBy(F.col("load_id").desc()).limit(1).collect()
    )
    return row[0] if row else None


def keys_of(spark: SparkSession, layout: Layout) -> int:
    """The full refresh that the customer keys date from: they only become more until the next one."""
    log = _load_log(spark, layout).where((F.col("table") == "dim_customers") & F.col("renewed"))
    return log.agg(F.coalesce(F.max("load_id"), F.lit(0))).first()[0]


def read_table(spark: SparkSession, layout: Layout, table: str) -> DataFrame:
    """The current rows; empty before the first load. ``dim_date`` is computed."""
    if table == "dim_date":
        return dim_date(spark)
    if table == "fact_orders":
        return facts_of(spark, layout, fact_months(spark, layout))
    if table not in SNAPSHOTS:
        return read_if_there(spark, layout.warehouse(table), TABLES[table])
    return _at(spark, table, _current(spark, layout, table))


def _at(spark: SparkSession, table: str, snapshot) -> DataFrame:
    if snapshot is None:
        return empty_table(spark, TABLES[table])
    return spark.read.schema(TABLES[table]).parquet(snapshot["path"])


def _typed(df: DataFrame, table: str) -> DataFrame:
    fields = [f.strip().split(" ") for f in TABLES[table].split(",")]
    return df.select(*[F.col(n).cast(t).alias(n) for n, t in fields])


def _load_dimension(
    spark: SparkSession, layout: Layout, table: str, rows: DataFrame, key: str, surrogate: str, run_id: str, at,
    full_refresh: bool,
) -> int:
    """Write the merged dimension as a new snapshot, then name it in the load log."""
    current = _current(spark, layout, table)
    target = _at(spark, table, current)
    keyed = keep_or_number(rows, target, key, surrogate, [key]).withColumn("created_at", at)
    merged = keyed if full_refresh else replace_by_key(target.select(*keyed.columns), keyed, key)
    load_id = 1 if current is None else current["load_id"] + 1
    path = f"{layout.warehouse(table)}/load={load_id}"
    write_parquet(_typed(merged, table), path)
    entry = _at(spark, table, {"path": path}).agg(F.count(F.lit(1)).alias("records")).select(
        F.lit(table).alias("table"), F.lit(load_id).alias("load_id"), F.lit(path).alias("path"),
        F.lit(run_id).alias("run_id"), "records", F.lit(full_refresh).alias("renewed"))
    entry.write.mode("append").parquet(layout.warehouse("load_log"))
    return rows.count()


def _named_months(spark: SparkSession, layout: Layout) -> DataFrame:
    return read_if_there(spark, f"{layout.warehouse('fact_orders')}_months", FACT_MONTHS)


def _last_load(spark: SparkSession, layout: Layout) -> int:
    """Of all loads so far, those included that left no order in any month."""
    return _named_months(spark, layout).agg(F.coalesce(F.max("load_id"), F.lit(0))).first()[0]


def fact_months(spark: SparkSession, layout: Layout) -> list[Row]:
    """(year, month, load_id, path) of the months that hold facts now; one row a month comes to the driver."""
    last = _named_months(spark, layout).groupBy(*PARTITION).agg(F.max(F.struct("load_id", "path")).alias("last"))
    return last.select(*PARTITION, "last.load_id", "last.path").where("path IS NOT NULL").collect()


def facts_of(spark: SparkSession, layout: Layout, months: list[Row]) -> DataFrame:
    """The facts of some of ``fact_months``; no file of another month is read."""
    if not months:
        return empty_table(spark, TABLES["fact_orders"])
    reader = spark.read.schema(TABLES["fact_orders"] + ", load int").option("basePath", layout.warehouse("fact_orders"))
    return reader.parquet(*sorted(m["path"] for m in months)).drop("load")


def _publish_months(spark: SparkSession, layout: Layout, months: DataFrame, emptied: DataFrame, load_id: int, run_id: str) -> None:
    """Name the months of a finished write, all in one file: before it is there readers see the old ones, after it the new."""
    folder = f"{layout.warehouse('fact_orders')}/load={load_id}"
    path = F.concat(F.lit(f"{folder}/year="), F.col("year").cast("string"), F.lit("/month="), F.col("month").cast("string"))
    rows = months.select(*PARTITION, path.alias("path")).unionByName(emptied.select(*PARTITION, F.lit(None).cast("string").alias("path")))
    named = rows.select("year", "month", F.lit(load_id).alias("load_id"), "path", F.lit(run_id).alias("run_id"))
    named.coalesce(1).write.mode("append").parquet(f"{layout.warehouse('fact_orders')}_months")


def _check_keys(pairs: DataFrame) -> None:
    """Stop when two orders (one, other) share a key: a hash of 60 bits makes that unlikely, not impossible."""
    shared = pairs.where("one <> other").limit(1).collect()
    if shared:
        raise ValueError(f"orders {shared[0]['one']!r} and {shared[0]['other']!r} have the same key")


def _batch_keys(batch: DataFrame) -> DataFrame:
    """Of the keys that occur more than once in a batch: the first and last order. Keys alone are counted."""
    twice = batch.groupBy("order_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("order_key")
    both = batch.select("order_key", "order_id").join(twice, "order_key", "left_semi")
    return both.groupBy("order_key").agg(F.min("order_id").alias("one"), F.max("order_id").alias("other"))


def _load_facts(spark: SparkSession, layout: Layout, run_id: str, at, full_refresh: bool) -> int:
    """Replace the batch's orders. Months that hold or held one of them are written anew, the others stay as they are.

    The key of a fact is a hash of its order id, so no row of the history is read to number the batch. One join finds the
    held orders by key; what they need later is their months. Nothing that readers see is changed before all is written.
    """
    current = fact_months(spark, layout)
    load_id = 1 + _last_load(spark, layout)
    path = f"{layout.warehouse('fact_orders')}/load={load_id}"
    batch = fact_rows(read_parquet(spark, layout.lake("fact_orders"))).withColumns({"order_key": fact_key(), "loaded_at": at})
    keyed = stage(_typed(batch, "fact_orders"), "fact_batch")
    target = facts_of(spark, layout, current)
    old_months = spark.createDataFrame([(m["year"], m["month"]) for m in current], "year int, month int")
    _check_keys(_batch_keys(keyed))
    if full_refresh or not current:
        months, rewritten = stage(old_months.union(keyed.select(*PARTITION)).distinct(), "fact_months"), keyed
    else:
        new = keyed.select("order_key", F.col("order_id").alias("new_id"))
        held = stage(target.select("order_key", "order_id", *PARTITION).join(new, "order_key"), "fact_held")
        _check_keys(held.select(F.least("order_id", "new_id").alias("one"), F.greatest("order_id", "new_id").alias("other")))
        months = stage(held.select(*PARTITION).union(keyed.select(*PARTITION)).distinct(), "fact_months")
        touched = target.join(F.broadcast(months) if months.count() <= MONTHS_SENT else months, PARTITION, "left_semi")
        rewritten = replace_by_key(touched.select(*keyed.columns), keyed, "order_id")
    write_parquet(by_date(rewritten), path, PARTITION)
    written = read_if_there(spark, path, TABLES["fact_orders"]).select(*PARTITION).distinct()
    _publish_months(spark, layout, written, months.join(written, PARTITION, "left_anti"), load_id, run_id)
    return keyed.count()


def fact_key() -> Column:
    """The key of a fact: 60 bits of the MD5 of its order id, the same in every load and engine."""
    return hash_key(F.col("order_id"))


def hash_key(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def load_audit(spark: SparkSession, layout: Layout, at) -> int:
    """Add the checks of runs not loaded yet; the table lies by run and older runs are not touched."""
    target = read_table(spark, layout, "data_quality_audit")
    fresh = audit_rows(read_documents(spark, layout.reports, schemas.REPORT), target, at)
    [last] = target.agg(F.coalesce(F.max("audit_id"), F.lit(0))).first()
    numbered = number_rows(fresh, [F.col("run_id"), F.col("seq")], "audit_id", last + 1)
    rows = _typed(numbered, "data_quality_audit")
    write_parquet(rows, layout.warehouse("data_quality_audit"), ["run_id"], touched_only=True)
    return rows.count()


def load_quarantine(spark: SparkSession, layout: Layout, run_id: str) -> int:
    """Put the run's quarantine records in the audit table, in place of any it held of this run."""
    parts = [quarantine_audit(read_quarantine(spark, layout, d, run_id)) for d in DATASETS]
    records = reduce(DataFrame.unionByName, parts)
    rows = stage(_typed(records.withColumn("quarantine_key", quarantine_key()), "quarantine_audit"), "quarantine_rows")
    write_parquet(rows, layout.warehouse("quarantine_audit"), ["run_id"], touched_only=True)
    loaded = rows.count()
    if not loaded:  # dynamic overwrite leaves the folder of a run without records
        remove(spark, f"{layout.warehouse('quarantine_audit')}/run_id={run_id}")
    return loaded


def quarantine_key() -> Column:
    """The key of a quarantine record; its id names run, dataset and place, so a reload keeps it."""
    return hash_key(F.col("quarantine_id"))


def load(
    spark: SparkSession, layout: Layout, run_id: str, at: datetime | None = None, full_refresh: bool = False
) -> dict[str, int]:
    """Load the published lake and all reports not loaded yet. Loading twice gives the same tables.

    Writes the report of fact keys without a dimension row below ``orphans`` and the lineage of what it wrote.
    """
    stamp = as_column(at)
    customers = first_per_key(
        customer_rows(read_parquet(spark, layout.lake("dim_customers"))), "customer_id", ["signup_date", "email"])
    products = first_per_key(
        product_rows(read_parquet(spark, layout.lake("dim_products"))), "product_id", ["sku", "product_name"])
    stats = {
        "customers_loaded": _load_dimension(
            spark, layout, "dim_customers", customers, "customer_id", "customer_key", run_id, stamp, full_refresh),
        "products_loaded": _load_dimension(
            spark, layout, "dim_products", products, "product_id", "product_key", run_id, stamp, full_refresh),
        "orders_loaded": _load_facts(spark, layout, run_id, stamp, full_refresh),
        "audit_records_loaded": load_audit(spark, layout, stamp),
        "quarantine_records_loaded": load_quarantine(spark, layout, run_id),
    }
    report = orphans(*(read_table(spark, layout, t) for t in ("fact_orders", "dim_customers", "dim_products")))
    write_parquet(report, layout.warehouse(f"orphans/run_id={run_id}"))
    lineage.record(spark, layout, run_id, "load", LOADED)
    return stats


def star(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    return {t: read_table(spark, layout, t) for t in [*TABLES, "dim_date"]}


# ---- entity reads -----------------------------------------------------------------------------------------------

def customers(dim: DataFrame, active: bool | None = None) -> DataFrame:
    return dim if active is None else dim.where(F.col("is_active") == active)


def products(dim: DataFrame, category: str | None = None) -> DataFrame:
    return dim if category is None else dim.where(F.col("category") == category)


def orders(fact: DataFrame, status: str | None = None) -> DataFrame:
    return fact if status is None else fact.where(F.col("order_status") == status)
