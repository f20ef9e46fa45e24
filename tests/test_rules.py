from collections import Counter

import pytest
from pyspark.sql import functions as F

from dqlake.operators import splits
from dqlake.operators.keyed import ROW_ID
from dqlake.operators.rules import (
    CHECKS, EMAIL_FORMAT, Check, any_failed, flag_name, flag_rows, joined_reasons, reasons,
)
from dqlake.plans.batch import flag_batch
from dqlake.sources.staging import stage

ORDER = "order_id customer_id product_id quantity unit_price discount_rate total_amount order_date order_status payment_method"


def failing(flagged, key, i):
    return {r[0] for r in flagged.where(flag_name(i)).select(key).collect()}


def test_four_row_frame(table):
    rows = table("row order_id quantity price date", [
        ("0", "ORD-1", "5", "100.0", "2024-01-01"),
        ("1", "ORD-2", "-3", "50.0", "2024-02-01"),
        ("2", "ORD-2", "10", "-20.0", "invalid-date"),
        ("3", "", "0", "30.0", "2024-04-01"),
    ])
    flagged = flag_rows(rows, [
        Check("not_null", "order_id", "a"), Check("unique", "order_id", "b"),
        Check("positive_numeric", "quantity", "c"), Check("valid_datetime", "date", "d"),
        Check("positive_numeric", "price", "e"),
    ])
    assert [failing(flagged, "row", i) for i in range(5)] == [{"3"}, {"1", "2"}, {"1", "3"}, {"2"}, {"2"}]


def test_not_null_words_and_blanks(table):
    rows = table("v", [(t,) for t in ["x", "", "  ", "\t\n", "nan", "NaN", " NULL ", "none", None]])
    flagged = flag_rows(rows, [Check("not_null", "v", "")])
    assert failing(flagged, "v", 0) == {"", "  ", "\t\n", "nan", "NaN", " NULL ", None}


def test_unique_compares_untrimmed_and_skips_nulls(table):
    rows = table("v", [("a",), ("a",), (" a",), ("",), ("",), (None,), (None,), ("b",)])
    flagged = flag_rows(rows, [Check("unique", "v", "")])
    assert failing(flagged, "v", 0) == {"a", ""}


def test_numbers_that_the_column_cannot_hold_fail(table):
    rows = table("v", [("1",), ("0",), ("0.5",), ("5d",), ("inf",), ("1e999",), ("3000000000",), ("NaN",), (None,)])
    flagged = flag_rows(rows, [Check("positive_numeric", "v", "", most=2147483647)])
    assert failing(flagged, "v", 0) == {"0", "5d", "inf", "1e999", "3000000000", "NaN", None}
    loose = flag_rows(table("v", [("0",), ("-1",)]), [Check("positive_numeric", "v", "", strict=False)])
    assert failing(loose, "v", 0) == {"-1"}


def test_allowed_values_are_exact(table):
    rows = table("s", [("Completed",), ("completed",), ("Completed ",), (None,)])
    flagged = flag_rows(rows, [Check("allowed_values", "s", "", allowed=("Completed",))])
    assert failing(flagged, "s", 0) == {"completed", "Completed ", None}


def test_a_missing_column_fails_every_row(table):
    rows = table("a", [("x",), ("y",)])
    kinds = ["not_null", "unique", "positive_numeric", "valid_datetime", "referential_integrity", "allowed_values"]
    checks = [Check(k, "gone", "", parent="p") for k in kinds]
    flagged = flag_rows(rows, checks)
    assert flagged.where(any_failed(len(checks))).count() == 2
    total = splits.totals(flagged, "d", checks)
    texts = [r["details"] for r in splits.metrics(total, checks, rows.columns).collect()]
    assert texts[0] == "Missing column 'gone' in dataset"
    assert texts[4] == "Missing column 'gone' for foreign key validation"


def test_email_format_is_opt_in(table):
    rows = table("customer_id email", [("c1", "not_an_email"), ("c2", "a@b.co")])
    default = flag_rows(rows, CHECKS["customers"])
    assert default.where(any_failed(3)).count() == 0
    strict = flag_rows(rows, [*CHECKS["customers"], EMAIL_FORMAT])
    assert failing(strict, "customer_id", 3) == {"c1"}


@pytest.fixture(scope="module")
def batch(table):
    customers = table("customer_id name email country segment signup_date is_active", [
        ("C1", "ann", "a@x", "us", "Consumer", "2024-01-01", "True"),
        ("C2", "bob", " ", "us", "Consumer", "2024-01-01", "True"),       # quarantined: its orders are orphans
        ("C3", "cid", "c@x", "us", "Consumer", "2024-01-01", "True"),
        ("C3", "cid", "c@x", "us", "Consumer", "2024-01-01", "True"),     # copies
    ])
    products = table("product_id sku product_name category unit_price cost_price in_stock", [
        ("P1", "s", "n", "c", "10", "5", "1"),
        ("P2", "s", "n", "c", "0", "5", "1"),
    ])
    good = ("2", "10.00", "0.1", "0", "2024-03-01 10:00:00", "Completed", "UPI")
    orders = table(ORDER, [
        ("O1", "C1", "P1", *good),
        ("O2", "C2", "P1", *good),
        ("O3", None, "P1", *good),
        ("O4", "C1", "P2", *good),
        ("O5", "C3", "P9", "-1", "x", "0", "0", "2026-99-99 25:99:99", "Lost", "UPI"),
        ("O6", "C1", "P1", *good),
        ("O6", "C1", "P1", *good),
    ])
    return {"customers": customers, "products": products, "orders": orders}


def test_reasons_cascade_in_order(batch):
    flagged = flag_batch(batch)
    got = {
        (r["order_id"], r["why"])
        for r in flagged.orders.select("order_id", joined_reasons(CHECKS["orders"]).alias("why")).collect()
    }
    orphan = "orphaned customer_id (not in customer master)"
    assert got == {
        ("O1", ""),
        ("O2", orphan),
        ("O3", f"customer_id is null | {orphan}"),
        ("O4", "orphaned product_id (not in product catalog)"),
        ("O5", "quantity must be greater than 0 | unit_price must be greater than 0 | "
               "invalid or unparseable order_date format | " + orphan +
               " | orphaned product_id (not in product catalog) | order_status not in allowed business statuses"),
        ("O6", "duplicate order_id"),
    }
    first = flagged.orders.where("order_id = 'O3'").select(reasons(CHECKS["orders"]).alias("r")).first()["r"]
    assert first == ["customer_id is null", orphan]
    assert [r["order_id"] for r in flagged.valid("orders").collect()] == ["O1"]


def test_nothing_is_lost_between_valid_and_quarantine(batch):
    flagged = flag_batch(batch)
    for d in ("customers", "products", "orders"):
        bad = splits.quarantine_records(flagged[d], d, "R")
        assert flagged.valid(d).count() + bad.count() == batch[d].count()
        assert bad.select("quarantine_id").distinct().count() == bad.count()


def test_quarantine_records(batch):
    flagged = flag_batch(batch)
    at = F.lit("2024-05-05 00:00:00").cast("timestamp_ntz")
    records = splits.quarantine_records(flagged.customers, "customers", "R9", at)
    assert [r["quarantine_id"] for r in records.orderBy("quarantine_id").collect()] == [
        "Q-R9-customers-00000", "Q-R9-customers-00001", "Q-R9-customers-00002"]
    audit = splits.quarantine_audit(records).orderBy("quarantine_id").first()
    assert audit["raw_record"] == (
        '{"customer_id":"C2","name":"bob","email":" ","country":"us","segment":"Consumer",'
        '"signup_date":"2024-01-01","is_active":"True"}')
    assert audit["is_resolved"] is False


def test_metrics_score_and_limits(batch):
    flagged = flag_batch(batch)
    rows = {(r["dataset"], r["check_name"]): r for r in flagged.metrics().collect()}
    assert len(rows) == 15
    dup = rows["orders", "unique:order_id"]
    assert (dup["records_checked"], dup["records_failed"], dup["pass_rate"], dup["status"], dup["threshold"]) == (
        7, 2, 71.43, "FAILED", 99.0)
    assert dup["details"] == "Column 'order_id' has 2 duplicate entries"
    assert rows["orders", "not_null:order_id"]["status"] == "PASSED"
    score = splits.score(flagged.all_totals(), 0.0).first()
    assert (score["total_records_ingested"], score["total_records_valid"], score["total_records_quarantined"]) == (13, 3, 10)
    assert (score["overall_quality_score"], score["quality_threshold"], score["status"]) == (23.08, 0.0, "SUCCESS")
    assert splits.score(flagged.all_totals()).first()["status"] == "FAILED_QUALITY_GATE"
    limits = {r["rate_name"]: r for r in splits.rate_limits(flagged.totals("orders"), "orders", CHECKS["orders"]).collect()}
    assert limits["duplicate_rate"]["within_limit"] is False and limits["null_key_rate"]["within_limit"] is True
    families = {(r["dataset"], r["family"]): r["failures"] for r in splits.failure_breakdown(flagged.metrics()).collect()}
    assert families["orders", "duplicate"] == 2 and families["orders", "missing"] == 1


def test_empty_batch_scores_full(table, batch):
    empty = {d: df.limit(0) for d, df in batch.items()}
    flagged = flag_batch(empty)
    assert splits.score(flagged.all_totals()).first()["overall_quality_score"] == 100.0
    assert {r["pass_rate"] for r in flagged.metrics().collect()} == {100.0}


def test_large_prices_are_prices_and_wild_amounts_have_their_reason(table):
    checks = [CHECKS["orders"][4], CHECKS["orders"][9]]
    rows = table("id quantity unit_price discount_rate", [
        ("1", "1", "2e16", "0"), ("2", "1", "5", "-1e30"), ("3", "1", "1e300", None), ("4", "x", "5", "0"), ("5", "2", "inf", "0")])
    flagged = flag_rows(rows, checks)
    assert failing(flagged, "id", 0) == {"5"}
    assert failing(flagged, "id", 1) == {"2", "3"}


def test_reserved_column_names(table):
    rows = table("id fail_note _row", [("1", "n", "r")])
    assert splits.valid_rows(flag_rows(rows, [Check("not_null", "id", "")])).columns == ["id", "fail_note", "_row"]
    with pytest.raises(ValueError):
        flag_rows(table("id __dq_fail_0", [("1", "x")]), [Check("not_null", "id", "")])


def test_no_zone_changes_a_time(spark, table):
    from dqlake.functions import timestamp_of

    rows = table("t", [("2024-03-10 02:30:00",), ("2024-02-30",), ("2024-1-5",), ("2024-03-10",), ("2024-03-10T02:30:00",)])
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = [r[0] for r in rows.select(timestamp_of(F.col("t")).cast("string")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == ["2024-03-10 02:30:00", None, None, "2024-03-10 00:00:00", None]


def test_stored_and_lazy_checks_of_keys_agree(spark):
    """Nulls, copies and hot keys: the failing values of each column, found on their own, mark what the tuples mark."""
    rows = [(f"o{i % 40}" if i % 7 else None, f"c{i % 5}" if i % 6 else None, "p1" if i % 3 else f"p{i}", i) for i in range(120)] * 2
    rows += [(f"single{i}", "c1", "p1", i) for i in range(30)]
    df = stage(spark.createDataFrame(rows, "order_id string, customer_id string, product_id string, v int"), "rows")
    parents = {"customers": spark.createDataFrame([("c1",), ("c2",)], "k string"), "products": spark.createDataFrame([("p1",)], "k string")}
    checks = [CHECKS["orders"][i] for i in (1, 6, 7)]
    lazy, stored = (Counter(map(tuple, flag_rows(df, checks, parents, store=s).drop(ROW_ID).collect())) for s in (False, True))
    copies = Counter(r[0] for r in rows)
    good = [r for r in rows if (r[0] is None or copies[r[0]] == 1) and r[1] in ("c1", "c2") and r[2] == "p1"]
    assert lazy == stored and Counter(r[:4] for r, n in stored.items() for _ in range(n) if not any(r[4:])) == Counter(good)
