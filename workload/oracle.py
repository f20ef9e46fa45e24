"""DuckDB twins of the registered queries: one chain of named subqueries and a final select per query."""

from __future__ import annotations

from workload.raw import SQL

RUN = "R1"
AT = "2027-06-01 06:00:00"

# ---- expressions ------------------------------------------------------------------------------------------------

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def strip(x):
    return f"trim({x}, {_BLANKS})"


def blank(x):
    return f"({x} IS NULL OR lower({strip(x)}) IN ('', 'nan', 'null'))"


def num(x):
    v = f"try_cast({strip(x)} AS DOUBLE)"
    return f"(CASE WHEN regexp_matches({x}, '{_NUMBER}') AND NOT isinf({v}) THEN {v} END)"


def positive(x, most=None, strict=True):
    low = "<=" if strict else "<"
    return f"coalesce({num(x)} {low} 0" + (f" OR {num(x)} > {most}" if most else "") + ", true)"


def beyond_money():
    return f"coalesce(abs(trunc({num('quantity')}) * {num('unit_price')} * (1 - coalesce({num('discount_rate')}, 0))) >= 1e25, false)"


def ts(x):
    return f"coalesce(try_strptime({x}, '%Y-%m-%d %H:%M:%S'), try_strptime({x}, '%Y-%m-%d'))"


def round2(x):
    return f"(round_even(({x}) * 100, 0) / 100)"


def msum(x):
    return f"cast(sum(cast({x} AS DECIMAL(28,2))) AS DOUBLE)"


def mavg(x):
    return round2(f"{msum(x)} / count({x})")


def title(x):
    return (f"array_to_string(list_transform(regexp_extract_all(lower({x}), '\\p{{L}}+|[^\\p{{L}}]+'), "
            "lambda w: upper(w[1]) || w[2:]), '')")


def pct(a, b):
    return f"(CASE WHEN {b} > 0 THEN {round2(f'{a} / {b} * 100')} ELSE 100.0 END)"


def ts_text(x):
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def day_text(x):
    return f"strftime({x}, '%Y-%m-%d')"


def mapped(x, values, default):
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in values.items())
    return f"(CASE {x} {whens} ELSE {default} END)"


def joined(flags_and_texts):
    return "concat_ws(' | ', " + ", ".join(f"CASE WHEN {f} THEN '{t}' END" for f, t in flags_and_texts) + ")"


# Fixed values, the same as the library's.
COUNTRY = {
    "us": "United States", "usa": "United States", "united states of america": "United States",
    "united states": "United States", "uk": "United Kingdom", "united kingdom": "United Kingdom", "in": "India",
    "ind": "India", "india": "India", "de": "Germany", "germany": "Germany", "ca": "Canada", "canada": "Canada",
}
SPELLING = {
    "Us": "United States", "Usa": "United States", "United States Of America": "United States",
    "Uk": "United Kingdom", "In": "India", "Ind": "India", "De": "Germany", "Ca": "Canada",
}
REASONS = {
    "customers": ["customer_id is null or empty", "duplicate customer_id", "missing or empty email"],
    "products": ["product_id is null or empty", "duplicate product_id", "unit_price must be > 0"],
    "orders": [
        "order_id is null or empty", "duplicate order_id", "customer_id is null", "quantity must be greater than 0",
        "unit_price must be greater than 0", "invalid or unparseable order_date format",
        "orphaned customer_id (not in customer master)", "orphaned product_id (not in product catalog)",
        "order_status not in allowed business statuses", "net amount does not fit the money type",
    ],
}
CHECKS = {
    "customers": ["not_null:customer_id", "unique:customer_id", "not_null:email"],
    "products": ["not_null:product_id", "unique:product_id", "positive_numeric:unit_price"],
    "orders": [
        "not_null:order_id", "unique:order_id", "not_null:customer_id", "positive_numeric:quantity",
        "positive_numeric:unit_price", "valid_datetime:order_date", "referential_integrity:customer_id",
        "referential_integrity:product_id", "allowed_values:order_status",
    ],
}
COLUMNS = {
    "customers": ["customer_id", "name", "email", "country", "segment", "signup_date", "is_active"],
    "products": ["product_id", "sku", "product_name", "category", "unit_price", "cost_price", "in_stock"],
    "orders": ["order_id", "customer_id", "product_id", "quantity", "unit_price", "discount_rate", "total_amount",
               "order_date", "order_status", "payment_method"],
}
STATUSES = "('Completed', 'Pending', 'Processing', 'Shipped', 'Cancelled', 'Refunded')"
MESSAGES = {
    "not_null": "Column '%s' has %d NULL/empty values",
    "unique": "Column '%s' has %d duplicate entries",
    "positive_numeric": "Column '%s' has %d non-positive/invalid numeric entries",
    "valid_datetime": "Column '%s' has %d unparseable/invalid date strings",
    "referential_integrity": "Foreign key '%s' has %d orphaned references",
    "allowed_values": "Column '%s' has %d values outside allowed set",
}

# ---- the chain --------------------------------------------------------------------------------------------------


def _repeated(key):
    return f"({key} IS NOT NULL AND count(*) OVER (PARTITION BY {key}) > 1)"


def _member(key, table):
    return f"coalesce({key} IN (SELECT {key} FROM {table}), false)"


CHAIN: dict[str, str] = {f"raw_{d}": text for d, text in SQL.items()}
CHAIN["customers_flagged"] = f"""
SELECT *, {blank('customer_id')} AS f0, {_repeated('customer_id')} AS f1, {blank('email')} AS f2 FROM raw_customers"""
CHAIN["products_flagged"] = f"""
SELECT *, {blank('product_id')} AS f0, {_repeated('product_id')} AS f1, {positive('unit_price')} AS f2
FROM raw_products"""
CHAIN["customers_valid"] = "SELECT * EXCLUDE (f0, f1, f2) FROM customers_flagged WHERE NOT (f0 OR f1 OR f2)"
CHAIN["products_valid"] = "SELECT * EXCLUDE (f0, f1, f2) FROM products_flagged WHERE NOT (f0 OR f1 OR f2)"
CHAIN["orders_flagged"] = f"""
SELECT *, {blank('order_id')} AS f0, {_repeated('order_id')} AS f1, {blank('customer_id')} AS f2,
       {positive('quantity', 2147483647)} AS f3, {positive('unit_price')} AS f4,
       {ts('order_date')} IS NULL AS f5, NOT {_member('customer_id', 'customers_valid')} AS f6,
       NOT {_member('product_id', 'products_valid')} AS f7,
       NOT coalesce(order_status IN {STATUSES}, false) AS f8, {beyond_money()} AS f9
FROM raw_orders"""
_ORDER_FLAGS = [f"f{i}" for i in range(10)]
CHAIN["orders_valid"] = (f"SELECT * EXCLUDE ({', '.join(_ORDER_FLAGS)}) FROM orders_flagged "
                         f"WHERE NOT ({' OR '.join(_ORDER_FLAGS)})")


def _flags(d):
    return [f"f{i}" for i in range(len(REASONS[d]))]


def _reasons(d):
    return joined(zip(_flags(d), REASONS[d]))


for _n, _d in enumerate(CHECKS):
    CHAIN[f"{_d}_totals"] = (
        f"SELECT '{_d}' AS dataset, count(*) AS ingested, count(*) FILTER (NOT ({' OR '.join(_flags(_d))})) AS valid, "
        + ", ".join(f"count(*) FILTER ({f}) AS {f}" for f in _flags(_d)) + f" FROM {_d}_flagged")


def _metric_rows():
    parts = []
    for n, d in enumerate(CHECKS):
        for i, check in enumerate(CHECKS[d]):
            kind, column = check.split(":")
            threshold = 99.0 if kind in ("not_null", "unique") else 95.0
            message = MESSAGES[kind].replace("%s", column).replace("'", "''").replace("%d", f"' || f{i} || '")
            parts.append(
                f"SELECT {10 * n + i} AS seq, '{check}' AS check_name, dataset, "
                f"CASE WHEN f{i} = 0 THEN 'PASSED' ELSE 'FAILED' END AS status, ingested AS records_checked, "
                f"ingested - f{i} AS records_passed, f{i} AS records_failed, "
                f"{pct(f'(ingested - f{i})', 'ingested')} AS pass_rate, cast({threshold} AS DOUBLE) AS threshold, "
                f"'{message}' AS details FROM {d}_totals")
    return "\nUNION ALL ".join(parts)


CHAIN["metrics"] = _metric_rows()
CHAIN["batch_score"] = f"""
SELECT cast(sum(ingested) AS BIGINT) AS total_records_ingested, cast(sum(valid) AS BIGINT) AS total_records_valid,
       cast(sum(ingested) - sum(valid) AS BIGINT) AS total_records_quarantined,
       {pct('cast(sum(valid) AS DOUBLE)', 'sum(ingested)')} AS overall_quality_score
FROM (SELECT ingested, valid FROM customers_totals UNION ALL SELECT ingested, valid FROM products_totals
      UNION ALL SELECT ingested, valid FROM orders_totals)"""
CHAIN["clean_customers"] = f"""
SELECT {strip('customer_id')} AS customer_id, {title(strip('name'))} AS name, lower({strip('email')}) AS email,
       {mapped(f"lower({strip('country')})", COUNTRY, "'Other'")} AS country, {strip('segment')} AS segment,
       cast({ts('signup_date')} AS DATE) AS signup_date,
       coalesce(lower(is_active) IN ('true', '1', 'yes'), false) AS is_active
FROM customers_valid"""
CHAIN["clean_products_typed"] = f"""
SELECT {strip('product_id')} AS product_id, upper({strip('sku')}) AS sku, {strip('product_name')} AS product_name,
       coalesce({title(strip('category'))}, 'Unknown') AS category, {num('unit_price')} AS unit_price,
       {num('cost_price')} AS cost_price, coalesce(try_cast(trunc({num('in_stock')}) AS INTEGER), 0) AS in_stock
FROM products_valid"""
CHAIN["clean_products"] = f"""
SELECT *, CASE WHEN unit_price > 0 THEN {round2('(unit_price - cost_price) / unit_price * 100')} ELSE 0.0 END
          AS profit_margin_pct FROM clean_products_typed"""
CHAIN["clean_orders_typed"] = f"""
SELECT {strip('order_id')} AS order_id, {strip('customer_id')} AS customer_id, {strip('product_id')} AS product_id,
       try_cast(trunc({num('quantity')}) AS INTEGER) AS quantity, {num('unit_price')} AS unit_price,
       coalesce({num('discount_rate')}, 0.0) AS discount_rate, {ts('order_date')} AS order_date,
       {strip('order_status')} AS order_status, coalesce({strip('payment_method')}, 'Unknown') AS payment_method
FROM orders_valid"""
CHAIN["clean_orders"] = f"""
SELECT *, {round2('quantity * unit_price * (1.0 - discount_rate)')} AS total_amount,
       cast(year(order_date) AS INTEGER) AS year, cast(month(order_date) AS INTEGER) AS month,
       cast(day(order_date) AS INTEGER) AS day FROM clean_orders_typed"""
CHAIN["rfm"] = f"""
SELECT customer_id, {msum('total_amount')} AS total_spend, count(order_id) AS total_orders,
       {mavg('total_amount')} AS avg_order_value, max(order_date) AS last_order_date,
       cast(date_sub('day', max(order_date), (SELECT max(order_date) FROM clean_orders)) AS INTEGER)
         AS days_since_last_order,
       CASE WHEN {msum('total_amount')} >= 10000 THEN 'Diamond' WHEN {msum('total_amount')} >= 5000 THEN 'Gold'
            WHEN {msum('total_amount')} >= 1000 THEN 'Silver' ELSE 'Bronze' END AS customer_tier
FROM clean_orders GROUP BY customer_id"""
CHAIN["lake_customers"] = """
SELECT c.customer_id, coalesce(name, 'Unknown') AS name, coalesce(email, '') AS email,
       coalesce(country, 'Other') AS country, coalesce(segment, 'Consumer') AS segment, signup_date, is_active,
       coalesce(total_spend, 0.0) AS total_spend, coalesce(total_orders, 0) AS total_orders,
       coalesce(avg_order_value, 0.0) AS avg_order_value, last_order_date,
       coalesce(days_since_last_order, 999) AS days_since_last_order, coalesce(customer_tier, 'Bronze') AS customer_tier
FROM clean_customers c LEFT JOIN rfm USING (customer_id)"""
CHAIN["product_sales"] = f"""
SELECT product_id, cast(sum(quantity) AS BIGINT) AS total_units_sold, {msum('total_amount')} AS total_revenue
FROM clean_orders GROUP BY product_id"""
CHAIN["lake_products"] = """
SELECT p.*, coalesce(total_units_sold, 0) AS total_units_sold, coalesce(total_revenue, 0.0) AS total_revenue
FROM clean_products p LEFT JOIN product_sales USING (product_id)"""
CHAIN["fact"] = """
SELECT cast('0x' || substr(md5(order_id), 1, 15) AS BIGINT) AS order_key, order_id, customer_id, product_id,
       cast(strftime(order_date, '%Y%m%d') AS INTEGER) AS date_key, order_date, quantity, unit_price, discount_rate,
       total_amount, order_status, payment_method
FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY order_date, customer_id, product_id) AS rn
      FROM clean_orders) WHERE rn = 1"""


def calendar(first, last):
    return f"""
SELECT cast(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, cast(d AS DATE) AS full_date, cast(year(d) AS INTEGER) AS year,
       cast(quarter(d) AS INTEGER) AS quarter, cast(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
       cast(day(d) AS INTEGER) AS day, cast(isodow(d) - 1 AS INTEGER) AS day_of_week, dayname(d) AS day_name,
       isodow(d) >= 6 AS is_weekend
FROM (SELECT unnest(generate_series({first}, {last}, INTERVAL 1 DAY)) AS d)"""


CHAIN["dim_date"] = calendar("TIMESTAMP '2023-01-01'", "TIMESTAMP '2027-12-31'")
CHAIN["monthly"] = f"""
SELECT d.year, d.month, d.month_name, count(*) AS total_orders, count(DISTINCT f.customer_id) AS distinct_customers,
       {msum('f.total_amount')} AS total_revenue, {mavg('f.total_amount')} AS avg_order_value
FROM fact f JOIN dim_date d USING (date_key) GROUP BY d.year, d.month, d.month_name"""
CHAIN["products_mart"] = f"""
SELECT p.product_id, p.product_name, p.category, p.unit_price, p.profit_margin_pct, count(f.order_key) AS order_count,
       cast(sum(f.quantity) AS BIGINT) AS units_sold, {msum('f.total_amount')} AS gross_revenue
FROM lake_products p LEFT JOIN fact f USING (product_id)
GROUP BY p.product_id, p.product_name, p.category, p.unit_price, p.profit_margin_pct"""
CHAIN["retention"] = f"""
SELECT segment, customer_tier, count(DISTINCT customer_id) AS total_customers, {msum('total_spend')} AS aggregate_spend,
       {mavg('total_spend')} AS avg_customer_spend, {mavg('avg_order_value')} AS avg_order_value
FROM lake_customers GROUP BY segment, customer_tier"""
CHAIN["audit"] = """
SELECT row_number() OVER (ORDER BY run_id, seq) AS audit_id, * EXCLUDE (seq, threshold, details)
FROM (SELECT 'run-a' AS run_id, TIMESTAMP '2027-06-01 06:00:00' AS evaluated_at, * FROM metrics
      UNION ALL SELECT 'run-b', TIMESTAMP '2027-06-02 06:00:00', * FROM metrics)"""
CHAIN["trends"] = f"""
SELECT run_id, cast(evaluated_at AS DATE) AS audit_date, count(*) AS checks_executed,
       cast(sum(records_checked) AS BIGINT) AS total_records_checked,
       cast(sum(records_passed) AS BIGINT) AS total_records_passed,
       cast(sum(records_failed) AS BIGINT) AS total_records_failed, {mavg('pass_rate')} AS avg_check_pass_rate
FROM audit GROUP BY run_id, cast(evaluated_at AS DATE)"""


def quarantine(d):
    order = ", ".join(f"{c} NULLS FIRST" for c in COLUMNS[d])
    return f"""
SELECT printf('Q-{RUN}-{d}-%05d', row_number() OVER (ORDER BY {order}) - 1) AS quarantine_id, '{RUN}' AS run_id,
       '{d}' AS dataset, '{AT}' AS quarantine_timestamp, {_reasons(d)} AS error_reasons, {', '.join(COLUMNS[d])}
FROM {d}_flagged WHERE {' OR '.join(_flags(d))}"""


for _d in CHECKS:
    CHAIN[f"{_d}_quarantine"] = quarantine(_d)

# lineage: registered tables and the order path by day and month
_EDGES = [
    ("raw_orders", "quality_gate_orders"), ("raw_customers", "quality_gate_orders"),
    ("raw_products", "quality_gate_orders"), ("quality_gate_orders", "lake_fact_orders"),
    ("raw_customers", "lake_dim_customers"), ("lake_fact_orders", "lake_dim_customers"),
    ("raw_products", "lake_dim_products"), ("lake_fact_orders", "lake_dim_products"),
    ("lake_fact_orders", "dw_fact_orders"), ("lake_dim_customers", "dw_dim_customers"),
    ("lake_dim_products", "dw_dim_products"), ("dw_fact_orders", "v_mart_monthly_revenue"),
    ("dw_dim_date", "v_mart_monthly_revenue"), ("dw_dim_products", "v_mart_top_products"),
    ("dw_fact_orders", "v_mart_top_products"), ("v_mart_monthly_revenue", "bi_executive_kpis"),
    ("v_mart_top_products", "bi_executive_kpis"),
]
CHAIN["edges"] = "SELECT * FROM (VALUES " + ", ".join(f"('{u}', '{n}')" for u, n in _EDGES) + """) v(upstream, name)
UNION SELECT 'raw_orders/' || strftime(order_date, '%Y-%m-%d'), 'lake_fact_orders/' || strftime(order_date, '%Y-%m') FROM clean_orders
UNION SELECT 'lake_fact_orders/' || strftime(order_date, '%Y-%m'), 'dw_fact_orders/' || strftime(order_date, '%Y-%m') FROM clean_orders
UNION SELECT 'dw_fact_orders/' || strftime(order_date, '%Y-%m'), 'v_mart_monthly_revenue/' || strftime(order_date, '%Y-%m') FROM clean_orders
UNION SELECT 'v_mart_monthly_revenue/' || strftime(order_date, '%Y-%m'), 'v_mart_monthly_revenue' FROM clean_orders"""


def reached(target):
    return f"""reached(name, depth) AS (
SELECT '{target}', 0 UNION
SELECT e.upstream, r.depth + 1 FROM reached r JOIN edges e ON e.name = r.name)"""


def sql(final: str, extra: str = "") -> str:
    ctes = [f"{name} AS ({text.strip()})" for name, text in CHAIN.items() if _needed(name, final + extra)]
    if extra:
        ctes.append(extra)
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n" + final if ctes else final


def _needed(name: str, text: str) -> bool:
    return name in _closure(text)


def _closure(text: str) -> set[str]:
    import re

    found: set[str] = set()
    todo = [text]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        for name in CHAIN:
            if name in words and name not in found:
                found.add(name)
                todo.append(CHAIN[name])
    return found


# ---- final selects ----------------------------------------------------------------------------------------------

def _violations(pairs):
    return joined([(f"NOT coalesce({cond}, false)", text) for text, cond in pairs])


def _len(c, a, b):
    return f"{c} length not in {a}..{b}", f"length({c}) BETWEEN {a} AND {b}"


_CONTRACTS = {
    "customers": [
        _len("customer_id", 3, 50), _len("name", 1, 255), _len("email", 5, 255), _len("country", 2, 100),
        ("segment not allowed", "segment IN ('Consumer', 'Corporate', 'Home Office', 'Small Business')"),
        ("signup_date is not a date", f"{ts('signup_date')} IS NOT NULL"),
    ],
    "products": [
        _len("product_id", 3, 50), _len("sku", 3, 50), _len("product_name", 1, 255), _len("category", 1, 100),
        ("unit_price not above 0", f"{num('unit_price')} > 0"), ("cost_price below 0", f"{num('cost_price')} >= 0"),
        ("in_stock not a whole number from 0",
         f"{num('in_stock')} >= 0 AND {num('in_stock')} = floor({num('in_stock')})"),
    ],
    "orders": [
        _len("order_id", 3, 50), _len("customer_id", 3, 50), _len("product_id", 3, 50),
        ("quantity not a whole number above 0",
         f"{num('quantity')} > 0 AND {num('quantity')} = floor({num('quantity')})"),
        ("unit_price not above 0", f"{num('unit_price')} > 0"),
        ("discount_rate not in 0..1", f"discount_rate IS NULL OR {num('discount_rate')} BETWEEN 0 AND 1"),
        ("total_amount below 0", f"{num('total_amount')} >= 0"),
        ("order_date is not a timestamp", f"{ts('order_date')} IS NOT NULL"),
        ("order_status not allowed", f"order_status IN {STATUSES}"),
        ("payment_method not allowed", "payment_method IN ('Credit Card', 'Debit Card', 'UPI', 'Net Banking', "
                                       "'Wallet', 'Cash on Delivery')"),
    ],
}


def _cols(d, prefix=""):
    return ", ".join(prefix + c for c in COLUMNS[d])


_FACT = ("order_key, order_id, customer_id, product_id, date_key, " + ts_text("order_date") + " AS order_date, quantity, "
         "unit_price, discount_rate, total_amount, order_status, payment_method")
_CLEAN_CUSTOMER = f"customer_id, name, email, country, segment, {day_text('signup_date')} AS signup_date, is_active"
_CLEAN_ORDER = ("order_id, customer_id, product_id, quantity, unit_price, discount_rate, total_amount, "
                f"{ts_text('order_date')} AS order_date, order_status, payment_method, year, month, day")
_BEST = "ORDER BY gross_revenue DESC NULLS LAST, product_id LIMIT"
_SCORE = """SELECT total_records_ingested, total_records_valid, total_records_quarantined, overall_quality_score,
cast({t} AS DOUBLE) AS quality_threshold,
CASE WHEN overall_quality_score >= {t} THEN 'SUCCESS' ELSE 'FAILED_QUALITY_GATE' END AS status FROM batch_score"""


def _dim_customers():
    return f"""SELECT row_number() OVER (ORDER BY customer_id) AS customer_key, customer_id, name, email, country, segment,
{day_text('signup_date')} AS signup_date, is_active, customer_tier, total_spend, total_orders, avg_order_value
FROM lake_customers"""


def _dim_products():
    return """SELECT row_number() OVER (ORDER BY product_id) AS product_key, product_id, sku, product_name, category,
unit_price, cost_price, profit_margin_pct, in_stock, total_units_sold, total_revenue FROM lake_products"""


def _fault(slot):
    faults = ["negative_quantity", "negative_price", "null_customer_id", "duplicate_order_id", "invalid_date_format",
              "orphan_foreign_key", "corrupted_status", "zero_quantity"]
    return f"CASE {slot} " + " ".join(f"WHEN {i} THEN '{f}'" for i, f in enumerate(faults)) + " END"


def _drift(rows):
    return " UNION ALL ".join(
        "SELECT " + ", ".join(f"{'NULL' if v is None else repr(v)} AS {k}" for k, v in row.items()) for row in rows)


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    out["rule_not_null"] = sql(
        f"SELECT customer_id, email, name, {blank('customer_id')} AS customer_id_fails, {blank('email')} AS email_fails, "
        f"{blank('name')} AS name_fails, true AS loyalty_code_fails FROM raw_customers")
    out["rule_unique"] = sql(f"SELECT order_id, customer_id, {_repeated('order_id')} AS order_id_fails FROM raw_orders")
    out["rule_unique_two_columns"] = (
        "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, "
        "count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 AS key_fails FROM lineitem")
    out["rule_positive_numeric"] = sql(
        f"SELECT order_id, quantity, unit_price, discount_rate, {positive('quantity', 2147483647)} AS quantity_fails, "
        f"{positive('unit_price')} AS unit_price_fails, {positive('discount_rate', None, False)} AS discount_rate_fails "
        "FROM raw_orders")
    out["rule_positive_numeric_products"] = sql(
        f"SELECT product_id, unit_price, in_stock, {positive('unit_price')} AS unit_price_fails, "
        f"{positive('in_stock', None, False)} AS in_stock_fails FROM raw_products")
    out["rule_valid_datetime"] = sql(f"SELECT order_id, order_date, {ts('order_date')} IS NULL AS order_date_fails FROM raw_orders")
    out["rule_referential_integrity"] = sql(
        f"SELECT order_id, customer_id, product_id, NOT {_member('customer_id', 'customers_valid')} AS customer_id_fails, "
        f"NOT {_member('product_id', 'products_valid')} AS product_id_fails FROM raw_orders")
    out["rule_allowed_values"] = sql(
        f"SELECT order_id, order_status, payment_method, NOT coalesce(order_status IN {STATUSES}, false) AS order_status_fails, "
        "NOT coalesce(payment_method IN ('Credit Card', 'Debit Card', 'UPI', 'Net Banking', 'Wallet', "
        "'Cash on Delivery'), false) AS payment_method_fails FROM raw_orders")
    out["rule_email_format"] = sql(
        "SELECT customer_id, email, NOT coalesce(regexp_matches(email, '^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$'), false) "
        "AS email_fails FROM raw_customers")
    for d in CHECKS:
        out[f"{d}_flagged_reasons"] = sql(f"SELECT {_cols(d)}, {_reasons(d)} AS error_reasons FROM {d}_flagged")
        out[f"{d}_valid"] = sql(f"SELECT {_cols(d)} FROM {d}_valid")
        out[f"{d}_quarantine"] = sql(f"SELECT * FROM {d}_quarantine")
    out["quality_metrics"] = sql("SELECT * EXCLUDE (seq) FROM metrics")
    out["gate_score"] = sql(_SCORE.format(t="90.0") + " UNION ALL " + _SCORE.format(t="95.0"))
    out["failure_breakdown"] = sql(
        "SELECT dataset, CASE WHEN check_name LIKE 'unique:%' THEN 'duplicate' WHEN check_name LIKE 'not_null:%' "
        "THEN 'missing' ELSE 'invalid' END AS family, cast(sum(records_failed) AS BIGINT) AS failures "
        "FROM metrics GROUP BY 1, 2")
    out["reason_counts"] = sql(" UNION ALL ".join(
        f"SELECT '{d}' AS dataset, '{t}' AS reason, count(*) AS failures FROM {d}_flagged WHERE f{i} HAVING count(*) > 0"
        for d in CHECKS for i, t in enumerate(REASONS[d])))
    out["rate_limits"] = sql(" UNION ALL ".join(
        f"SELECT dataset, '{n}' AS rate_name, {f} / ingested AS rate, cast({lim} AS DOUBLE) AS rate_limit, "
        f"{f} / ingested <= {lim} AS within_limit FROM {d}_totals"
        for d in CHECKS for n, f, lim in (("duplicate_rate", "f1", 0.02), ("null_key_rate", "f0", 0.0))))
    out["clean_customers"] = sql(f"SELECT {_CLEAN_CUSTOMER} FROM clean_customers")
    out["clean_products"] = sql("SELECT * FROM clean_products")
    out["clean_orders"] = sql(f"SELECT {_CLEAN_ORDER} FROM clean_orders")
    out["customer_rfm"] = sql(f"SELECT * REPLACE ({ts_text('last_order_date')} AS last_order_date) FROM rfm")
    out["enrich_customers"] = sql(
        f"SELECT * REPLACE ({ts_text('last_order_date')} AS last_order_date, {day_text('signup_date')} AS signup_date) "
        "FROM lake_customers")
    out["enrich_products"] = sql("SELECT * FROM lake_products")
    out["product_revenue_rank"] = sql(
        "SELECT product_id, category, total_revenue, rank() OVER (ORDER BY total_revenue DESC) AS revenue_rank, "
        "rank() OVER (PARTITION BY category ORDER BY total_revenue DESC) AS category_rank FROM lake_products")
    out["dim_date"] = sql("SELECT * REPLACE (" + day_text("full_date") + " AS full_date) FROM (" + calendar(
        "(SELECT date_trunc('year', min(order_date)) FROM clean_orders)",
        "(SELECT date_trunc('year', max(order_date)) + INTERVAL 1 YEAR - INTERVAL 1 DAY FROM clean_orders)") + ")")
    out["dim_customers"] = sql(_dim_customers())
    out["dim_products"] = sql(_dim_products())
    out["fact_orders"] = sql(f"SELECT {_FACT} FROM fact")
    out["mart_monthly_revenue"] = sql("SELECT * FROM monthly")
    out["query_mart_newest_months"] = sql("SELECT * FROM monthly ORDER BY year DESC, month DESC LIMIT 10")
    out["mart_top_products"] = sql(f"SELECT * FROM products_mart {_BEST} 10")
    out["mart_product_performance"] = sql("SELECT * FROM products_mart")
    out["top5_products"] = sql(f"SELECT product_name, gross_revenue FROM products_mart {_BEST} 5")
    out["mart_customer_retention"] = sql("SELECT * FROM retention")
    out["segment_spend"] = sql(f"SELECT segment, {msum('aggregate_spend')} AS spend FROM retention GROUP BY segment")
    out["mart_quality_trends"] = sql(f"SELECT * REPLACE ({day_text('audit_date')} AS audit_date) FROM trends")
    out["recent_quality_checks"] = sql(
        f"SELECT * REPLACE ({ts_text('evaluated_at')} AS evaluated_at) FROM audit ORDER BY evaluated_at DESC, audit_id LIMIT 20")
    out["executive_summary"] = sql(
        f"SELECT {msum('total_amount')} AS total_revenue, count(*) AS total_orders, count(DISTINCT customer_id) AS active_customers, "
        f"{round2(msum('total_amount') + ' / count(*)')} AS avg_order_value, "
        f"(SELECT {mavg('pass_rate')} FROM audit) AS mean_check_pass_rate FROM fact")
    out["outside_calendar"] = sql(
        "SELECT count(*) AS orders_outside_calendar FROM fact WHERE date_key NOT BETWEEN 20230101 AND 20271231")
    out["quarantine_page"] = sql(
        "SELECT quarantine_id, error_reasons, order_id, customer_id, (SELECT count(*) FROM orders_quarantine) AS total_quarantined "
        "FROM orders_quarantine ORDER BY quarantine_id LIMIT 25")
    out["quarantine_audit"] = sql(
        "SELECT row_number() OVER (ORDER BY dataset, quarantine_id) AS quarantine_key, * FROM (" + " UNION ALL ".join(
            f"SELECT quarantine_id, run_id, dataset, error_reasons, cast(to_json({{{', '.join(f'{chr(39)}{c}{chr(39)}: {c}' for c in COLUMNS[d])}}}) AS VARCHAR) "
            f"AS raw_record, quarantine_timestamp, false AS is_resolved FROM {d}_quarantine" for d in CHECKS) + ")")
    out["star_upsert"] = sql(f"""
, day1 AS (SELECT row_number() OVER (ORDER BY order_date, order_id) AS order_key, * EXCLUDE (order_key) FROM fact
           WHERE order_date < TIMESTAMP '2026-01-01'),
day2 AS (SELECT * EXCLUDE (order_key) REPLACE ('Refunded' AS order_status) FROM fact WHERE order_date >= TIMESTAMP '2025-07-01'),
fresh AS (SELECT (SELECT count(*) FROM day1) + row_number() OVER (ORDER BY order_date, order_id) AS order_key, *
          FROM day2 WHERE order_id NOT IN (SELECT order_id FROM day1))
SELECT {_FACT} FROM (
  SELECT * FROM day1 WHERE order_id NOT IN (SELECT order_id FROM day2)
  UNION ALL BY NAME SELECT d1.order_key, d2.* FROM day2 d2 JOIN day1 d1 USING (order_id)
  UNION ALL BY NAME SELECT * FROM fresh)""".lstrip())
    out["orphan_report"] = sql("""
SELECT 'customer_id' AS key_column, customer_id AS key_value, count(*) AS orders FROM raw_orders
WHERE customer_id IS NOT NULL AND customer_id NOT IN (SELECT customer_id FROM customers_valid) GROUP BY customer_id
UNION ALL SELECT 'customer_id', NULL, count(*) FROM raw_orders WHERE customer_id IS NULL HAVING count(*) > 0
UNION ALL SELECT 'product_id', product_id, count(*) FROM raw_orders
WHERE product_id NOT IN (SELECT product_id FROM products_valid) GROUP BY product_id""")
    out["contract_customers"] = sql(
        f"SELECT customer_id, email, {_violations(_CONTRACTS['customers'])} AS violations, "
        "CASE WHEN is_active IS NULL THEN true ELSE lower(is_active) IN ('true', '1', 'yes') END AS active FROM raw_customers")
    out["contract_products"] = sql(
        f"SELECT product_id, unit_price, {_violations(_CONTRACTS['products'])} AS violations, "
        f"CASE WHEN {num('unit_price')} > 0 THEN {round2(f'({num('unit_price')} - {num('cost_price')}) / {num('unit_price')} * 100')} "
        "ELSE 0.0 END AS profit_margin FROM raw_products")
    out["contract_orders"] = sql(
        f"SELECT order_id, customer_id, {_violations(_CONTRACTS['orders'])} AS violations, cast(year({ts('order_date')}) AS INTEGER) AS year, "
        f"cast(month({ts('order_date')}) AS INTEGER) AS month, cast(day({ts('order_date')}) AS INTEGER) AS day FROM raw_orders")
    std = title(strip("country"))
    out["contract_country"] = sql(
        f"SELECT customer_id, country, {mapped(std, SPELLING, std)} AS standard_country FROM raw_customers")
    base_orders = sorted(COLUMNS["orders"])
    required = ["customer_id", "order_date", "order_id", "product_id", "quantity", "unit_price"]

    def row(batch, columns):
        added = sorted(set(columns) - set(base_orders))
        removed = sorted(set(base_orders) - set(columns))
        missing = sorted(set(required) - set(columns))
        verdict = "BREAKING_CHANGE" if missing else "COMPATIBLE_EXTENSION" if added or removed else "NO_CHANGE"
        return {"batch": batch, "dataset": "orders", "verdict": verdict, "action": "HALT" if missing else "CONTINUE",
                "added_columns": ",".join(added), "removed_columns": ",".join(removed),
                "missing_required_columns": ",".join(missing)}

    out["schema_drift"] = _drift([
        row("exact", base_orders), row("extended", base_orders + ["coupon_code"]),
        row("reduced", [c for c in base_orders if c != "payment_method"]),
        row("broken", [c for c in base_orders if c != "customer_id"]),
    ])
    out["lineage_upstream"] = sql("SELECT name, min(depth) AS depth FROM reached GROUP BY name", reached("bi_executive_kpis"))
    out["lineage_edges"] = sql(
        "SELECT upstream, name FROM edges WHERE name IN (SELECT name FROM reached) AND upstream IN (SELECT name FROM reached)",
        reached("v_mart_monthly_revenue"))
    out["lake_round_trip"] = sql(
        f"SELECT year, month, count(*) AS orders, {msum('total_amount')} AS revenue FROM clean_orders GROUP BY year, month")
    out["lake_manifest"] = sql(
        "SELECT 'R1' AS run_id, (SELECT count(*) FROM lake_customers) AS customers, (SELECT count(*) FROM lake_products) AS products, "
        "(SELECT count(*) FROM clean_orders) AS orders, (SELECT count(*) FROM (SELECT DISTINCT year, month FROM clean_orders)) AS partitions_created")
    out["audit_load_idempotent"] = sql(
        "SELECT audit_id, run_id, check_name, dataset, status, records_checked, records_passed, records_failed, pass_rate FROM audit")
    out["csv_null_tokens"] = sql(f"SELECT {_cols('orders')} FROM raw_orders")
    out["replay_run"] = sql("""
SELECT 'first' AS attempt, 'BLOCKED_BY_QUALITY_GATE' AS status, overall_quality_score AS quality_score, NULL AS orders_processed,
       NULL AS partitions_created, NULL AS orders_loaded FROM batch_score
UNION ALL SELECT 'replay', 'SUCCESS', overall_quality_score, (SELECT count(*) FROM clean_orders),
       (SELECT count(*) FROM (SELECT DISTINCT year, month FROM clean_orders)), (SELECT count(*) FROM fact) FROM batch_score""")
    out["noise_injection"] = (
        "SELECT order_id, customer_id, quantity, unit_price, order_date, order_status, fault FROM ("
        + SQL["orders"].strip().replace("AS payment_method\n", f"AS payment_method, {_fault('m')} AS fault\n") + ")")
    out["compatible_extension_union"] = sql(
        f"SELECT {_cols('orders')}, NULL AS coupon_code FROM raw_orders WHERE payment_method <> 'UPI' "
        f"UNION ALL SELECT {_cols('orders')}, 'C-' || order_status FROM raw_orders WHERE payment_method = 'UPI'")
    out["entity_customers"] = sql(
        f"SELECT customer_id, name, country, segment, customer_tier FROM lake_customers WHERE is_active")
    out["entity_products"] = sql(
        "SELECT product_id, product_name, category, unit_price, total_revenue FROM lake_products WHERE category = 'Economy'")
    wild = (f"SELECT order_id, CASE WHEN order_status = 'Pending' THEN unit_price || 'e17' ELSE unit_price END AS unit_price, "
            "CASE WHEN order_status = 'Shipped' THEN '-1e30' ELSE discount_rate END AS discount_rate, quantity FROM raw_orders")
    out["rule_large_amounts"] = sql(
        f"SELECT order_id, unit_price, discount_rate, {positive('unit_price')} AS unit_price_fails, {beyond_money()} AS total_amount_fails FROM ({wild})")
    far = calendar("(SELECT make_timestamp(min(year), 1, 1, 0, 0, 0) FROM clean_orders)", "TIMESTAMP '9999-12-31'")
    out["dim_date_to_the_end"] = sql(
        f"SELECT year, count(*) AS days, count(*) FILTER (is_weekend) AS weekend_days FROM ({far}) GROUP BY year")
    out["mart_monthly_chart"] = sql(
        "SELECT row_number() OVER (ORDER BY year, month) AS place, year, month, total_orders, total_revenue FROM monthly")
    mixed = ("order_id, customer_id, quantity, order_date, CASE WHEN order_status IS DISTINCT FROM 'Cancelled' THEN payment_method END AS payment_method, "
             "CASE WHEN order_status NOT IN ('Completed', 'Pending', 'Cancelled') THEN 'C-' || order_status END AS coupon_code")
    out["csv_mixed_headers"] = sql(
        f"SELECT {mixed}, nullif({_reasons('orders')}, '') AS error_reasons FROM orders_flagged")
    out["raw_history"] = sql(
        "SELECT CASE order_status WHEN 'Completed' THEN 'run-0' WHEN 'Pending' THEN 'run-1' ELSE 'run-2' END AS run_id, order_id, order_status, "
        "CASE WHEN order_status <> 'Shipped' THEN payment_method END AS payment_method, CASE WHEN order_status = 'Pending' THEN 'C-' || payment_method END AS coupon, "
        "CASE WHEN order_status = 'Shipped' THEN 'web' END AS channel FROM raw_orders WHERE order_status IN ('Completed', 'Pending', 'Shipped')")
    out["csv_line_breaks"] = sql(
        "SELECT order_id, customer_id, quantity, order_date, 'status \"' || order_status || '\",' || chr(10) || chr(10) || 'by ' || payment_method || chr(10) AS note, "
        f"nullif({_reasons('orders')}, '') AS error_reasons FROM orders_flagged")
    out["csv_documents"] = (
        "SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, CASE WHEN lang = 'en' THEN source END AS source, nullif(text, '') AS text FROM documents")
    mended = joined((f, t) for f, t in zip(_flags("orders"), REASONS["orders"]) if f != "f8")
    parts = [f"SELECT '{d}' AS dataset, {mended if d == 'orders' else _reasons(d)} AS error_reasons FROM {d}_flagged" for d in CHECKS]
    out["replay_mended_rows"] = sql(
        "SELECT 'run-1' AS run_id, dataset, error_reasons, count(*) AS records, count(*) AS audit_keys FROM ("
        + " UNION ALL ".join(parts) + ") WHERE error_reasons <> '' GROUP BY dataset, error_reasons")
    new_status = "CASE WHEN order_date >= TIMESTAMP '2025-07-01' THEN 'Refunded' ELSE order_status END AS order_status"
    out["star_load_two_runs"] = sql(
        f"SELECT {_FACT.replace('order_status', new_status)} FROM fact")
    out["mart_months_refreshed"] = out["mart_monthly_revenue"]
    out["buyers_by_year"] = sql(
        "SELECT d.year, count(*) AS total_orders, count(DISTINCT f.customer_id) AS distinct_customers, "
        f"{msum('f.total_amount')} AS total_revenue, {mavg('f.total_amount')} AS avg_order_value "
        "FROM fact f JOIN (SELECT order_id, cast(floor(date_key / 10000) AS INT) AS year FROM fact) d USING (order_id) GROUP BY GROUPING SETS ((d.year), ())")
    out["retention_by_key"] = sql(
        f"SELECT segment, customer_tier, count(DISTINCT customer_id) AS total_customers, {msum('total_spend')} AS aggregate_spend, "
        f"{mavg('total_spend')} AS avg_customer_spend, {mavg('avg_order_value')} AS avg_order_value FROM ({_dim_customers()}) GROUP BY segment, customer_tier")
    out["lineage_of_run"] = (
        "SELECT * FROM (VALUES ('dw_dim_customers', 0, 'WAREHOUSE'), ('lake_dim_customers', 1, 'LAKEHOUSE'), ('raw_customers', 2, 'RAW'), "
        "('lake_fact_orders', 2, 'LAKEHOUSE'), ('quality_gate_orders', 3, 'QUALITY_GATE'), ('raw_orders', 4, 'RAW'), ('raw_products', 4, 'RAW')) t(name, depth, tier)")
    out["entity_orders"] = sql(f"SELECT {_FACT} FROM fact WHERE order_status = 'Completed'")
    return out
