"""The six rule kinds and the check list of each dataset.

A check is data; its result is one boolean column per row (True = failed). Row-level kinds are expressions of one
projection. ``unique`` and ``referential_integrity`` look a key up.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from dqlake import schemas
from dqlake.functions import is_blank, number, timestamp_of
from dqlake.functions.dates import FORMATS
from dqlake.functions.numbers import MAX_INT, MONEY_BOUND, net_amount
from dqlake.operators.keyed import PREFIX, ROW_ID, SPREAD, mark_members, repeated_keys, with_row_id
from dqlake.sources.staging import stage


KEYED = ("unique", "referential_integrity")
COPIES = f"{PREFIX}copies"
MONEY_PARTS = ("quantity", "unit_price", "discount_rate")


@dataclass(frozen=True)
class Check:
    kind: str
    column: str
    reason: str
    allowed: tuple[str, ...] = ()
    parent: str | None = None
    strict: bool = True
    most: float | None = None
    formats: tuple[str, ...] = FORMATS
    reported: bool = True  # has a metric of its own

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.column}"

    @property
    def threshold(self) -> float:
        return 99.0 if self.kind in ("not_null", "unique") else 95.0


# Kinds, columns, order and reason texts.
CHECKS: dict[str, list[Check]] = {
    "customers": [
        Check("not_null", "customer_id", "customer_id is null or empty"),
        Check("unique", "customer_id", "duplicate customer_id"),
        Check("not_null", "email", "missing or empty email"),
    ],
    "products": [
        Check("not_null", "product_id", "product_id is null or empty"),
        Check("unique", "product_id", "duplicate product_id"),
        Check("positive_numeric", "unit_price", "unit_price must be > 0"),
    ],
    "orders": [
        Check("not_null", "order_id", "order_id is null or empty"),
        Check("unique", "order_id", "duplicate order_id"),
        Check("not_null", "customer_id", "customer_id is null"),
        Check("positive_numeric", "quantity", "quantity must be greater than 0", most=MAX_INT),
        Check("positive_numeric", "unit_price", "unit_price must be greater than 0"),
        Check("valid_datetime", "order_date", "invalid or unparseable order_date format"),
        Check("referential_integrity", "customer_id", "orphaned customer_id (not in customer master)",
              parent="customers"),
        Check("referential_integrity", "product_id", "orphaned product_id (not in product catalog)",
              parent="products"),
        Check("allowed_values", "order_status", "order_status not in allowed business statuses",
              allowed=tuple(schemas.ORDER_STATUSES)),
        Check("fits_money", "total_amount", "net amount does not fit the money type", reported=False),
    ],
}

# Opt-in: an address must look like one. The default list accepts any non-empty text.
EMAIL_FORMAT = Check("matches", "email", "email is not an address", allowed=(r"^[^@\s]+@[^@\s]+\.[^@\s]+$",))


def not_null(c: Column) -> Column:
    return is_blank(c)


def positive_numeric(c: Column, strict: bool = True, most: float | None = None) -> Column:
    """Fails unless it is a finite number above (or at) zero; ``most`` is the bound of an integer column."""
    value = number(c)
    low = value <= 0 if strict else value < 0
    return F.coalesce(low if most is None else low | (value > most), F.lit(True))


def fits_money(quantity: Column, price: Column, discount: Column) -> Column:
    """Fails when the net amount is known and too large for the money type; other checks judge unknown ones."""
    return F.coalesce(F.abs(net_amount(number(quantity), number(price), number(discount))) >= MONEY_BOUND, F.lit(False))


def valid_datetime(c: Column, formats: Sequence[str] = FORMATS) -> Column:
    return timestamp_of(c, formats).isNull()


def allowed_values(c: Column, allowed: Sequence[str]) -> Column:
    return ~F.coalesce(c.isin(list(allowed)), F.lit(False))


def matches(c: Column, pattern: str) -> Column:
    return ~F.coalesce(c.rlike(pattern), F.lit(False))


def _row_level(check: Check, have: set[str]) -> Column:
    if check.kind == "fits_money":
        return fits_money(*[F.col(n) if n in have else F.lit(None).cast("string") for n in MONEY_PARTS])
    c = F.col(check.column)
    if check.kind == "not_null":
        return not_null(c)
    if check.kind == "positive_numeric":
        return positive_numeric(c, check.strict, check.most)
    if check.kind == "valid_datetime":
        return valid_datetime(c, check.formats)
    if check.kind == "allowed_values":
        return allowed_values(c, check.allowed)
    if check.kind == "matches":
        return matches(c, check.allowed[0])
    raise ValueError(f"unknown rule kind {check.kind!r}")


def flag_name(i: int) -> str:
    return f"{PREFIX}fail_{i}"


def unique(rows: DataFrame, on: Sequence[str], flag: str) -> DataFrame:
    """Every copy of a repeated key fails. ``rows`` carry a row id."""
    return mark_members(rows, repeated_keys(rows, on), on, flag)


def referential_integrity(rows: DataFrame, column: str, parent_keys: DataFrame, flag: str) -> DataFrame:
    """Fails when the key is not among the parent keys; a null key fails. ``parent_keys`` is distinct."""
    marked = mark_members(rows, parent_keys.toDF(column), [column], flag)
    return marked.withColumn(flag, ~F.col(flag))


def failing_keys(rows: DataFrame, keyed: dict[str, Check], parents: dict[str, DataFrame] | None) -> DataFrame:
    """The key tuples that fail a keyed check, each once, with one flag per check. Only key columns move.

    The tuples are counted first; what is looked up, and what is counted per key, are tuples. A null key fails none here.
    """
    keys = list(dict.fromkeys(c.column for c in keyed.values()))
    tuples = rows.select(*keys).groupBy(*keys).agg(F.count(F.lit(1)).alias(COPIES))
    out = with_row_id(tuples)
    for flag, check in keyed.items():
        key = [check.column]
        if check.kind == "unique":
            counted = tuples.where(F.col(check.column).isNotNull()).groupBy(*key).agg(F.sum(COPIES).alias("_n"))
            out = mark_members(out, counted.where("_n > 1"), key, flag)
        else:
            out = mark_members(out, parents[check.parent].toDF(*key), key, flag)
            out = out.withColumn(flag, ~F.col(flag) & F.col(check.column).isNotNull())
    failed = F.lit(False)
    for flag in keyed:
        failed = failed | F.col(flag)
    return out.where(failed).select(*keys, *keyed)


def stored_failing_keys(rows: DataFrame, keyed: dict[str, Check], parents: dict[str, DataFrame] | None) -> DataFrame:
    """What ``failing_keys`` gives, with the failing values of each key column written first.

    Every column is counted on its own, so a foreign key moves as often as it has values. The values that fail are as a rule few; Spark knows
    their size and marks the tuples where they are read.
    """
    keys = list(dict.fromkeys(c.column for c in keyed.values()))
    out = with_row_id(rows).select(*keys, ROW_ID)
    failed = F.lit(False)
    for flag, check in keyed.items():
        key = [check.column]
        if check.kind == "unique":
            bad = repeated_keys(rows, key).select(*key)
        else:
            held = rows.select(*key).where(F.col(check.column).isNotNull()).distinct()
            bad = held.join(parents[check.parent].toDF(*key), key, "left_anti")
        out = mark_members(out, stage(bad, "failing-values"), key, flag)
        failed = failed | F.col(flag)
    return out.where(failed).select(*keys, *keyed).distinct()


def mark_failing(rows: DataFrame, failing: DataFrame, keyed: dict[str, Check]) -> DataFrame:
    """Add the flags of ``failing_keys`` to whole rows (with a row id), which move at most once, and not at all when few keys fail."""
    keys = [c for c in failing.columns if c not in keyed]
    none = F.lit(True)
    for c in keys:
        none = none & F.col(c).isNull()
    # Rows without any key match nothing; they take their row id as partitioning value.
    left = rows.withColumn(SPREAD, F.when(none, F.col(ROW_ID)).otherwise(F.lit(0).cast("long")))
    right = failing.select(*[F.col(c).alias(f"{PREFIX}of_{c}") for c in keys], *keyed, F.lit(0).cast("long").alias(f"{PREFIX}of"))
    on = F.col(SPREAD) == F.col(f"{PREFIX}of")
    for c in keys:
        on = on & F.col(c).eqNullSafe(F.col(f"{PREFIX}of_{c}"))
    flags = {
        f: F.coalesce(F.col(f), F.lit(False)) | (F.col(c.column).isNull() if c.kind == "referential_integrity" else F.lit(False))
        for f, c in keyed.items()
    }
    return left.join(right, on, "left").select(*rows.columns, *[v.alias(f) for f, v in flags.items()])


def flag_rows(
    rows: DataFrame, checks: Sequence[Check], parents: dict[str, DataFrame] | None = None, store: bool = False,
) -> DataFrame:
    """Add one boolean column per check, named by ``flag_name``.

    ``rows`` must come straight from a scan or a staged table; columns with the reserved prefix are refused, but for the row id.
    ``parents`` maps a parent name to its valid keys. Uniqueness and foreign keys are found on the key columns alone; the keys
    that fail come back to the rows in one join. With ``store`` these keys are written first: Spark then knows their size and needs
    no shuffle of the rows when they are few.
    """
    taken = [c for c in rows.columns if c.startswith(PREFIX) and c != ROW_ID]
    if taken:
        raise ValueError(f"column names that begin with {PREFIX!r} are reserved: {taken}")
    have = set(rows.columns)
    simple, keyed = {}, {}
    for i, check in enumerate(checks):
        if check.kind == "fits_money":
            simple[flag_name(i)] = _row_level(check, have)
        elif check.column not in have:
            simple[flag_name(i)] = F.lit(True)
        elif check.kind in KEYED:
            keyed[flag_name(i)] = check
        else:
            simple[flag_name(i)] = _row_level(check, have)

    out = with_row_id(rows).withColumns(simple)
    if not keyed:
        return out
    failing = stage(stored_failing_keys(rows, keyed, parents), "failing") if store else failing_keys(rows, keyed, parents)
    return mark_failing(out, failing, keyed)


def valid_keys(rows: DataFrame, checks: Sequence[Check], key: str) -> DataFrame:
    """The keys of the rows that pass all checks, from one aggregate: a key that repeats fails. ``key`` is the only keyed column."""
    have, failed = set(rows.columns), F.lit(False)
    for check in checks:
        if check.kind not in KEYED:
            failed = failed | (_row_level(check, have) if check.column in have else F.lit(True))
        elif (check.kind, check.column) != ("unique", key):
            raise ValueError(f"not a check of one row or of {key}: {check.name}")
    per_key = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.bool_or(failed).alias("_failed"))
    return per_key.where("_n = 1 AND NOT _failed").select(key)


def any_failed(n: int) -> Column:
    out = F.col(flag_name(0))
    for i in range(1, n):
        out = out | F.col(flag_name(i))
    return out


def _reason_list(checks: Sequence[Check]) -> list[Column]:
    return [F.when(F.col(flag_name(i)), F.lit(c.reason)) for i, c in enumerate(checks)]


def reasons(checks: Sequence[Check]) -> Column:
    """The texts of the failed checks, in check order."""
    return F.array_compact(F.array(*_reason_list(checks)))


def joined_reasons(checks: Sequence[Check]) -> Column:
    return F.concat_ws(" | ", *_reason_list(checks))


def error_message(check: Check, failed: Column, present: bool = True) -> Column:
    """Message recorded with a check's metric."""
    if not present:
        tail = "for foreign key validation" if check.kind == "referential_integrity" else "in dataset"
        return F.lit(f"Missing column '{check.column}' {tail}")
    # Message texts.
    text = {
        "not_null": "Column '%s' has %d NULL/empty values",
        "unique": "Column '%s' has %d duplicate entries",
        "positive_numeric": "Column '%s' has %d non-positive/invalid numeric entries",
        "valid_datetime": "Column '%s' has %d unparseable/invalid date strings",
        "referential_integrity": "Foreign key '%s' has %d orphaned references",
        "allowed_values": "Column '%s' has %d values outside allowed set",
        "matches": "Column '%s' has %d values of another form",
    }[check.kind]
    return F.format_string(text, F.lit(check.column), failed)
