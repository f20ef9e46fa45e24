"""What follows from flagged rows: valid rows, quarantine records, metrics, score."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, functions as F

from dqlake import schemas
from dqlake.functions import percent
from dqlake.operators.keyed import PREFIX, ROW_ID
from dqlake.operators.numbering import number_rows
from dqlake.operators.rules import (
    CHECKS, Check, any_failed, error_message, flag_name, joined_reasons, reasons,
)

# Declared limits, reported next to the checks; they do not decide the verdict.
MAX_DUPLICATE_RATE = 0.02
MAX_NULL_KEY_RATE = 0.0
DEFAULT_THRESHOLD = 95.0


def _flags(flagged: DataFrame) -> list[str]:
    return [c for c in flagged.columns if c.startswith(f"{PREFIX}fail_")]


def _raw_columns(flagged: DataFrame) -> list[str]:
    return [c for c in flagged.columns if not c.startswith(PREFIX)]


def valid_rows(flagged: DataFrame) -> DataFrame:
    return flagged.where(~any_failed(len(_flags(flagged)))).select(*_raw_columns(flagged))


def failed_rows(flagged: DataFrame) -> DataFrame:
    return flagged.where(any_failed(len(_flags(flagged))))


def quarantine_records(
    flagged: DataFrame, dataset: str, run_id: str, at: Column | None = None, checks: Sequence[Check] | None = None
) -> DataFrame:
    """Failing rows with id, run, dataset, time and joined reasons ahead of the raw columns.

    Numbered by business key, then the other raw columns; copies are told apart by their row id.
    """
    checks = CHECKS[dataset] if checks is None else checks
    raw = _raw_columns(flagged)
    failed = failed_rows(flagged).select(*raw, ROW_ID, joined_reasons(checks).alias("error_reasons"))
    order = [F.col(c).asc_nulls_first() for c in raw] + [F.col(ROW_ID)]
    numbered = number_rows(failed, order, "_n")
    at = F.lit(datetime.now(timezone.utc).replace(tzinfo=None)).cast("timestamp_ntz") if at is None else at
    return numbered.select(
        F.format_string("Q-%s-%s-%05d", F.lit(run_id), F.lit(dataset), "_n").alias("quarantine_id"),
        F.lit(run_id).alias("run_id"),
        F.lit(dataset).alias("dataset"),
        at.alias("quarantine_timestamp"),
        "error_reasons",
        *raw,
    )


def quarantine_audit(records: DataFrame) -> DataFrame:
    """Records of any dataset in one layout: the raw row becomes a JSON text."""
    lead = ["quarantine_id", "run_id", "dataset", "quarantine_timestamp", "error_reasons"]
    raw = F.struct(*[c for c in records.columns if c not in lead])
    return records.select(
        "quarantine_id", "run_id", "dataset", "error_reasons",
        F.to_json(raw, {"ignoreNullFields": "false"}).alias("raw_record"),
        "quarantine_timestamp",
        F.lit(False).alias("is_resolved"),
    )


def totals(flagged: DataFrame, dataset: str, checks: Sequence[Check]) -> DataFrame:
    """One row: ingested, valid and failed-per-check counts of a dataset."""
    return flagged.agg(
        F.count(F.lit(1)).alias("ingested"),
        F.count_if(~any_failed(len(checks))).alias("valid"),
        *[F.count_if(flag_name(i)).alias(flag_name(i)) for i in range(len(checks))],
    ).withColumn("dataset", F.lit(dataset))


def metrics(total: DataFrame, checks: Sequence[Check], columns: Sequence[str]) -> DataFrame:
    """The one-row totals turned into one row per check."""
    def row(i: int, check: Check) -> Column:
        failed = F.col(flag_name(i))
        return F.struct(
            F.lit(i).alias("seq"),
            F.lit(check.name).alias("check_name"),
            F.col("dataset"),
            F.when(failed == 0, "PASSED").otherwise("FAILED").alias("status"),
            F.col("ingested").alias("records_checked"),
            (F.col("ingested") - failed).alias("records_passed"),
            failed.alias("records_failed"),
            percent(F.col("ingested") - failed, F.col("ingested")).alias("pass_rate"),
            F.lit(check.threshold).alias("threshold"),
            error_message(check, failed, check.column in columns).alias("details"),
        )

    return total.select(F.explode(F.array(*[row(i, c) for i, c in enumerate(checks) if c.reported])).alias("m")).select("m.*")


def rate_limits(total: DataFrame, dataset: str, checks: Sequence[Check]) -> DataFrame:
    """Duplicate and null-key rates of the business key against the declared limits."""
    key = schemas.BUSINESS_KEY[dataset]
    limits = {f"unique:{key}": ("duplicate_rate", MAX_DUPLICATE_RATE),
              f"not_null:{key}": ("null_key_rate", MAX_NULL_KEY_RATE)}
    rows = []
    for i, check in enumerate(checks):
        if check.name in limits:
            name, limit = limits[check.name]
            rate = F.when(F.col("ingested") > 0, F.col(flag_name(i)) / F.col("ingested")).otherwise(F.lit(0.0))
            rows.append(F.struct(
                F.col("dataset"), F.lit(name).alias("rate_name"), rate.alias("rate"), F.lit(limit).alias("rate_limit"),
                (rate <= limit).alias("within_limit"),
            ))
    return total.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def score(all_totals: DataFrame, threshold: float | None = None) -> DataFrame:
    """One row: totals over the datasets, the score and the verdict. A threshold of 0 is a threshold."""
    threshold = DEFAULT_THRESHOLD if threshold is None else threshold
    summed = all_totals.agg(F.sum("ingested").alias("total_records_ingested"),
                            F.sum("valid").alias("total_records_valid"))
    out = summed.select(
        "*",
        (F.col("total_records_ingested") - F.col("total_records_valid")).alias("total_records_quarantined"),
        percent(F.col("total_records_valid"), F.col("total_records_ingested")).alias("overall_quality_score"),
        F.lit(float(threshold)).alias("quality_threshold"),
    )
    return out.withColumn(
        "status",
        F.when(F.col("overall_quality_score") >= F.col("quality_threshold"), "SUCCESS")
        .otherwise("FAILED_QUALITY_GATE"),
    )


def failure_breakdown(metric_rows: DataFrame) -> DataFrame:
    """Failed checks per dataset by family: duplicates, missing, invalid."""
    kind = F.split("check_name", ":")[0]
    family = (
        F.when(kind == "unique", "duplicate").when(kind == "not_null", "missing").otherwise("invalid")
    )
    return metric_rows.groupBy("dataset", family.alias("family")).agg(F.sum("records_failed").alias("failures"))


def reason_counts(flagged: DataFrame, dataset: str, checks: Sequence[Check]) -> DataFrame:
    """Rows per reason text."""
    return (
        failed_rows(flagged).select(F.explode(reasons(checks)).alias("reason"))
        .groupBy("reason").agg(F.count(F.lit(1)).alias("failures"))
        .select(F.lit(dataset).alias("dataset"), "reason", "failures")
    )
