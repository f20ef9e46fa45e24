"""The quality gate: snapshot the raw batch, flag it once, quarantine, report, decide."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from dqlake import schemas
from dqlake.operators import splits
from dqlake.plans.batch import DATASETS, Flagged, stage_batch
from dqlake.plans.layout import Layout
from dqlake.sources.files import (
    exists, read_csv, read_documents, read_if_there, read_parquet, write_document, write_parquet,
)
from dqlake.sources.headers import CsvFiles

BLOCKED = "BLOCKED_BY_QUALITY_GATE"


@dataclass
class GateResult:
    passed: bool
    summary: Row
    flagged: Flagged


def now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def as_column(at: datetime | None) -> Column:
    return F.lit(now() if at is None else at).cast("timestamp_ntz")


def ingest_csv(
    spark: SparkSession, paths: dict[str, str], layout: Layout, run_id: str, files: dict[str, CsvFiles] | None = None,
) -> dict[str, DataFrame]:
    """Read the raw CSV files and keep them as the run's snapshot. ``files``: what is known of them already."""
    return snapshot({d: read_csv(spark, paths[d], files=files[d] if files else None) for d in DATASETS}, layout, run_id)


def snapshot(raw: dict[str, DataFrame], layout: Layout, run_id: str, keep: bool = False) -> dict[str, DataFrame]:
    """Keep the raw tables under the run id, so that a replay sees the same rows.

    With ``keep`` a snapshot that the run already has stays, and the new rows lie beside it under a name of their own.
    """
    spark = raw["orders"].sparkSession
    kept = run_id
    while keep and exists(spark, layout.raw(kept, "orders")):
        kept += "+"
    for d in DATASETS:
        write_parquet(raw[d], layout.raw(kept, d))
    return read_snapshot(spark, layout, kept)


def judge_frames(raw: dict[str, DataFrame]) -> None:
    """Stop before validation when a batch lacks a required column."""
    for d in DATASETS:
        missing = sorted(set(schemas.BASELINE[d]["required"]) - set(raw[d].columns))
        if missing:
            raise ValueError(f"breaking schema change in {d}: a required column is missing: {missing}")


def read_snapshot(spark: SparkSession, layout: Layout, run_id: str) -> dict[str, DataFrame]:
    return {d: read_parquet(spark, layout.raw(run_id, d)) for d in DATASETS}


def read_history(spark: SparkSession, layout: Layout, dataset: str) -> DataFrame:
    """The kept raw rows of all runs as one table with ``run_id``; a column that a run did not have is null in its rows."""
    reader = spark.read.option("mergeSchema", True).option("basePath", f"{layout.root}/raw")
    return reader.parquet(f"{layout.root}/raw/*/{dataset}")


def run_summary(
    flagged: Flagged, run_id: str, threshold: float | None, start: datetime, end: datetime
) -> DataFrame:
    """The run's one-row report with its checks as a nested list."""
    metric_rows = flagged.metrics()
    names = schemas.METRIC.fieldNames()
    nested = metric_rows.agg(F.sort_array(F.collect_list(F.struct("seq", *names))).alias("m")).select(
        F.transform("m", lambda e: F.struct(*[e[n].alias(n) for n in names])).alias("metrics")
    )
    return splits.score(flagged.all_totals(), threshold).select(
        F.lit(run_id).alias("run_id"),
        F.lit(start.isoformat()).alias("start_time"),
        F.lit(end.isoformat()).alias("end_time"),
        F.lit((end - start).total_seconds()).alias("duration_seconds"),
        "status", "total_records_ingested", "total_records_valid", "total_records_quarantined",
        "overall_quality_score", "quality_threshold",
        nested.scalar().alias("metrics"),
    )


def evaluate_batch(
    raw: dict[str, DataFrame],
    layout: Layout,
    run_id: str,
    threshold: float | None = None,
    at: datetime | None = None,
) -> GateResult:
    """Flag the batch, write quarantine and report whatever the verdict, and return it.

    ``raw`` are scans or staged tables. Only the one-row report comes to the driver.
    """
    spark = raw["orders"].sparkSession
    start = now() if at is None else at
    flagged = stage_batch(raw, layout.flagged(run_id))
    for d in DATASETS:
        records = splits.quarantine_records(flagged[d], d, run_id, as_column(start))
        write_parquet(records.drop("run_id"), layout.quarantine(d, run_id))
    end = now() if at is None else at
    write_document(run_summary(flagged, run_id, threshold, start, end), layout.report(run_id))
    summary = read_documents(spark, layout.report(run_id), schemas.REPORT).first()
    return GateResult(summary["status"] == "SUCCESS", summary, flagged)


def read_quarantine(spark: SparkSession, layout: Layout, dataset: str, run_id: str) -> DataFrame:
    """The run's records of a dataset with the columns they were stored with; empty for a run that never got here."""
    columns = ", ".join(
        ["quarantine_id string", "dataset string", "quarantine_timestamp timestamp_ntz", "error_reasons string"]
        + [f"{c} string" for c in schemas.RAW[dataset].fieldNames()]
    )
    records = read_if_there(spark, layout.quarantine(dataset, run_id), columns, stored_schema=True)
    return records.withColumn("run_id", F.lit(run_id))


def quarantine_page(records: DataFrame, limit: int = 50) -> tuple[int, DataFrame]:
    """Total and the first ``limit`` records."""
    if not 1 <= limit <= 500:
        raise ValueError("limit must be between 1 and 500")
    return records.count(), records.orderBy("quarantine_id").limit(limit)
