"""The whole path of a batch, and its replay from the kept raw snapshot."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from dqlake.operators.splits import DEFAULT_THRESHOLD
from dqlake.plans import evolution, warehouse
from dqlake.plans.batch import DATASETS
from dqlake.plans.gate import BLOCKED, evaluate_batch, ingest_csv, judge_frames, read_snapshot, snapshot
from dqlake.plans.lake import publish_if_passed
from dqlake.plans.layout import Layout
from dqlake.session import prepare
from dqlake.sources.headers import csv_files


def run_batch(
    raw: dict[str, DataFrame],
    root: str,
    run_id: str,
    threshold: float = DEFAULT_THRESHOLD,
    at: datetime | None = None,
) -> dict:
    """Snapshot, gate, lake, star schema. Below the threshold it stops after quarantine and report."""
    layout = Layout(root)
    judge_frames(raw)
    return _from_gate(snapshot(raw, layout, run_id), layout, run_id, threshold, at)


def run_files(
    spark: SparkSession, paths: dict[str, str], root: str, run_id: str, threshold: float = DEFAULT_THRESHOLD,
    at: datetime | None = None,
) -> dict:
    """``run_batch`` over raw CSV files; halts when one lacks a required column.

    Quoted values may hold line breaks. A file is read once for its header and once for its rows.
    """
    files = {d: csv_files(spark, paths[d]) for d in DATASETS}
    for d in DATASETS:
        if evolution.must_halt(evolution.header_drift(files[d].headers, d)):
            raise ValueError(f"breaking schema change in {d}: a required column is missing")
    layout = Layout(root)
    return _from_gate(ingest_csv(spark, paths, layout, run_id, files), layout, run_id, threshold, at)


def replay(
    spark: SparkSession,
    root: str,
    run_id: str,
    source_run: str | None = None,
    raw: dict[str, DataFrame] | None = None,
    threshold: float = DEFAULT_THRESHOLD,
    at: datetime | None = None,
) -> dict:
    """Start again at validation, from a kept run's raw rows (``source_run``, by default the same run) or given ones.

    Given rows never replace the snapshot that a run has kept.
    """
    layout = Layout(root)
    rows = read_snapshot(spark, layout, source_run or run_id) if raw is None else snapshot(raw, layout, run_id, keep=True)
    judge_frames(rows)
    out = _from_gate(rows, layout, run_id, threshold, at)
    return {**out, "checkpoint": "VALIDATION"}


def _from_gate(
    raw: dict[str, DataFrame], layout: Layout, run_id: str, threshold: float, at: datetime | None,
) -> dict:
    spark = prepare(raw["orders"].sparkSession)
    result = evaluate_batch(raw, layout, run_id, threshold, at)
    s = result.summary
    out = {
        "run_id": run_id,
        "status": "SUCCESS" if result.passed else BLOCKED,
        "quality_score": s["overall_quality_score"],
        "threshold": s["quality_threshold"],
        "total_ingested": s["total_records_ingested"],
        "total_valid": s["total_records_valid"],
        "total_quarantined": s["total_records_quarantined"],
        "orders_processed": None,
        "partitions_created": None,
        "load_stats": None,
    }
    if not result.passed:
        return out
    manifest = publish_if_passed(result, layout, run_id, at=at).first()
    out["orders_processed"] = manifest["records_processed"]["orders"]
    out["partitions_created"] = manifest["partitions_created"]
    out["load_stats"] = warehouse.load(spark, layout, run_id, at)
    return out
