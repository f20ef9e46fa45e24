"""Schema drift of incoming batches against the baseline, by column name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dqlake.schemas import BASELINE
from dqlake.sources.headers import csv_headers

REPORT_COLUMNS = [
    "dataset", "verdict", "action", "baseline_columns", "incoming_columns", "added_columns", "removed_columns",
    "missing_required_columns", "message",
]


def _names(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in sorted(values)])


def _listed(c: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(c, ", "), F.lit("]"))


def judge(headers: DataFrame, dataset: str) -> DataFrame:
    """Add the drift report to rows that carry a ``columns`` array."""
    if dataset not in BASELINE:
        raise ValueError(f"unknown dataset {dataset!r} for a schema check")
    base = BASELINE[dataset]
    known = _names(base["required"] + base["optional"])
    out = headers.withColumns({
        "dataset": F.lit(dataset),
        "baseline_columns": known,
        "incoming_columns": F.array_sort(F.array_distinct("columns")),
    }).withColumns({
        "added_columns": F.array_except("incoming_columns", "baseline_columns"),
        "removed_columns": F.array_except("baseline_columns", "incoming_columns"),
        "missing_required_columns": F.array_except(_names(base["required"]), "incoming_columns"),
    })
    missing, added, removed = (F.col(c) for c in ("missing_required_columns", "added_columns", "removed_columns"))
    breaking, extended, reduced = F.size(missing) > 0, F.size(added) > 0, F.size(removed) > 0
    return out.withColumns({
        "verdict": F.when(breaking, "BREAKING_CHANGE").when(extended | reduced, "COMPATIBLE_EXTENSION")
        .otherwise("NO_CHANGE"),
        "action": F.when(breaking, "HALT").otherwise("CONTINUE"),
        "message": F.when(breaking, F.concat(F.lit("Missing required columns: "), _listed(missing)))
        .when(extended, F.concat(F.lit("Added columns, null where absent: "), _listed(added)))
        .when(reduced, F.concat(F.lit("Optional columns dropped: "), _listed(removed)))
        .otherwise(F.lit("Columns match the baseline")),
    })


def file_drift(spark: SparkSession, path: str, dataset: str) -> DataFrame:
    """One report row per CSV file below ``path``."""
    return header_drift(csv_headers(spark, path), dataset)


def header_drift(headers: DataFrame, dataset: str) -> DataFrame:
    """One report row per file whose header is known."""
    return judge(headers, dataset).select("path", *REPORT_COLUMNS)


def frame_drift(df: DataFrame, dataset: str) -> DataFrame:
    """The report of a table whose schema is known, such as a Parquet batch; reads no data."""
    header = df.sparkSession.range(1).select(F.array(*[F.lit(c) for c in df.columns]).alias("columns"))
    return judge(header, dataset).select(*REPORT_COLUMNS)


def must_halt(report: DataFrame) -> bool:
    return not report.where(F.col("action") == "HALT").isEmpty()


def extend(old: DataFrame, new: DataFrame) -> DataFrame:
    """Batches with and without the added columns as one table."""
    return old.unionByName(new, allowMissingColumns=True)
