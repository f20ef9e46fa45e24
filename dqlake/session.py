"""Session settings the plans are written for. The caller owns the session; these can be changed while it runs."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # The JVM does not compile methods above 8000 bytes. A fused stage that large would run interpreted, several times
    # slower; below the limit Spark generates smaller pieces instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
