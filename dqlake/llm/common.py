"""What the operators share: table reads, halfway tables in the shared folder, free column names.

Halfway tables are Parquet files below the folder named by ``spark.checkpoint.dir``, so a lost executor costs one task.
A halfway table that only feeds the next one is removed by ``release`` as soon as that is written; those a returned
plan still reads stay until ``release_all`` (called when the program ends) or the caller removes them.
"""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_written: dict[str, SparkSession] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new path below the session's shared folder."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise ValueError("spark.checkpoint.dir is not set: name a folder that all executors share")
    return f"{root.rstrip('/')}/llm/{label}-{uuid.uuid4().hex}"


CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` and return it read back; ``release`` takes the returned frame.

    What the write shuffled is removed when it ends, instead of when the driver next collects its garbage.
    """
    spark = df.sparkSession
    path = shared_folder(spark, label)
    before = spark.conf.get(CLEAN)
    spark.conf.set(CLEAN, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEAN, before)
    _written[path] = spark
    back = spark.read.schema(df.schema).parquet(path)
    back.staged_at = path
    return back


def delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def release(*staged: DataFrame) -> None:
    """Remove halfway tables that nothing reads any more."""
    for df in staged:
        path = df.staged_at
        delete(df.sparkSession, path)
        _written.pop(path, None)


@atexit.register
def release_all() -> None:
    """Remove every halfway table of this program; plans that read them end with it."""
    for path, spark in list(_written.items()):
        _written.pop(path)
        if spark.sparkContext._jsc is not None:
            delete(spark, path)


def free(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not use (Spark compares names without case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def tasks(spark: SparkSession) -> int:
    """Partitions that a shuffle makes in this session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def hex_digits(value: Column, digits: int) -> Column:
    """The first hex digits of the MD5 of a text, as a long (at most 15 digits)."""
    return F.conv(F.substring(F.md5(value), 1, digits), 16, 10).cast("long")
