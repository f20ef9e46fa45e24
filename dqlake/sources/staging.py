"""Tables written half-way, so that a plan is computed once and a lost executor does not lose it.

They go to the shared folder named by ``spark.checkpoint.dir``; every executor must see it.
"""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

RUN = uuid.uuid4().hex  # all halfway tables of a program lie in one folder, which goes when the program ends
_folders: dict[str, SparkSession] = {}


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder path for this use under the session's shared folder."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise ValueError("spark.checkpoint.dir is not set: name a folder that all executors share")
    folder = f"{root.rstrip('/')}/dqlake/run-{RUN}"
    _folders[folder] = spark
    return f"{folder}/{label}-{uuid.uuid4().hex}"


@atexit.register
def remove_halfway_tables() -> None:
    """Remove the folders this program wrote to. Plans that read from them end with it; a stopped session leaves them."""
    for folder, spark in list(_folders.items()):
        _folders.pop(folder)
        if spark.sparkContext._jsc is not None:
            target = spark._jvm.org.apache.hadoop.fs.Path(folder)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def stage(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet and return the table read back; its size is then known to the optimizer."""
    spark = df.sparkSession
    path = path or shared_folder(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
