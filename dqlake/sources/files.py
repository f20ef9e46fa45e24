"""File sources and sinks: CSV with all-text columns, Parquet, JSON documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from dqlake.sources.headers import CsvFiles, csv_files, csv_lines

# Texts that a CSV reader takes as null.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def null_tokens(df: DataFrame) -> DataFrame:
    """Texts that stand for null become null, in every column."""
    return df.select(*[F.when(~F.col(c).isin(NULL_TOKENS), F.col(c)).alias(c) for c in df.columns])


def read_csv(spark: SparkSession, path: str | list[str], multiline: bool | None = None, files: CsvFiles | None = None) -> DataFrame:
    """CSV files of one or several folders as one table of texts, columns matched by name in every file.

    A column that a file lacks is null in its rows; columns that only some files have are kept. The headers alone come to the
    driver, each distinct one once. Records are parsed to as many texts as the longest header has names and then named by the
    header of their file; a record equal to its file's header is no row, nor is an empty line. Quoted values may hold line breaks,
    in files of any header and size; a quote that is never closed is an error. ``multiline`` and ``files``: what ``csv_files``
    should not find out, or has found out already.
    """
    files = csv_files(spark, path, multiline) if files is None else files
    known = [r[0] for r in files.headers.select("columns").distinct().collect()]
    names = sorted({c for columns in known for c in columns}, key=lambda n: min((h.index(n), h) for h in known if n in h))
    if not names:
        return spark.createDataFrame([], T.StructType([]))
    widest = max(map(len, known))
    records = csv_lines(spark, path).select("path", F.col("line").alias("record")) if files.records is None else files.records
    records = records.join(files.headers.withColumnRenamed("path", "_of"), F.col("path") == F.col("_of"))
    records = records.where((F.col("record") != F.col("header")) & (F.length("record") > 0))
    cells = F.from_csv("record", ", ".join(f"c{i} string" for i in range(widest)), {"escape": '"', "maxCharsPerColumn": "-1"})
    parsed = records.select("columns", cells.alias("cells"))
    values = parsed.select("columns", F.array(*[f"cells.c{i}" for i in range(widest)]).alias("values"))
    place = {n: F.array_position("columns", F.lit(n)) for n in names}
    return null_tokens(values.select(*[F.when(place[n] > 0, F.get("values", (place[n] - 1).cast("int"))).alias(n) for n in names]))


def read_csv_batches(spark: SparkSession, path: str, multiline: bool | None = None) -> DataFrame:
    """A folder whose files need not share a header."""
    return read_csv(spark, path, multiline)


def write_csv(df: DataFrame, path: str) -> None:
    (
        df.write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    )


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, partition_cols: Sequence[str] = (), touched_only: bool = False) -> None:
    """Replace the whole folder, or with ``touched_only`` just the partitions that occur in ``df``."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if touched_only else "static")
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.parquet(path)


def write_document(df: DataFrame, path: str) -> None:
    """One JSON document: ``df`` has one row."""
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_documents(spark: SparkSession, folder: str, schema: T.StructType, name: str = "*.json") -> DataFrame:
    """All JSON documents below a folder whose file name fits; empty when the folder is not there."""
    return read_if_there(spark, folder, schema, "json", recursiveFileLookup=True, pathGlobFilter=name)


def empty_table(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    """No rows of this schema, in a form the optimizer sees through: joins with it vanish from the plan."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    columns = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema)
    return spark.sql(f"SELECT {columns} WHERE false")


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def read_if_there(
    spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet", stored_schema: bool = False,
    **options: object,
) -> DataFrame:
    """The table at ``path``, or an empty one when the path does not exist yet. ``stored_schema`` takes that of the files."""
    try:
        reader = spark.read if stored_schema else spark.read.schema(schema)
        return reader.options(**options).format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty_table(spark, schema)
