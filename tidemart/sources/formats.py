"""Files in and out: Parquet, CSV, JSON Lines, partitioned tables."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemart.session import scratch_dir

# The formats the same rows are kept in; name -> (Spark format, writer options). A gzip
# file cannot be split, so a reader has one task per file: write many files of it.
FORMATS = {
    "csv": ("csv", {"header": "true"}),
    "csv_gz": ("csv", {"header": "true", "compression": "gzip"}),
    "parquet_snappy": ("parquet", {"compression": "snappy"}),
    "parquet_zstd": ("parquet", {"compression": "zstd"}),
}


def write_as(df: DataFrame, name: str, path: str) -> None:
    fmt, options = FORMATS[name]
    df.write.mode("overwrite").format(fmt).options(**options).save(path)


def read_as(spark: SparkSession, name: str, path: str, schema: T.StructType) -> DataFrame:
    """The schema is given, never inferred: inference would read text files twice."""
    fmt, options = FORMATS[name]
    header = {k: v for k, v in options.items() if k == "header"}
    return spark.read.schema(schema).format(fmt).options(**header).load(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def append_partitioned(
    df: DataFrame, path: str, by: str = "dt", mode: str = "append", sort_by: str | None = None
) -> None:
    """Write a table partitioned by ``by``.

    The rebalance hint sends a day to one writer where that gives a good file size, and
    lets adaptive execution split a day that is too big for one. With ``sort_by`` the rows
    of a file are in that order, so that a lookup by it can skip row groups.
    """
    laid_out = df.hint("rebalance", by)
    if sort_by:
        laid_out = laid_out.sortWithinPartitions(by, sort_by)
    writer = laid_out.write.mode(mode).partitionBy(by)
    if sort_by:  # every file spans the whole range of ids: the filter tells which can hold one
        writer = writer.option(f"parquet.bloom.filter.enabled#{sort_by}", "true")
    writer.parquet(path)


def overwrite_partitions(df: DataFrame, path: str, by: str = "dt") -> None:
    """Replace the partitions that ``df`` has rows for; all others stay."""
    (
        df.hint("rebalance", by).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
    )


def replace_days(df: DataFrame, path: str, days: list[dt.date]) -> None:
    """Replace the given days of a table partitioned by ``dt``: a day for which ``df`` has no
    rows is emptied. The rows are written beside the table first, since ``df`` may read it."""
    spark = df.sparkSession
    beside = scratch_dir(spark, "days")
    df.write.parquet(beside)
    rows = spark.read.schema(df.schema).parquet(beside)
    there = {r.dt for r in rows.select("dt").distinct().collect()}  # at most the given days
    overwrite_partitions(rows, path)
    for day in set(days) - there:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/dt={day.isoformat()}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    spark.catalog.refreshByPath(path)


def exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def append_line(spark: SparkSession, rows: list[tuple], schema: str, path: str) -> None:
    """Append a few rows known to the driver, as one file."""
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def rebuild_table(df: DataFrame, name: str, path: str, by: str | None = None) -> DataFrame:
    """Create a catalog table from a DataFrame, or replace the one of that name.

    The rows go to a new folder below ``path`` first; the name moves to it once they are all
    there, so a write that fails leaves the old table as it was.
    """
    spark = df.sparkSession
    folder = f"{path}/{uuid.uuid4().hex}"
    writer = df.write.format("parquet")
    (writer.partitionBy(by) if by else writer).save(folder)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name, folder, "parquet")
    if by:
        spark.catalog.recoverPartitions(name)
    return spark.table(name)
