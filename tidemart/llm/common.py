"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.session import scratch_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: With this set, a write's shuffle files go when it ends.
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: later steps neither repeat the
    work nor depend on the executors that did it, and its shuffle files need not be kept."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    before = spark.conf.get(_CLEAN_UP)
    spark.conf.set(_CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def width(spark: SparkSession) -> int:
    """Number of shuffle partitions the cluster is set to."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def held_out(doc_id: Column) -> Column:
    """The fifth of all documents that no model learns from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


_kept: dict[tuple, object] = {}


def kept(key: tuple, make: Callable):
    """What a worker remembers from task to task (words it has met, a loaded tokenizer). Only the
    latest is held: the next operator's takes its place, so that memory does not add up."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def map_rows(df: DataFrame, fn: Callable, keep: int) -> DataFrame:
    """``mapInArrow`` whose function returns the first ``keep`` columns of its batches. Columns
    go by position there, so that no name in ``df`` matters."""
    fields = [T.StructField(f"c{i}", f.dataType) for i, f in enumerate(df.schema.fields[:keep])]
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.mapInArrow(fn, T.StructType(fields)).toDF(*df.columns[:keep])


def named(df: DataFrame, alias: str) -> list[Column]:
    """All columns of ``df`` where it is known as ``alias``."""
    return [F.col(f"{alias}.`{c}`") for c in df.columns]


def slices(n: int, size: int) -> Iterator[tuple[int, int]]:
    for a in range(0, n, size):
        yield a, min(n, a + size)
