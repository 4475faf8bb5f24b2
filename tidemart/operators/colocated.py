"""Tables stored for a join that is asked for again and again.

A fact and a large dimension are both stored in the same number of buckets by their join key, sorted
within a bucket. Spark joins such tables bucket by bucket: neither side is shuffled, however often
they are joined, and what is grouped by the key afterwards is not shuffled either.

A bucket is one task, so a key with a large share of all rows must not be in one: rows of hot keys
(of which there are at most 1 / HOT_SHARE) lie in a table of their own, which is read in pieces of any size
and joined with its few dimension rows by broadcast. Rows without a key match nothing and lie there too.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.operators.joins import hot_keys, source_bytes

#: Bytes of source files that one bucket is made for.
BUCKET_BYTES = 256 * 1024 * 1024


@dataclass(frozen=True)
class Colocated:
    """Names of the stored tables, in the session's catalog, and their key."""

    fact: str
    hot: str
    dim: str
    key: str


def store(fact: DataFrame, dim: DataFrame, key: str, name: str, folder: str, buckets: int | None = None) -> Colocated:
    """Store ``fact`` and ``dim`` (unique on ``key``) below ``folder``; ``name`` begins the table names."""
    spark = fact.sparkSession
    n = buckets or max(math.ceil(source_bytes(fact) / BUCKET_BYTES), int(spark.conf.get("spark.sql.shuffle.partitions")))
    hot = hot_keys(fact, [key]).where(F.col(key).isNotNull()).write
    hot.parquet(f"{folder}/hot_keys")
    keys = F.broadcast(spark.read.parquet(f"{folder}/hot_keys"))
    apart = fact.join(keys, key, "left_semi").unionByName(fact.where(F.col(key).isNull()))
    tables = Colocated(f"{name}_fact", f"{name}_hot", f"{name}_dim", key)
    _bucketed(fact.where(F.col(key).isNotNull()).join(keys, key, "left_anti"), tables.fact, key, n, folder)
    _bucketed(dim.where(F.col(key).isNotNull()), tables.dim, key, n, folder)
    spark.sql(f"DROP TABLE IF EXISTS {tables.hot}")
    apart.select(*fact.columns).write.option("path", f"{folder}/{tables.hot}").saveAsTable(tables.hot)
    return tables


def _bucketed(df: DataFrame, table: str, key: str, buckets: int, folder: str) -> None:
    """One sorted file per bucket."""
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {table}")
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", f"{folder}/{table}").saveAsTable(table)


def read(spark: SparkSession, tables: Colocated, columns: list[str]) -> DataFrame:
    """The whole fact, hot rows included."""
    return spark.table(tables.fact).select(*columns).unionByName(spark.table(tables.hot).select(*columns))


def parts(spark: SparkSession, tables: Colocated, fact: list[str], dim: list[str], how: str = "inner") -> tuple[DataFrame, DataFrame]:
    """The join of both tables (``how``: inner or left) in two parts that share no key: all ordinary
    keys, still in their buckets, and the hot ones. Whatever is grouped by the key can be grouped
    in each part alone."""
    attributes = spark.table(tables.dim).select(tables.key, *dim)
    usual = spark.table(tables.fact).select(*fact).join(attributes.hint("merge"), tables.key, how)
    hot = spark.table(tables.hot).select(*fact)
    few = attributes.join(F.broadcast(hot.select(tables.key).distinct()), tables.key, "left_semi")
    return usual, hot.join(F.broadcast(few), tables.key, how)
