"""Row-level operators: one row per key, latest-wins dimension updates, first-seen keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """Keep the first row per key in ``order_by`` order, the other columns breaking ties.

    ``row_number() = 1`` becomes a WindowGroupLimit below the shuffle: a task sends at most
    one row per key, so a key with very many copies does not fill one partition.
    """
    named = {c for c in order_by if isinstance(c, str)} | set(keys)
    ties = [F.col(c) for c in df.columns if c not in named]
    w = Window.partitionBy(*keys).orderBy(*order_by, *ties)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def upsert_latest(dim: DataFrame, updates: DataFrame, key: str, order_by: str) -> DataFrame:
    """Type-1 update: an update replaces the dimension row with its key, new keys are added.

    Several updates of one key are settled by the highest ``order_by``, which the
    dimension itself does not have.
    """
    columns = dim.columns
    old = dim.withColumn("_fresh", F.lit(0)).withColumn("_order", F.lit(None))
    new = updates.withColumn("_fresh", F.lit(1)).withColumn("_order", F.col(order_by)).drop(order_by)
    both = new.unionByName(old.withColumn("_order", F.col("_order").cast(new.schema["_order"].dataType)))
    return dedup(both, [key], [F.desc("_fresh"), F.desc("_order")]).select(columns)


def first_seen(df: DataFrame, key: str, value: str, order_by: Sequence[str]) -> DataFrame:
    """Distinct keys with the value of their first row; combines before the shuffle."""
    return df.groupBy(key).agg(F.min_by(value, F.struct(*order_by)).alias(value))
