"""The shop's tables, mapped from the parquet tables in a data folder.

``raw_events`` has the columns of the event feed, ``dim_user`` and ``dim_item`` those of
the two dimensions. Attributes of an event come from the event row alone, so the feed
costs one narrow scan and no join; FIXTURES.md lists the expressions.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions import event_day
from tidemart.operators.joins import attach

# Last day of the event table; stands in for "today" so that results do not drift.
AS_OF = dt.date(2024, 1, 30)

# The five steps of the funnel, in order.
STEPS = ("impression", "click", "add_cart", "order", "pay")

# The columns of the event feed, in order.
EVENT_COLUMNS = (
    "event_id", "user_id", "item_id", "action_type", "event_ts", "session_id",
    "amount", "country", "device", "category", "channel",
)


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def source_state(spark: SparkSession, sf_dir: str, table: str) -> tuple:
    """Bytes, files and latest change of a table's files."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{table}.parquet")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    summary, newest = fs.getContentSummary(path), fs.getFileStatus(path).getModificationTime()
    return summary.getLength(), summary.getFileCount(), newest


def as_feed(events: DataFrame) -> DataFrame:
    """Give rows of the ``events`` table (batch or stream) the columns of the feed."""
    ts = F.col("ts").cast("timestamp")
    step = F.expr(
        "CASE event_type WHEN 'view' THEN 'impression' WHEN 'click' THEN 'click' "
        "WHEN 'signup' THEN 'add_cart' WHEN 'error' THEN 'order' WHEN 'purchase' THEN 'pay' END"
    )
    abroad = F.when(F.col("event_id") % 3 == 0, 1).otherwise(0)
    return events.select(
        "event_id",
        "user_id",
        F.from_json("props", "k long")["k"].alias("item_id"),
        step.alias("action_type"),
        F.unix_millis(ts).alias("event_ts"),
        F.concat_ws("-", "user_id", F.to_date(ts).cast("string"), F.hour(ts)).alias("session_id"),
        F.when(F.col("event_type") == "purchase", F.col("value")).alias("amount"),
        F.concat(F.lit("NATION_"), (F.col("user_id") + abroad) % 25).alias("country"),
        F.expr("CASE event_id % 3 WHEN 0 THEN 'iOS' WHEN 1 THEN 'Android' ELSE 'Web' END").alias("device"),
        F.concat(F.lit("CAT_"), F.col("event_id") % 6).alias("category"),
        F.concat(F.lit("CH_"), F.col("user_id") % 5).alias("channel"),
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_feed(load(spark, sf_dir, "events"))


def replayed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed after an at-least-once delivery: every event arrives a second time, one
    second later, and one user's id is lost."""
    raw = raw_events(spark, sf_dir)
    again = raw.withColumn("event_ts", F.col("event_ts") + 1000)
    return raw.unionByName(again).withColumn("user_id", F.nullif("user_id", F.lit(7)))


def arrivals(feed: DataFrame, slow: bool = False) -> DataFrame:
    """Adds the event time and a simulated arrival time: every tenth event comes 10 to 30
    seconds late, or up to two hours if ``slow``."""
    late = F.col("event_id") * 37 % 7200 if slow else 10 + F.col("event_id") % 21
    delay = F.when(F.col("event_id") % 10 == 0, late).otherwise(0)
    ts = F.timestamp_millis("event_ts")
    return feed.withColumn("ts", ts).withColumn(
        "arrival_ts", F.timestamp_millis(F.col("event_ts") + delay * 1000)
    )


def dim_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = load(spark, sf_dir, "customer")
    nation = load(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    region = load(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    located = attach(attach(customer, nation, "c_nationkey"), region, "n_regionkey")
    return located.select(
        F.col("c_custkey").alias("user_id"),
        F.date_add(F.lit(dt.date(2023, 12, 2)), (F.col("c_custkey") % 60).cast("int")).alias("register_date"),
        F.col("n_name").alias("country"),
        F.col("c_mktsegment").alias("channel"),
        F.col("r_name").alias("age_group"),
        (F.col("c_acctbal") >= 0).alias("is_active"),
    )


def dim_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item_id"),
        F.col("p_type").alias("category"),
        F.col("p_name").alias("sub_category"),
        F.col("p_brand").alias("brand"),
        F.col("p_retailprice").alias("price"),
        F.date_add(F.lit(dt.date(2023, 1, 1)), (F.col("p_partkey") % 365).cast("int")).alias("listed_date"),
    )


def ods_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_events(spark, sf_dir).withColumn("dt", event_day("event_ts"))
