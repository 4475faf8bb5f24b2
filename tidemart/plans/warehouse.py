"""The four layers: ODS (events as delivered) -> DWD (clean detail) -> DWS (user days) and
ADS (funnel). Every layer is a pure function of DataFrames; ``run_layers`` stores them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions import event_day, pct, value_when, zero_if_null
from tidemart.operators.aggregates import funnel_uv
from tidemart.operators.joins import attach
from tidemart.operators.rows import dedup
from tidemart.operators.sketches import sketch_users
from tidemart.sources import formats
from tidemart.sources.views import EVENT_COLUMNS, STEPS


# The columns of the clean detail, in order.
DWD_COLUMNS = (
    "event_id", "user_id", "item_id", "action_type", "event_ts", "session_id", "amount",
    "country", "device", "item_category", "item_brand", "user_channel", "age_group", "dt",
)


def build_ods(raw: DataFrame, exact_money: bool = False) -> DataFrame:
    """Events as delivered plus the partition day.

    With ``exact_money`` amounts become DECIMAL(18,2) here and in every later layer; sums of
    doubles differ in their last bits with the order in which tasks finish.
    """
    ods = raw.select(*EVENT_COLUMNS, event_day("event_ts").alias("dt"))
    return ods.withColumn("amount", F.col("amount").cast("decimal(18,2)")) if exact_money else ods


def build_dwd(ods: DataFrame, dim_user: DataFrame, dim_item: DataFrame, limit: int | None = None) -> DataFrame:
    """Clean detail: events without a user removed, one row per event, dimensions added.

    Country and day come from the event, category and brand from the item, channel and age
    group from the user. Copies are removed before the joins (dimension keys are unique,
    so the answer is the same) and the earliest copy stays.
    """
    users = dim_user.select("user_id", F.col("channel").alias("user_channel"), "age_group")
    items = dim_item.select("item_id", F.col("category").alias("item_category"), F.col("brand").alias("item_brand"))
    enriched = attach(attach(clean_events(ods), users, "user_id", "left", limit), items, "item_id", "left", limit)
    return enriched.select(*DWD_COLUMNS)


def clean_events(ods: DataFrame) -> DataFrame:
    """One row per event, those without a user removed, before any dimension."""
    return dedup(ods.where(F.col("user_id").isNotNull()).drop("category", "channel"), ["event_id"], ["event_ts", "user_id"])


def build_dws(dwd: DataFrame) -> DataFrame:
    """One row per user, day and country of the event.

    The one distinct count makes Spark group by session first, map side included, so a very
    busy user is reduced inside each task and then spread by session.
    """
    return _daily_counts(dwd, ["user_id", "dt", "country"], F.countDistinct("session_id").alias("session_cnt"))


def build_item_daily(dwd: DataFrame) -> DataFrame:
    """One row per item and day with the same counters as the user table."""
    return _daily_counts(dwd, ["item_id", "dt"], F.countDistinct("user_id").alias("user_cnt"))


def _daily_counts(dwd: DataFrame, keys: list[str], distinct: Column) -> DataFrame:
    steps = [F.sum(value_when("action_type", s, F.lit(1), 0)).alias(f"{s}_cnt") for s in STEPS]
    return dwd.groupBy(*keys).agg(*steps, zero_if_null(F.sum("amount")).alias("pay_amount"), distinct)


def build_ads(dwd: DataFrame, two_step: bool = True) -> DataFrame:
    """Daily funnel by country and item category: users per step and paid amount."""
    category = dwd.withColumnRenamed("item_category", "category")
    return funnel_uv(category, ["dt", "country", "category"], STEPS, two_step=two_step)


def build_uv_sketches(dwd: DataFrame) -> DataFrame:
    """Sketches of the users per day, country and step, to be merged over any span of days."""
    return sketch_users(dwd, ["dt", "country", "action_type"])


def funnel_report(ads: DataFrame, n: int | None = 15) -> DataFrame:
    """The newest days by country. Users are summed over categories, so somebody active in
    two categories counts twice; ``n=None`` gives all rows, unordered."""
    report = ads.groupBy("dt", "country").agg(
        F.sum("impression_uv").alias("imp_uv"),
        F.sum("click_uv").alias("clk_uv"),
        F.sum("pay_uv").alias("pay_uv"),
        pct(F.sum("pay_uv"), F.sum("impression_uv")).alias("imp_to_pay_pct"),
        F.round(F.sum("gmv"), 2).alias("gmv"),
    )
    if n is None:
        return report
    return report.orderBy(F.desc("dt"), F.desc("gmv"), F.asc("country")).limit(n)


# Column that orders the rows of a stored file, where lookups by it are common.
SORTED_BY = {"ods_events": "event_id", "dwd_user_action": "event_id"}


def store(spark: SparkSession, df: DataFrame, out: str, table: str) -> DataFrame:
    """Replace a day-partitioned layer table and return it as stored."""
    formats.append_partitioned(df, f"{out}/{table}", mode="overwrite", sort_by=SORTED_BY.get(table))
    return spark.read.schema(df.schema).parquet(f"{out}/{table}").select(*df.columns)


def run_layers(
    spark: SparkSession, raw: DataFrame, dim_user: DataFrame, dim_item: DataFrame, out: str
) -> dict[str, DataFrame]:
    """Store every layer below ``out``, partitioned by day, and return the stored tables.

    Each layer is read back from its table, so DWS and ADS share one stored DWD. Running
    it again with the same ``out`` replaces the tables.
    """
    ods = store(spark, build_ods(raw), out, "ods_events")
    dwd = store(spark, build_dwd(ods, dim_user, dim_item), out, "dwd_user_action")
    return {
        "ods_events": ods,
        "dwd_user_action": dwd,
        "dws_user_daily": store(spark, build_dws(dwd), out, "dws_user_daily"),
        "ads_funnel_daily": store(spark, build_ads(dwd), out, "ads_funnel_daily"),
    }


def backfill(
    spark: SparkSession, dim_user: DataFrame, dim_item: DataFrame, out: str, first: dt.date, last: dt.date
) -> None:
    """Compute the days from ``first`` to ``last`` again from the stored ODS."""
    refresh_days(spark, dim_user, dim_item, out, [first + dt.timedelta(n) for n in range((last - first).days + 1)])


def increment(spark: SparkSession, raw: DataFrame, dim_user: DataFrame, dim_item: DataFrame, out: str) -> list[dt.date]:
    """Add a delivery to the stored ODS and refresh the days it touches, which are returned. A
    delivery that comes twice adds copies to ODS and nothing to the layers behind it."""
    ods = build_ods(raw)
    days = sorted(r.dt for r in ods.select("dt").distinct().collect() if r.dt)
    formats.append_partitioned(ods, f"{out}/ods_events", sort_by=SORTED_BY["ods_events"])
    refresh_days(spark, dim_user, dim_item, out, days)
    return days


def refresh_days(spark: SparkSession, dim_user: DataFrame, dim_item: DataFrame, out: str, days: list[dt.date]) -> None:
    """Compute the given days again in DWD, DWS and ADS.

    A copy of an event can lie on another day, and which copy counts can change: the days that
    hold copies of events of these days, in ODS or in the stored DWD, are computed again too.
    They are found on event ids and days alone; whole rows are read of the days at hand only.
    A day that is left without rows is emptied.
    """
    ods = spark.read.parquet(f"{out}/ods_events")
    dwd = spark.read.parquet(f"{out}/dwd_user_action")
    ids = ods.select("event_id", "dt").unionByName(dwd.select("event_id", "dt"))

    def on(some: list[dt.date]) -> Column:
        return F.col("dt").isin(some)

    def days_with(events: DataFrame) -> list[dt.date]:  # at most all days there are
        return [r.dt for r in ids.join(events, "event_id", "left_semi").select("dt").distinct().collect()]

    again = sorted({*days, *days_with(ids.where(on(days)).select("event_id").distinct())})
    events = ids.where(on(again)).select("event_id").distinct()
    copies = ods.where(on(days_with(events))).join(events, "event_id", "left_semi")
    detail = build_dwd(copies, dim_user, dim_item).where(on(again))
    formats.replace_days(detail, f"{out}/dwd_user_action", again)
    stored = spark.read.schema(detail.schema).parquet(f"{out}/dwd_user_action").where(on(again))
    formats.replace_days(build_dws(stored), f"{out}/dws_user_daily", again)
    formats.replace_days(build_ads(stored), f"{out}/ads_funnel_daily", again)
    if formats.exists(spark, f"{out}/dws_uv_sketches"):  # a layer of its own, kept where somebody wants it
        formats.replace_days(build_uv_sketches(stored), f"{out}/dws_uv_sketches", again)
