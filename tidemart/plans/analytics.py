"""Questions on the DWS and ADS tables. ``as_of`` is always a parameter: a query that asks
for the current date would give another answer every day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions import pct, ratio, week_of, within_days
from tidemart.operators.aggregates import change_vs_previous, share_of_total, sum_and_users
from tidemart.operators.colocated import Colocated, parts
from tidemart.operators.joins import attach
from tidemart.sources.views import STEPS


def recent(df: DataFrame, as_of: dt.date, days: int) -> DataFrame:
    return df.where(within_days("dt", as_of, days))


def total_gmv(ads: DataFrame, as_of: dt.date, days: int) -> DataFrame:
    return recent(ads, as_of, days).agg(F.round(F.sum("gmv"), 2).alias("total_gmv"))


def day_gmv(ads: DataFrame, day: dt.date) -> DataFrame:
    return ads.where(F.col("dt") == F.lit(day)).agg(F.round(F.sum("gmv"), 2).alias("gmv"))


def best_country(ads: DataFrame, as_of: dt.date, days: int) -> DataFrame:
    by_country = recent(ads, as_of, days).groupBy("country").agg(F.round(F.sum("gmv"), 2).alias("gmv"))
    return by_country.orderBy(F.desc("gmv"), F.asc("country")).limit(1)


def pay_uv_by_day(ads: DataFrame, as_of: dt.date, days: int) -> DataFrame:
    return (
        recent(ads, as_of, days).groupBy("dt", "country").agg(F.sum("pay_uv").alias("pay_uv"))
        .orderBy("dt", "country")
    )


def pay_uv_by_country(ads: DataFrame, as_of: dt.date, days: int) -> DataFrame:
    return (
        recent(ads, as_of, days).groupBy("country").agg(F.sum("pay_uv").alias("pay_uv"))
        .orderBy(F.desc("pay_uv"), F.asc("country"))
    )


def category_share(ads: DataFrame, as_of: dt.date, days: int) -> DataFrame:
    """GMV per category and its share of the total, the total as a scalar subquery."""
    rows = recent(ads, as_of, days)
    shares = share_of_total(rows, ["category"], "gmv", rows.agg(F.sum("gmv")))
    return _money(shares).orderBy(F.desc("pct"), F.asc("category"))


def category_share_of_groups(ads: DataFrame, as_of: dt.date, days: int) -> DataFrame:
    """The same share, taken over the grouped rows."""
    return _money(share_of_total(recent(ads, as_of, days), ["category"], "gmv"))


def conversion(ads: DataFrame, as_of: dt.date | None = None, days: int = 7) -> DataFrame:
    rows = ads if as_of is None else recent(ads, as_of, days)
    return rows.agg(pct(F.sum("pay_uv"), F.sum("impression_uv"), 4).alias("conv_pct"))


def weekly_drops(ads: DataFrame, as_of: dt.date, days: int = 30, below: float = -0.1) -> DataFrame:
    """Countries whose weekly GMV fell by more than a tenth against the week before."""
    weekly = recent(ads, as_of, days).withColumn("wk", week_of("dt"))
    drops = change_vs_previous(weekly, "country", "wk", "gmv", below)
    return drops.select(
        "country", "wk", F.round("gmv", 2).alias("gmv"), F.round("prev_gmv", 2).alias("prev_gmv"),
        F.round("pct_change", 4).alias("pct_change"),
    ).orderBy("pct_change", "country", "wk")


def arpu_by_age_group(dws: DataFrame, dim_user: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    """Paid amount per active user. The table has a row per user, day and country, so users
    are counted once each."""
    joined = attach(recent(dws, as_of, days), dim_user.select("user_id", "age_group"), "user_id", "inner")
    sums = sum_and_users(joined, ["age_group"], "pay_amount", "user_id", ("paid", "users"))
    return sums.select("age_group", F.round(ratio("paid", "users"), 4).alias("arpu")).orderBy(F.desc("arpu"))


def channel_share(dws: DataFrame, dim_user: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    """GMV per acquisition channel; the total includes users without a dimension row."""
    rows = recent(dws, as_of, days).withColumnRenamed("pay_amount", "gmv")
    joined = attach(rows.select("user_id", "gmv"), dim_user.select("user_id", "channel"), "user_id", "inner")
    shares = share_of_total(joined, ["channel"], "gmv", rows.agg(F.sum("gmv")))
    return _money(shares).orderBy(F.desc("gmv"), F.asc("channel"))


def shrunken_countries(ads: DataFrame, as_of: dt.date, below: float = 90.0) -> DataFrame:
    """Countries whose GMV from day -30 up to day -7 is under ``below`` percent of the total
    of the last seven days: HAVING against a scalar subquery."""
    before = ads.where(within_days("dt", as_of, 30) & ~within_days("dt", as_of, 7))
    last = ads.where(within_days("dt", as_of, 7) & (F.col("dt") < F.lit(as_of)))
    by_country = before.groupBy("country").agg(F.sum("gmv").alias("gmv"))
    share = ratio(F.col("gmv") * 100.0, last.agg(F.sum("gmv")).scalar())
    return by_country.where(share < below).select("country").orderBy("country")


def star_join(dwd: DataFrame, dim_user: DataFrame, dim_item: DataFrame, joiner=attach) -> DataFrame:
    """GMV and users by event country, age group and brand; facts without dimensions drop out.

    ``joiner`` is ``attach`` (broadcast where the size allows) or ``spread_join`` (always a
    shuffle).
    """
    fact = dwd.select("country", "user_id", "item_id", "amount")
    users = dim_user.select("user_id", "age_group")
    items = dim_item.select("item_id", "brand")
    joined = joiner(joiner(fact, users, "user_id", "inner"), items, "item_id", "inner")
    return sum_and_users(joined, ["country", "age_group", "brand"], "amount", "user_id", ("gmv", "uv"))


def star_join_colocated(spark: SparkSession, tables: Colocated, dim_item: DataFrame) -> DataFrame:
    """``star_join`` over a fact and users that are stored bucketed by user. The fact is not shuffled:
    users join bucket by bucket, and users are counted per group where they lie, since nobody is in two buckets."""
    groups = ["country", "age_group", "brand"]
    items = dim_item.select("item_id", "brand")
    counted = []
    for part in parts(spark, tables, ["country", "user_id", "item_id", "amount"], ["age_group"]):
        users = attach(part, items, "item_id", "inner").groupBy(*groups, "user_id").agg(F.sum("amount").alias("amount"))
        counted.append(users.groupBy(*groups).agg(F.sum("amount").alias("gmv"), F.count("user_id").alias("uv")))
    return counted[0].unionByName(counted[1]).groupBy(*groups).agg(F.sum("gmv").alias("gmv"), F.sum("uv").alias("uv"))


def gmv_by(ads_or_dwd: DataFrame, by: Sequence[str], value: str = "gmv") -> DataFrame:
    return ads_or_dwd.groupBy(*by).agg(F.round(F.sum(value), 2).alias("gmv"))


def funnel_rows(ads: DataFrame) -> DataFrame:
    """The five steps as rows with their user sums."""
    sums = ads.agg(*[F.sum(f"{s}_uv").alias(s) for s in STEPS])
    return sums.unpivot([], list(STEPS), "step", "uv")


def calendar(days: DataFrame, day: str = "dt") -> DataFrame:
    """Every date from the first to the last of ``days`` with ISO week, month and weekday."""
    span = days.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    dates = span.select(F.explode(F.sequence("lo", "hi")).alias("date"))
    return dates.select(
        "date", F.weekofyear("date").alias("week"), F.month("date").alias("month"),
        F.year("date").alias("year"), F.weekday("date").alias("weekday"),
    )


def _money(df: DataFrame) -> DataFrame:
    return df.withColumns({"gmv": F.round("gmv", 2), "pct": F.round("pct", 4)})
