"""Aggregations: funnel counts, shares, changes, retention."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.functions import ratio, value_when, zero_if_null


def step_counts(df: DataFrame, by: Sequence[str], steps: Sequence[str], action: str = "action_type") -> DataFrame:
    """Rows per step and group, one column ``<step>_cnt`` each."""
    return df.groupBy(*by).agg(*[F.sum(value_when(action, s, F.lit(1), 0)).alias(f"{s}_cnt") for s in steps])


def funnel_uv(
    df: DataFrame,
    by: Sequence[str],
    steps: Sequence[str],
    user: str = "user_id",
    amount: str = "amount",
    action: str = "action_type",
    paid: str = "pay",
    two_step: bool = True,
) -> DataFrame:
    """Distinct users per step and group (``<step>_uv``) and the paid amount (``gmv``).

    ``two_step=False`` writes it as one COUNT(DISTINCT CASE ...) per step; Spark then copies
    every row once per distinct count and once more for the sum before the shuffle. The
    default first reduces to one row per group and user, map-side included, and counts
    flags: rows are never copied, and no group is gathered in one task.
    """
    paid_amount = value_when(action, paid, amount)
    if not two_step:
        return df.groupBy(*by).agg(
            *[F.countDistinct(value_when(action, s, user)).alias(f"{s}_uv") for s in steps],
            zero_if_null(F.sum(paid_amount)).alias("gmv"),
        )
    did = [F.max(value_when(action, s, F.lit(1))).alias(f"_{s}") for s in steps]
    per_user = df.groupBy(*by, user).agg(*did, F.sum(paid_amount).alias("_gmv"))
    known = F.col(user).isNotNull()
    return per_user.groupBy(*by).agg(
        *[F.count(F.when(known, F.col(f"_{s}"))).alias(f"{s}_uv") for s in steps],
        zero_if_null(F.sum("_gmv")).alias("gmv"),
    )


def sum_and_users(
    df: DataFrame, by: Sequence[str], amount: str, user: str, names: tuple[str, str]
) -> DataFrame:
    """SUM(amount) and COUNT(DISTINCT user) per group by way of one row per group and user."""
    per_user = df.groupBy(*by, user).agg(F.sum(amount).alias("_amount"))
    return per_user.groupBy(*by).agg(F.sum("_amount").alias(names[0]), F.count(user).alias(names[1]))


def share_of_total(df: DataFrame, by: Sequence[str], value: str, total: DataFrame | None = None) -> DataFrame:
    """SUM(value) per group and its percentage of the total.

    The total is a scalar subquery: over ``total``'s only row, or over the groups of ``df``
    (then equal to ``SUM(SUM(value)) OVER ()``, without a window that gathers all groups
    in one task).
    """
    grouped = df.groupBy(*by).agg(F.sum(value).alias(value))
    whole = grouped.agg(F.sum(value)) if total is None else total
    return grouped.withColumn("pct", ratio(F.col(value) * 100.0, whole.scalar()))


def change_vs_previous(
    df: DataFrame, by: str, bucket: str, value: str, below: float | None = None
) -> DataFrame:
    """Change of SUM(value) against the group's previous bucket; keeps changes under ``below``.

    A first bucket has no previous value and is dropped; so is a change from zero.
    The window runs over summed rows: one per group and bucket.
    """
    summed = df.groupBy(by, bucket).agg(F.sum(value).alias(value))
    previous = F.lag(value).over(Window.partitionBy(by).orderBy(bucket))
    changes = summed.withColumn(f"prev_{value}", previous).withColumn(
        "pct_change", ratio(F.col(value) - F.col(f"prev_{value}"), F.col(f"prev_{value}"))
    )
    kept = F.col("pct_change").isNotNull()
    return changes.where(kept if below is None else kept & (F.col("pct_change") < below))


def retention(users: DataFrame, activity: DataFrame, offsets: Sequence[int] = (0, 1, 7, 30)) -> DataFrame:
    """Per registration day and offset: how many of that day's users were active again.

    Each user gets one row per offset with the day that would count; active user-days
    (already distinct) are joined to it on user and day, which spreads busy users.
    """
    due = users.select(
        "user_id", "register_date", F.explode(F.array(*[F.lit(o) for o in offsets])).alias("day_offset")
    ).withColumn("dt", F.date_add("register_date", F.col("day_offset")))
    active = activity.select("user_id", "dt").distinct().withColumn("_active", F.lit(1))
    return (
        due.join(active, ["user_id", "dt"], "left")
        .groupBy("register_date", "day_offset")
        .agg(F.count("_active").alias("retained_users"), F.count(F.lit(1)).alias("total_new_users"))
        .withColumn("retention_rate", F.round(ratio("retained_users", "total_new_users"), 4))
    )
