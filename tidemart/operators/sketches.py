"""Distinct users over any span of days, from stored sketches.

Users of different days cannot be added up, since a user may come on several. A sketch can: the
stored table has one HyperLogLog sketch per day and group, and any set of days or groups is a
union of sketches, without an event being read again. A sketch of ``2^lg_k`` registers has a
relative standard error of about ``1.04 / sqrt(2^lg_k)`` and takes at most ``2^lg_k`` bytes, far fewer while
its group is small: up to about a tenth of ``2^lg_k`` users are kept as their hashes, so that
the count is exact there but for equal hashes.

Rows without a user are counted as events and not as users. A table without rows has no groups.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K = 14


def relative_error(lg_k: int = LG_K) -> float:
    """Relative standard error of an estimate."""
    return 1.04 / math.sqrt(2**lg_k)


def sketch_users(events: DataFrame, by: Sequence[str], user: str = "user_id", lg_k: int = LG_K) -> DataFrame:
    """One row per group: ``users`` (a sketch) and ``events``. Partial sketches are built map side,
    so a group with very many rows sends one sketch per task."""
    return events.groupBy(*by).agg(F.hll_sketch_agg(user, F.lit(lg_k)).alias("users"), F.count(F.lit(1)).alias("events"))


def count_users(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Users and events per group, over all days and groups that ``sketches`` has rows of."""
    merged = sketches.groupBy(*by).agg(F.hll_union_agg("users").alias("u"), F.sum("events").alias("events"))
    return merged.select(*by, F.hll_sketch_estimate("u").alias("uv"), "events")


def users_between(sketches: DataFrame, first: dt.date, last: dt.date, by: Sequence[str] = ()) -> DataFrame:
    """Users from ``first`` to ``last``, both included; other days are not read."""
    return count_users(sketches.where(F.col("dt").between(F.lit(first), F.lit(last))), by)


def rolling_users(sketches: DataFrame, days: int, by: Sequence[str] = ()) -> DataFrame:
    """For every day there is and every group, users of the ``days`` days that end with it. A sketch
    goes to each day whose span it lies in, after the groups have been merged to one per day."""
    daily = sketches.groupBy("dt", *by).agg(F.hll_union_agg("users").alias("users"), F.sum("events").alias("events"))
    there = daily.select("dt").distinct()
    ends = F.explode(F.sequence("dt", F.date_add("dt", days - 1)))
    spread = daily.select(ends.alias("dt"), *by, "users", "events").join(there, "dt", "left_semi")
    return count_users(spread, ["dt", *by])
