"""Windowed aggregations over a stream. All of them also run on a batch DataFrame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def pv(stream: DataFrame, ts: str, size: str, by: Sequence[str], delay: str, slide: str | None = None) -> DataFrame:
    """Rows per window and group; a window is final once the watermark passes its end."""
    counted = (
        stream.withWatermark(ts, delay)
        .groupBy(F.window(ts, size, slide), *by)
        .agg(F.count(F.lit(1)).alias("pv"))
    )
    return counted.select("window.start", "window.end", *by, "pv").withColumnsRenamed(
        {"start": "window_start", "end": "window_end"}
    )


def pv_uv(
    stream: DataFrame, ts: str, size: str, by: Sequence[str], user: str, delay: str, slide: str | None = None
) -> DataFrame:
    """Rows and exact distinct users per window and group.

    The first aggregation keeps one row per window, group and user, so its state is spread
    over users and no state row grows. When its window closes, the second one counts those
    rows. Windows have different ends that lie a slide apart, so a tumbling window of one
    slide around a row's ``window_time``, ending where that window ends, stands for exactly
    one window of the first step. Ends are not multiples of the slide where it does not divide
    the size, hence the offset.
    """
    users = (
        stream.withWatermark(ts, delay)
        .groupBy(F.window(ts, size, slide), *by, user)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_time", F.window_time("window"))
    )
    step = slide or size
    offset = f"{seconds_of(users.sparkSession, size) % seconds_of(users.sparkSession, step)} seconds"
    counted = users.groupBy(F.window("_time", step, startTime=offset).alias("w"), *by).agg(
        F.sum("_rows").alias("pv"), F.count(user).alias("uv")
    )
    return counted.select(
        (F.col("w.end") - F.expr(f"INTERVAL {size}")).alias("window_start"),
        F.col("w.end").alias("window_end"), *by, "pv", "uv",
    )


def seconds_of(spark: SparkSession, length: str) -> int:
    """A window length in seconds, as Spark reads it."""
    interval = spark.sql(f"SELECT unix_seconds(TIMESTAMP '1970-01-01 00:00:00 UTC' + INTERVAL {length}) AS s")
    return interval.first().s


def sessions(stream: DataFrame, ts: str, user: str, gap: str, delay: str) -> DataFrame:
    """One row per user and session; a session ends when the user was silent for ``gap``,
    and its window end is the last event plus the gap."""
    found = (
        stream.withWatermark(ts, delay)
        .groupBy(F.session_window(ts, gap), user)
        .agg(F.count(F.lit(1)).alias("events"))
    )
    return found.select(user, "session_window.start", "session_window.end", "events").withColumnsRenamed(
        {"start": "session_start", "end": "session_end"}
    )


def drop_replays(stream: DataFrame, ts: str, key: str, delay: str) -> DataFrame:
    """One row per key; a key is forgotten once the watermark is past its event."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])
