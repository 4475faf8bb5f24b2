"""Sessions by inactivity and late rows by watermark, without windows over raw rows.

Both reduce the events to one row per key and time slice (combining before the shuffle),
settle the order on those few rows, and join the answer back. A user or source with a
large part of all events is thereby split over its time slices.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.functions import bucket_of
from tidemart.operators.joins import attach


def session_slices(df: DataFrame, user: str, ts: str, gap_seconds: int) -> DataFrame:
    """One row per user and slice of ``gap_seconds``, numbered by session.

    Two events in one slice are less than the gap apart, so a slice lies in one session,
    and a session can only start at a slice's first event. Events without a user have no session.
    """
    slices = (
        df.where(F.col(user).isNotNull()).withColumn("_slice", bucket_of(ts, gap_seconds))
        .groupBy(user, "_slice")
        .agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"), F.count(F.lit(1)).alias("_events"))
    )
    w = Window.partitionBy(user).orderBy("_slice")
    silent = F.unix_micros(F.col("_first").cast("timestamp")) - F.unix_micros(
        F.lag("_last").over(w).cast("timestamp")
    )
    starts = F.when(silent < gap_seconds * 1_000_000, 0).otherwise(1)
    return slices.withColumn("_starts", starts).withColumn(
        "session_no", F.sum("_starts").over(w.rowsBetween(Window.unboundedPreceding, 0))
    )


def sessionize(df: DataFrame, user: str, ts: str, gap_seconds: int = 1800, limit: int | None = None) -> DataFrame:
    """Adds ``session_no``: 1, 2, ... per user. A new session starts when the user was
    silent for ``gap_seconds`` or longer. NULL where there is no user."""
    slices = session_slices(df, user, ts, gap_seconds)
    return attach(
        df.withColumn("_slice", bucket_of(ts, gap_seconds)),
        slices.select(user, "_slice", "session_no"), [user, "_slice"], "left", limit,
    ).drop("_slice")


def session_totals(df: DataFrame, user: str, ts: str, gap_seconds: int = 1800) -> DataFrame:
    """One row per session: first and last event and number of events."""
    return (
        session_slices(df, user, ts, gap_seconds)
        .groupBy(user, "session_no")
        .agg(
            F.min("_first").alias("session_start"),
            F.max("_last").alias("last_event"),
            F.sum("_events").alias("events"),
        )
    )


def active_seconds(df: DataFrame, user: str, ts: str, gap_seconds: int = 1800) -> DataFrame:
    """Seconds between first and last event of a user's sessions, by the day they start."""
    spent = F.unix_micros(F.col("last_event").cast("timestamp")) - F.unix_micros(
        F.col("session_start").cast("timestamp")
    )
    return (
        session_totals(df, user, ts, gap_seconds)
        .groupBy(user, F.to_date("session_start").alias("dt"))
        .agg(
            F.floor(F.sum(spent) / 1_000_000).cast("long").alias("active_seconds"),
            F.count(F.lit(1)).alias("session_cnt"),
        )
    )


def classify_late(
    df: DataFrame,
    partition: str,
    order_by: Sequence[str],
    ts: str,
    size_seconds: int,
    delay_seconds: int,
    limit: int | None = None,
) -> DataFrame:
    """Adds ``window_start`` and ``is_late``: did the row come after its window had closed?

    Rows of one ``partition`` are taken in ``order_by`` order; the watermark before a row is
    the highest ``ts`` so far minus the delay, and a window is closed once the watermark
    reaches its end. This is the ideal watermark, advanced after every row; a running
    stream advances it once per micro-batch and therefore keeps somewhat more rows.

    A row with time ``t`` closes all windows that end at or before ``t - delay``. So for
    every window end the earliest closing row is a minimum over later slices.
    """
    size = size_seconds * 1_000_000
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    position = F.struct(*order_by)
    rows = df.withColumn("_end", F.floor(micros / size).cast("long") + 1)
    closers = df.groupBy(
        partition, F.floor((micros - delay_seconds * 1_000_000) / size).cast("long").alias("_end")
    ).agg(F.min(position).alias("_closer"))
    nobody = F.lit(None).cast(closers.schema["_closer"].dataType)
    ends = rows.select(partition, "_end").distinct().withColumn("_closer", nobody)
    w = Window.partitionBy(partition).orderBy(F.desc("_end")).rowsBetween(Window.unboundedPreceding, 0)
    closed_by = (
        closers.unionByName(ends)
        .groupBy(partition, "_end")
        .agg(F.min("_closer").alias("_closer"))
        .withColumn("_closer", F.min("_closer").over(w))
    )
    joined = attach(rows, closed_by, [partition, "_end"], "left", limit)
    start = F.timestamp_micros((F.col("_end") - 1) * size)
    return (
        joined.withColumn("window_start", start)
        .withColumn("is_late", F.coalesce(F.col("_closer") < position, F.lit(False)))
        .drop("_end", "_closer")
    )
