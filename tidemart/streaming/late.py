"""Windowed counts of a running stream whose late rows are kept and corrected for.

Each micro-batch is split by the watermark as it was before it: rows of windows that had ended go to
a side table and are added to their window as a correction, all others are counted as usual. What a
batch contributes lies in its own partition of three tables:

    late     the side output: the rows that came after their window had ended
    counts   rows per window and group, on time and late
    seen     the latest event time of the batch; written last, it marks the batch as done

A batch that is run again after a failure writes the same partitions again, so that nothing is lost or
counted twice. The watermark before a batch comes from ``seen`` of the batches before it, not from the
run at hand, and is therefore the same when the batch is repeated or the stream is restarted.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemart.sources import formats
from tidemart.streaming.windows import seconds_of

SEEN = "latest timestamp, batch long"


def count_with_corrections(
    stream: DataFrame, folder: str, ts: str, size: str, delay: str, by: Sequence[str] = (), trigger: dict | None = None
) -> StreamingQuery:
    """Start counting rows per window and group; ``late_rows`` and ``windows`` read the results.

    Rows without an event time belong to no window and are never late.
    """

    micros = seconds_of(stream.sparkSession, size) * 1_000_000

    def take(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        start = (F.unix_micros(ts) - F.pmod(F.unix_micros(ts), F.lit(micros)))  # null without an event time; F.window would drop the row
        late = _is_late(start + micros, watermark(spark, folder, batch_id, delay))
        rows = batch.withColumn("window_start", F.timestamp_micros(start)).withColumn("is_late", late)
        held = rows.persist()
        try:
            _put(held.where("is_late").drop("is_late"), f"{folder}/late", batch_id)
            counts = held.groupBy("window_start", *by).agg(
                F.count_if(~F.col("is_late")).alias("first_pv"), F.count_if("is_late").alias("late_pv"))
            _put(counts, f"{folder}/counts", batch_id)
            _put(held.agg(F.max(ts).cast("timestamp").alias("latest")), f"{folder}/seen", batch_id)
        finally:
            held.unpersist()

    return (
        stream.writeStream.foreachBatch(take).option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def _is_late(end: Column, mark: dt.datetime | None) -> Column:
    return F.lit(False) if mark is None else F.coalesce(end <= F.unix_micros(F.lit(mark)), F.lit(False))


def _put(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def watermark(spark: SparkSession, folder: str, batch_id: int, delay: str) -> dt.datetime | None:
    """The latest event time before a batch less the delay; None if there was none."""
    if not formats.exists(spark, f"{folder}/seen"):
        return None
    before = spark.read.schema(SEEN).parquet(f"{folder}/seen").where(F.col("batch") < batch_id)
    return before.agg((F.max("latest") - F.expr(f"INTERVAL {delay}")).alias("mark")).first().mark


def _done(spark: SparkSession, folder: str, table: str, schema: T.StructType | str) -> DataFrame:
    """Partitions of the batches that are done; one that has been begun may be there in part."""
    done = spark.read.schema(SEEN).parquet(f"{folder}/seen").select("batch")
    return spark.read.schema(schema).parquet(f"{folder}/{table}").join(F.broadcast(done), "batch", "left_semi")


def late_rows(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """The side output: rows of the stream (``schema``) with ``window_start`` and ``batch``."""
    return _done(spark, folder, "late", T.StructType([*schema.fields, *_WINDOW, T.StructField("batch", T.LongType())]))


_WINDOW = [T.StructField("window_start", T.TimestampType())]


def windows(spark: SparkSession, folder: str, by: T.StructType) -> DataFrame:
    """Per window and group (fields ``by``): rows in time, rows that came late, and the corrected count."""
    counts = [T.StructField(c, T.LongType()) for c in ("first_pv", "late_pv", "batch")]
    parts = _done(spark, folder, "counts", T.StructType([*_WINDOW, *by.fields, *counts]))
    total = parts.groupBy("window_start", *by.names).agg(F.sum("first_pv").alias("first_pv"), F.sum("late_pv").alias("late_pv"))
    return total.withColumn("corrected_pv", F.col("first_pv") + F.col("late_pv"))
