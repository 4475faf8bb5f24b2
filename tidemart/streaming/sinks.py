"""Streams out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def to_table(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    by: Sequence[str] = (),
    trigger: dict | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Append to a Parquet table. The file sink commits each micro-batch once, so a restart
    on the same checkpoint neither loses nor repeats rows.

    ``trigger`` defaults to everything available now; ``{"processingTime": "10 seconds"}``
    keeps the query running.
    """
    writer = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
    )
    if by:
        writer = writer.partitionBy(*by)
    if name:
        writer = writer.queryName(name)
    return writer.start()


def dropped_rows(query: StreamingQuery, kept: int) -> int:
    """Rows that came after the watermark, over all micro-batches of the run. Spark keeps the progress of
    the latest ``kept`` batches only (``stream_session`` asks for many): if older ones are gone, the
    sum is not known and this fails."""
    progress = query.recentProgress
    if len(progress) >= kept:
        raise RuntimeError("progress of early micro-batches is gone; dropped rows cannot be counted")
    return sum(op.numRowsDroppedByWatermark for p in progress for op in p.stateOperators)


def drain(stream: DataFrame, folder: str, by: Sequence[str] = (), may_drop: bool = False) -> str:
    """Run over everything available, wait, and return the folder of the written table.

    A replay that drops late rows is an error unless ``may_drop`` says that it is expected.
    """
    query = to_table(stream, f"{folder}/table", f"{folder}/checkpoint", by)
    query.awaitTermination()
    lost = dropped_rows(query, int(stream.sparkSession.conf.get("spark.sql.streaming.numRecentProgressUpdates")))
    if lost and not may_drop:
        raise RuntimeError(f"the stream dropped {lost} late rows")
    return f"{folder}/table"
