"""Streams in: Parquet or JSON files that appear in a folder. A broker is one more
``readStream`` format; everything behind the source stays the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from tidemart.sources.views import as_feed


def event_stream(spark: SparkSession, sf_dir: str, files_per_trigger: int | None = None) -> DataFrame:
    """The event table as a stream with the columns of the feed and the event time ``ts``.

    Without ``files_per_trigger`` a replay takes all files in one micro-batch, whatever their
    order. With it, a watermark moves after each micro-batch, and rows of later files that
    are older than it are lost: files have to arrive in the order of event time, give or take
    the watermark's delay.
    """
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    reader = _paced(spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet"), files_per_trigger)
    return with_event_time(as_feed(reader.parquet(_event_folder(spark, sf_dir))))


def _paced(reader: DataStreamReader, files_per_trigger: int | None) -> DataStreamReader:
    return reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader


def _event_folder(spark: SparkSession, sf_dir: str) -> str:
    """A file source watches a folder, so a single file is picked out of its parent by name."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/events.parquet")
    is_file = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).isFile()
    return f"{sf_dir}/events.parque[t]" if is_file else f"{sf_dir}/events.parquet"


def broker_stream(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Every message of a broker topic as it came, with its partition, offset and time.

    Needs Spark's Kafka connector on the class path. ``parse_events`` and everything behind
    it take this stream like ``raw_stream``.
    """
    messages = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic).options(**options).load()
    )
    return messages.select(
        F.col("value").cast("string").alias("raw"), F.col("timestamp").alias("landed_at"),
        F.col("partition").alias("source_partition"), F.col("offset").alias("source_offset"),
    )


def stamp_arrival(stream: DataFrame) -> DataFrame:
    """Adds ``arrival_ts``, the clock when the micro-batch started, for windows by arrival
    in a running stream."""
    return stream.withColumn("arrival_ts", F.current_timestamp())


def with_event_time(feed: DataFrame) -> DataFrame:
    return feed.withColumn("ts", F.timestamp_millis("event_ts"))


def json_stream(spark: SparkSession, folder: str, schema: T.StructType, files_per_trigger: int | None = None) -> DataFrame:
    """JSON Lines as a stream; lines that do not parse are skipped.

    A broken line is one whose object could not be read, not one that lacks a field.
    """
    lines = raw_stream(spark, folder, files_per_trigger)
    return parse_events(lines, schema).where("parsed").select("event.*")


def raw_stream(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """Every line as it came, with the file it came from and that file's time. For
    ``files_per_trigger`` see ``event_stream``."""
    return (
        _paced(spark.readStream, files_per_trigger).text(folder)
        .select(
            F.col("value").alias("raw"),
            F.col("_metadata.file_path").alias("source_file"),
            F.col("_metadata.file_modification_time").alias("landed_at"),
        )
    )


def parse_events(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Adds ``event`` (the parsed columns) and ``parsed`` (false for a broken line)."""
    strict = T.StructType(schema.fields + [T.StructField("_broken", T.StringType())])
    event = F.from_json("raw", strict, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"})
    return lines.withColumn("event", event).withColumn(
        "parsed", F.col("event").isNotNull() & F.col("event._broken").isNull()
    ).withColumn("event", F.col("event").dropFields("_broken"))
