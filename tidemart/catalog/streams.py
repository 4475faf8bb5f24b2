"""Streaming jobs (S rows and the stream sources and sinks). Each runs a real stream over
all events that are there and returns the table it wrote.

Append mode writes a window once the watermark (latest event minus the delay) has reached
its end, so the oracles leave out the windows that are still open at the end of the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.catalog.registry import query
from tidemart.catalog.sql import ARRIVALS, ODS, SLOW_ARRIVALS, with_
from tidemart.catalog.stored import stored_folder
from tidemart.operators import versioned
from tidemart.operators.joins import compare_by_key
from tidemart.operators.sessions import classify_late
from tidemart.session import scratch_dir, stream_session
from tidemart.sources import formats, views
from tidemart.streaming import late, sinks, sources, windows

_MINUTE = f"""{ARRIVALS},
ended AS (SELECT *, date_trunc('minute', ts) AS ws, date_trunc('minute', ts) + INTERVAL 1 MINUTE AS we FROM arrived)"""


def _run(spark: SparkSession, stream: DataFrame, name: str, by=()) -> DataFrame:
    """Drain the stream, read its table in the caller's session; times without a zone."""
    table = sinks.drain(stream, scratch_dir(spark, name), by)
    out = spark.read.schema(stream.schema).parquet(table).select(*stream.columns)
    return out.withColumns({
        f.name: F.col(f.name).cast("timestamp_ntz") for f in stream.schema if isinstance(f.dataType, T.TimestampType)
    })


def _events(spark, sf_dir) -> DataFrame:
    return sources.event_stream(stream_session(spark), sf_dir)


@query(with_(_MINUTE, """
SELECT ws AS window_start, we AS window_end, country, COUNT(*) AS pv, COUNT(DISTINCT user_id) AS uv
FROM ended WHERE we <= (SELECT MAX(ts) FROM arrived) - INTERVAL 5 SECOND GROUP BY ws, we, country"""))
def tumbling_pv_uv(spark, sf_dir):
    return _run(spark, windows.pv_uv(_events(spark, sf_dir), "ts", "1 minute", ["country"], "user_id", "5 seconds"), "pv_uv")


@query(with_(_MINUTE, """
SELECT ws AS window_start, we AS window_end, country, COUNT(*) AS pv
FROM ended WHERE we <= (SELECT MAX(ts) FROM arrived) - INTERVAL 30 SECOND GROUP BY ws, we, country"""))
def tumbling_pv_eventtime(spark, sf_dir):
    return _run(spark, windows.pv(_events(spark, sf_dir), "ts", "1 minute", ["country"], "30 seconds"), "pv_event")


@query(with_(ARRIVALS, """
SELECT date_trunc('minute', arrival_ts) AS window_start, date_trunc('minute', arrival_ts) + INTERVAL 1 MINUTE AS window_end,
  country, COUNT(*) AS pv
FROM arrived WHERE date_trunc('minute', arrival_ts) + INTERVAL 1 MINUTE <= (SELECT MAX(arrival_ts) FROM arrived)
GROUP BY 1, 2, 3"""))
def tumbling_pv_proctime(spark, sf_dir):
    """By arrival time, replayed from a column: the clock of a live run would give another
    answer every time. Arrivals are never late, so no delay."""
    stream = views.arrivals(_events(spark, sf_dir))
    return _run(spark, windows.pv(stream, "arrival_ts", "1 minute", ["country"], "0 seconds"), "pv_arrival")


@query(with_(ARRIVALS + """,
e AS (SELECT date_trunc('minute', ts) AS window_start, country, COUNT(*) AS pv FROM arrived
      WHERE date_trunc('minute', ts) + INTERVAL 1 MINUTE <= (SELECT MAX(ts) FROM arrived) - INTERVAL 30 SECOND GROUP BY 1, 2),
p AS (SELECT date_trunc('minute', arrival_ts) AS window_start, country, COUNT(*) AS pv FROM arrived
      WHERE date_trunc('minute', arrival_ts) + INTERVAL 1 MINUTE <= (SELECT MAX(arrival_ts) FROM arrived) GROUP BY 1, 2),
d AS (SELECT country, COALESCE(e.pv, 0) - COALESCE(p.pv, 0) AS diff FROM p FULL OUTER JOIN e USING (window_start, country))""", """
SELECT country, COUNT(*) AS windows, CAST(SUM(CASE WHEN diff > 0 THEN diff ELSE 0 END) AS BIGINT) AS missing_by_arrival,
  CAST(SUM(CASE WHEN diff < 0 THEN -diff ELSE 0 END) AS BIGINT) AS extra_by_arrival,
  CAST(SUM(ABS(diff)) AS BIGINT) AS misfiled
FROM d GROUP BY country"""))
def watermark_diff(spark, sf_dir):
    """The two result tables of the streams compared: events filed in the wrong minute. Net
    per window, so an event that enters and one that leaves a window cancel out."""
    by_arrival = tumbling_pv_proctime(spark, sf_dir)
    by_event = tumbling_pv_eventtime(spark, sf_dir)
    diff = compare_by_key(by_arrival, by_event, ["window_start", "country"], "pv", ("proctime_pv", "eventtime_pv"))
    d = F.col("diff")
    return diff.groupBy("country").agg(
        F.count(F.lit(1)).alias("windows"),
        F.sum(F.greatest(d, F.lit(0))).alias("missing_by_arrival"),
        F.sum(F.greatest(-d, F.lit(0))).alias("extra_by_arrival"),
        F.sum(F.abs(d)).alias("misfiled"),
    )


_LATE = SLOW_ARRIVALS + """,
placed AS (
  SELECT event_id, country, device, ts, arrival_ts, date_trunc('minute', ts) AS window_start,
    MAX(ts) OVER (PARTITION BY device ORDER BY arrival_ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
      AS seen
  FROM arrived),
judged AS (SELECT *, COALESCE(window_start + INTERVAL 1 MINUTE <= seen, FALSE) AS is_late FROM placed)"""


def _judged(spark, sf_dir):
    arrived = views.arrivals(views.raw_events(spark, sf_dir), slow=True).select("event_id", "country", "device", "ts", "arrival_ts")
    return classify_late(arrived, "device", ["arrival_ts", "event_id"], "ts", 60, 0)


@query(with_(_LATE, "SELECT event_id, country, device, window_start FROM judged WHERE is_late"))
def late_rows(spark, sf_dir):
    """The side output: events that came after their minute had closed, per source."""
    late = _judged(spark, sf_dir).where("is_late")
    return late.select("event_id", "country", "device", F.col("window_start").cast("timestamp_ntz").alias("window_start"))


@query(with_(_LATE, """
SELECT window_start, country, COUNT(*) FILTER (NOT is_late) AS first_pv, COUNT(*) FILTER (is_late) AS late_pv,
  COUNT(*) AS corrected_pv
FROM judged GROUP BY window_start, country"""))
def late_corrected_pv(spark, sf_dir):
    """What a window showed when it closed, what came later, and the corrected result."""
    judged = _judged(spark, sf_dir).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
    return judged.groupBy("window_start", "country").agg(
        F.count_if(~F.col("is_late")).alias("first_pv"), F.count_if("is_late").alias("late_pv"),
        F.count(F.lit(1)).alias("corrected_pv"),
    )


# Six deliveries of five days each; every tenth event comes one delivery late.
_DELIVERY = "least(5, (datediff(dt, DATE '2024-01-01') div 5) + if(event_id % 10 = 0, 1, 0))"
_DELIVERED = ODS + """,
delivered AS (
  SELECT event_id, user_id, country, amount, dt, make_timestamp(event_ts * 1000) AS ts,
    LEAST(5, date_diff('day', DATE '2024-01-01', dt) // 5 + CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END) AS delivery
  FROM ods),
latest AS (SELECT delivery, MAX(ts) AS latest FROM delivered GROUP BY delivery),
marks AS (
  SELECT d.delivery, MAX(l.latest) - INTERVAL 30 SECOND AS mark
  FROM (SELECT DISTINCT delivery FROM delivered) d LEFT JOIN latest l ON l.delivery < d.delivery GROUP BY d.delivery),
split AS (
  SELECT event_id, country, ts, date_trunc('hour', ts) AS window_start,
    COALESCE(date_trunc('hour', ts) + INTERVAL 1 HOUR <= mark, FALSE) AS is_late
  FROM delivered JOIN marks USING (delivery))"""
_DELIVERED_SCHEMA = "event_id long, user_id long, country string, amount double, dt date, ts timestamp"


def _deliveries(spark, sf_dir, folder: str, run) -> None:
    """Each delivery arrives in a folder, and the stream over it runs once from its checkpoint."""
    events = views.ods_events(spark, sf_dir).select("event_id", "user_id", "country", "amount", "dt", F.timestamp_millis("event_ts").alias("ts"))
    for n in range(6):
        events.where(F.expr(_DELIVERY) == n).write.mode("append").parquet(f"{folder}/in")
        run(stream_session(spark).readStream.schema(_DELIVERED_SCHEMA).parquet(f"{folder}/in")).awaitTermination()


def _late_stream(spark, sf_dir) -> str:
    """The folder of a stream over all deliveries that keeps late rows and corrects its windows."""
    return stored_folder(spark, sf_dir, "late_stream", ("events",), lambda out: _deliveries(
        spark, sf_dir, out, lambda stream: late.count_with_corrections(
            stream.select("event_id", "country", "ts"), out, "ts", "1 hour", "30 seconds", ["country"])))


@query(with_(_DELIVERED, "SELECT event_id, country, window_start FROM split WHERE is_late"))
def late_rows_live(spark, sf_dir):
    """The side output of the running stream: rows whose hour had ended before their micro-batch."""
    schema = T.StructType.fromDDL("event_id long, country string, ts timestamp")
    rows = late.late_rows(spark, _late_stream(spark, sf_dir), schema)
    return rows.select("event_id", "country", F.col("window_start").cast("timestamp_ntz").alias("window_start"))


@query(with_(_DELIVERED, """
SELECT window_start, country, COUNT(*) FILTER (NOT is_late) AS first_pv, COUNT(*) FILTER (is_late) AS late_pv, COUNT(*) AS corrected_pv
FROM split GROUP BY window_start, country"""))
def late_corrected_live(spark, sf_dir):
    """The stored windows of the running stream: counted in time, added later, and together."""
    windows_ = late.windows(spark, _late_stream(spark, sf_dir), T.StructType.fromDDL("country string"))
    return windows_.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


def _versions_stream(spark, sf_dir) -> versioned.History:
    """A history that a stream has written, a version per delivery, opened anew."""
    def make(out):
        versioned.begin(spark.createDataFrame([], _DELIVERED_SCHEMA), f"{out}/history")
        _deliveries(spark, sf_dir, out, lambda stream: (
            stream.writeStream.foreachBatch(versioned.append_batch(f"{out}/history", "events"))
            .option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start()))

    return versioned.open_history(spark, stored_folder(spark, sf_dir, "versions_stream", ("events",), make) + "/history")


@query(with_(_DELIVERED, """
SELECT CAST(1 AS BIGINT) AS version, CAST(NULL AS BIGINT) AS parent, 'append' AS op, CAST(0 AS BIGINT) AS added, CAST(0 AS BIGINT) AS deleted, FALSE AS is_current
UNION ALL SELECT delivery + 2, delivery + 1, 'append', COUNT(*), 0, delivery = 5 FROM delivered GROUP BY delivery"""))
def stream_versions_log(spark, sf_dir):
    """Snapshots of a table that a stream writes: one version per micro-batch."""
    return versioned.log(_versions_stream(spark, sf_dir))


@query(with_(_DELIVERED, "SELECT event_id, user_id, country, amount, dt, ts FROM delivered WHERE delivery <= 2"))
def stream_versions_as_of(spark, sf_dir):
    """That table as it was after its third micro-batch."""
    rows = versioned.read_as_of(_versions_stream(spark, sf_dir), 4)
    return rows.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query(with_(ARRIVALS + """,
slid AS (
  SELECT time_bucket(INTERVAL 5 MINUTE, ts, TIMESTAMP '2024-01-01') - INTERVAL 5 MINUTE * k AS window_start, country, user_id, ts
  FROM arrived, (VALUES (0), (1)) s(k))""", """
SELECT window_start, window_start + INTERVAL 10 MINUTE AS window_end, country, COUNT(*) AS pv,
  COUNT(DISTINCT user_id) AS uv
FROM slid WHERE window_start + INTERVAL 10 MINUTE <= (SELECT MAX(ts) FROM arrived) - INTERVAL 5 SECOND
GROUP BY window_start, country"""))
def sliding_uv(spark, sf_dir):
    stream = _events(spark, sf_dir)
    uv = windows.pv_uv(stream, "ts", "10 minutes", ["country"], "user_id", "5 seconds", "5 minutes")
    return _run(spark, uv, "sliding_uv")


@query(with_(ARRIVALS + """,
gaps AS (SELECT user_id, ts, epoch_us(ts) // 1000 - LAG(epoch_us(ts) // 1000) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS gap_ms,
  event_id FROM arrived),
numbered AS (SELECT user_id, ts, SUM(CASE WHEN gap_ms < 1800000 THEN 0 ELSE 1 END)
  OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS n FROM gaps),
s AS (SELECT user_id, MIN(ts) AS session_start, MAX(ts) + INTERVAL 30 MINUTE AS session_end, COUNT(*) AS events
      FROM numbered GROUP BY user_id, n)""", """
SELECT * FROM s WHERE session_end <= (SELECT MAX(ts) FROM arrived) - INTERVAL 5 SECOND"""))
def session_windows(spark, sf_dir):
    return _run(spark, windows.sessions(_events(spark, sf_dir), "ts", "user_id", "30 minutes", "5 seconds"), "sessions")


@query(with_(ODS, "SELECT * EXCLUDE (dt) FROM ods"))
def json_stream_source(spark, sf_dir):
    """Events as JSON lines with broken lines between them, read back as a stream."""
    raw = views.raw_events(spark, sf_dir)
    folder = scratch_dir(spark, "json_in")
    good = raw.select(F.to_json(F.struct(*raw.columns)).alias("value"))
    broken = raw.select(F.concat(F.lit('{"event_id": '), "event_id", F.lit(', "user_id": ')).alias("value"))
    good.unionByName(broken).write.text(folder)
    return _run(spark, sources.json_stream(stream_session(spark), folder, raw.schema), "json_out")


@query(with_(ODS, "SELECT * FROM ods"))
def stream_table_sink(spark, sf_dir):
    """The event stream appended to a table partitioned by day."""
    stream = _events(spark, sf_dir).withColumn("dt", F.to_date("ts")).drop("ts")
    return _run(spark, stream, "sink", ["dt"])


@query(with_(ODS, "SELECT * FROM ods"))
def checkpoint_restart(spark, sf_dir):
    """Half of the days, stop, the other half, start again on the same checkpoint."""
    ods = views.ods_events(spark, sf_dir)
    folder = scratch_dir(spark, "restart")
    session = stream_session(spark)
    for half in (F.col("dt") < F.lit("2024-01-16").cast("date"), F.col("dt") >= F.lit("2024-01-16").cast("date")):
        ods.where(half).write.mode("append").json(f"{folder}/in")
        stream = sources.json_stream(session, f"{folder}/in", ods.schema)
        sinks.drain(stream, f"{folder}/out")
    return spark.read.schema(ods.schema).parquet(f"{folder}/out/table")


# A broken line, one whose time is no number, and an empty line.
_ODD_LINES = ('{"event_id": 1, "user', '{"event_id": 2, "event_ts": "abc"}', "")


@query(with_(ODS, """
SELECT event_id, user_id, action_type, event_ts, dt, TRUE AS parsed, TRUE AS has_source,
  CAST(event_id AS VARCHAR) AS raw FROM ods
UNION ALL SELECT * FROM (VALUES
  (NULL, NULL, NULL, NULL, CAST(NULL AS DATE), FALSE, TRUE, '{"event_id": 1, "user'),
  (NULL, NULL, NULL, NULL, CAST(NULL AS DATE), FALSE, TRUE, '{"event_id": 2, "event_ts": "abc"}'),
  (NULL, NULL, NULL, NULL, CAST(NULL AS DATE), FALSE, TRUE, '')) odd"""))
def stream_to_ods(spark, sf_dir):
    """Keep-everything landing: the raw line, where it came from and when, with the day for
    partitioning. Nothing that arrives is lost: broken lines, lines with values of a wrong type
    and empty lines land as they came, without a day. ``raw`` is shown as its event id where
    the line is the very text that was sent."""
    raw = views.raw_events(spark, sf_dir)
    folder = scratch_dir(spark, "ods_in")
    formats.write_jsonl(raw, folder)
    odd = spark.range(1).select(F.explode(F.array(*map(F.lit, _ODD_LINES))).alias("value"))
    odd.coalesce(1).write.mode("append").text(folder)
    lines = sources.raw_stream(stream_session(spark), folder)
    event_ms = F.get_json_object("raw", "$.event_ts").try_cast("long")
    landed = _run(spark, lines.withColumn("dt", F.to_date(F.timestamp_millis(event_ms))), "ods_out", ["dt"])
    event = sources.parse_events(landed, raw.schema)
    fields = {c: F.when(F.col("parsed"), F.col(f"event.{c}")) for c in raw.columns}
    sent = F.to_json(F.struct(*[fields[c].alias(c) for c in raw.columns]))
    return event.select(
        *[fields[c].alias(c) for c in ("event_id", "user_id", "action_type", "event_ts")], "dt", "parsed",
        (F.col("source_file").isNotNull() & F.col("landed_at").isNotNull()).alias("has_source"),
        F.when(F.col("parsed") & (sent == F.col("raw")), F.col("event.event_id").cast("string")).otherwise(F.col("raw")).alias("raw"),
    )


# How much later than an event its copies may come. State holds the keys of that span.
REPLAY_HORIZON = "60 days"


@query(with_(ODS, "SELECT * EXCLUDE (dt) FROM ods"))
def stream_dedup(spark, sf_dir):
    """Every event delivered twice; the stream keeps one of each. One micro-batch takes all that
    is there, so that the horizon only matters to what comes later."""
    raw = views.raw_events(spark, sf_dir)
    folder = scratch_dir(spark, "replay_in")
    formats.write_jsonl(raw.unionByName(raw), folder)
    stream = sources.with_event_time(sources.json_stream(stream_session(spark), folder, raw.schema))
    return _run(spark, windows.drop_replays(stream, "ts", "event_id", REPLAY_HORIZON).drop("ts"), "replay_out")
