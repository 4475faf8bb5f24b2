"""Streams over files that arrive one after the other (M7, M8, M12), and against batch."""

import json

import pytest
from helpers import at, feed
from pyspark.sql import functions as F

from tidemart.operators import checks
from tidemart.session import stream_session
from tidemart.sources import views
from tidemart.streaming import sinks, sources, windows

SCHEMA = "event_id long, user_id long, country string, event_ts long"


class Feed:
    """A folder of JSON files, read in the order in which they were put there."""

    def __init__(self, spark, tmp_path):
        self.folder, self.spark, self.n = tmp_path / "in", stream_session(spark), 0
        self.folder.mkdir()
        self.out = str(tmp_path / "out")

    def put(self, *lines):
        import os

        self.n += 1
        target = self.folder / f"{self.n:03d}.json"
        target.write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines))
        os.utime(target, (1_700_000_000 + self.n * 10,) * 2)

    def stream(self):
        schema = self.spark.createDataFrame([], SCHEMA).schema
        return sources.with_event_time(sources.json_stream(self.spark, str(self.folder), schema, 1))

    def drain(self, stream, may_drop=False):
        return self.spark.read.parquet(sinks.drain(stream, self.out, may_drop=may_drop))


def event(i, second, user=1, country="US"):
    return {"event_id": i, "user_id": user, "country": country, "event_ts": 1704067200000 + second * 1000}


@pytest.fixture
def inbox(spark, tmp_path):
    return Feed(spark, tmp_path)


def test_late_row_is_dropped_and_window_waits_for_the_watermark(inbox):
    inbox.put(event(1, 0), event(2, 10))
    inbox.put(event(3, 300), event(4, 1))
    inbox.put(event(5, 310))
    inbox.put(event(6, 20))
    inbox.put(event(7, 900))
    out = inbox.drain(windows.pv(inbox.stream(), "ts", "1 minute", ["country"], "30 seconds"), may_drop=True)
    got = {r.window_start: r.pv for r in out.collect()}
    assert got == {at(0): 3, at(300): 2}


def test_exact_users_over_many_batches(inbox):
    for i in range(6):
        inbox.put(*[event(i * 10 + j, i * 40 + j, user=j % 3, country="US" if j % 2 else "DE") for j in range(8)])
    inbox.put(event(1000, 100_000))
    out = inbox.drain(windows.pv_uv(inbox.stream(), "ts", "1 minute", ["country"], "user_id", "5 seconds"))
    rows = inbox.spark.read.json(str(inbox.folder)).where("event_id < 1000")
    want = rows.groupBy(F.window(F.timestamp_millis("event_ts"), "1 minute").alias("w"), "country").agg(
        F.count("*").alias("pv"), F.countDistinct("user_id").alias("uv")
    ).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "country", "pv", "uv")
    assert checks.row_differences(out.select(*want.columns), want).isEmpty()
    assert out.count() == want.count() > 6


def test_sliding_windows_count_an_event_twice(inbox):
    inbox.put(event(1, 60, user=1), event(2, 400, user=2), event(3, 70, user=1))
    inbox.put(event(9, 100_000))
    stream = windows.pv_uv(inbox.stream(), "ts", "10 minutes", ["country"], "user_id", "5 seconds", "5 minutes")
    got = {r.window_start: (r.pv, r.uv) for r in inbox.drain(stream).collect()}
    assert got == {at(-300): (2, 1), at(0): (3, 2), at(300): (1, 1)}


@pytest.mark.parametrize("size, slide", [("10 minutes", "4 minutes"), ("10 minutes", "5 minutes"), ("7 minutes", "3 minutes")])
def test_sliding_windows_are_those_of_the_batch(inbox, size, slide):
    inbox.put(*[event(i, i * 47, user=i % 4) for i in range(60)])
    inbox.put(event(1000, 100_000))
    out = inbox.drain(windows.pv_uv(inbox.stream(), "ts", size, ["country"], "user_id", "5 seconds", slide))
    rows = inbox.spark.read.json(str(inbox.folder)).where("event_id < 1000")
    want = rows.groupBy(F.window(F.timestamp_millis("event_ts"), size, slide).alias("w"), "country").agg(
        F.count("*").alias("pv"), F.countDistinct("user_id").alias("uv")
    ).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "country", "pv", "uv")
    assert checks.row_differences(out, want).isEmpty() and out.count() == want.count() > 5


def test_unordered_files_give_what_one_file_gives(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    tables = []
    for name, files in (("one", events.coalesce(1)), ("many", events.repartition(12))):
        files.write.parquet(str(tmp_path / name / "events.parquet"))
        stream = sources.event_stream(stream_session(spark), str(tmp_path / name))
        counted = windows.pv_uv(stream, "ts", "1 minute", ["country"], "user_id", "5 seconds")
        tables.append(spark.read.parquet(sinks.drain(counted, str(tmp_path / name / "out"))))
    assert checks.row_differences(*tables).isEmpty() and tables[0].count() > 0


def test_a_replay_that_loses_rows_fails(inbox):
    for i in range(4):
        inbox.put(event(i, 4000 - i * 1000))
    with pytest.raises(RuntimeError, match="dropped"):
        inbox.drain(windows.pv(inbox.stream(), "ts", "1 minute", ["country"], "1 second"))


def test_sessions_end_after_the_gap(inbox):
    inbox.put(event(1, 0), event(2, 29 * 60), event(3, 60 * 60))
    inbox.put(event(9, 100_000, user=2))
    got = [(r.session_start, r.session_end, r.events) for r in
           inbox.drain(windows.sessions(inbox.stream(), "ts", "user_id", "30 minutes", "5 seconds")).orderBy("session_start").collect()]
    assert got == [(at(0), at(59 * 60), 2), (at(60 * 60), at(90 * 60), 1)]


def test_broken_lines_are_skipped(inbox):
    inbox.put(event(1, 0), '{"event_id": 2, "user', "", "[]", event(3, 5))
    inbox.put('{"event_id": "x"}', {"event_id": 4})
    got = {r.event_id: r.country for r in inbox.drain(inbox.stream()).collect()}
    assert got == {1: "US", 3: "US", 4: None}


def test_restart_on_the_same_checkpoint(inbox):
    inbox.put(event(1, 0), event(2, 1))
    assert inbox.drain(inbox.stream()).count() == 2
    inbox.put(event(3, 2))
    inbox.put(event(4, 3))
    out = inbox.drain(inbox.stream())
    assert sorted(r.event_id for r in out.collect()) == [1, 2, 3, 4]
    assert inbox.drain(inbox.stream()).count() == 4


def test_window_state_survives_a_restart(inbox):
    counted = lambda: windows.pv_uv(inbox.stream(), "ts", "1 minute", ["country"], "user_id", "5 seconds")
    inbox.put(event(1, 0, user=1), event(2, 5, user=2))
    assert inbox.drain(counted()).count() == 0
    inbox.put(event(3, 10, user=1))
    inbox.put(event(9, 100_000))
    got = [(r.pv, r.uv) for r in inbox.drain(counted()).collect()]
    assert got == [(3, 2)]


def test_replays_are_dropped_across_batches(inbox):
    inbox.put(event(1, 0), event(1, 0), event(2, 1))
    inbox.put(event(1, 0), event(3, 2))
    out = inbox.drain(windows.drop_replays(inbox.stream(), "ts", "event_id", "10 minutes"))
    assert sorted(r.event_id for r in out.collect()) == [1, 2, 3]


def test_arrival_in_the_next_minute_is_filed_there(spark):
    row = views.arrivals(feed(spark, dict(event_id=1000, event_ts=1704094678000))).select(
        F.date_trunc("minute", "ts").cast("string").alias("e"), F.date_trunc("minute", "arrival_ts").cast("string").alias("a")
    ).first()
    assert (row.e, row.a) == ("2024-01-01 07:37:00", "2024-01-01 07:38:00")
