"""Sessions and late rows against row-by-row answers (M9, M10)."""

import datetime as dt
import random

import pytest
from helpers import at
from pyspark.sql import functions as F

from tidemart.operators.sessions import active_seconds, classify_late, session_totals, sessionize

TIMED = "event_id long, user_id long, ts timestamp_ntz"


def numbered(spark, seconds, **kw):
    df = spark.createDataFrame([(i, 1, at(s)) for i, s in enumerate(seconds)], TIMED)
    return [r.session_no for r in sessionize(df, "user_id", "ts", **kw).orderBy("event_id").collect()]


def test_gaps_around_the_limit(spark):
    assert numbered(spark, [0, 29 * 60, 60 * 60]) == [1, 1, 2]
    assert numbered(spark, [0, 30 * 60]) == [1, 2]
    assert numbered(spark, [10, 30 * 60 + 9]) == [1, 1]
    assert numbered(spark, [0, 1799, 1800, 3599, 5399]) == [1, 1, 1, 1, 2]


@pytest.mark.parametrize("limit", [2**70, 0])
def test_sessions_equal_a_row_by_row_walk(spark, limit):
    rnd = random.Random(3)
    rows = [(i, rnd.choice([1, 1, 1, 2, 3]), at(rnd.randrange(0, 90_000))) for i in range(600)]
    want, last, no = {}, {}, {}
    for event, user, ts in sorted(rows, key=lambda r: (r[2], r[0])):
        if user not in last or ts - last[user] >= dt.timedelta(seconds=600):
            no[user] = no.get(user, 0) + 1
        last[user] = ts
        want[event] = no[user]
    df = spark.createDataFrame(rows, TIMED)
    got = {r.event_id: r.session_no for r in sessionize(df, "user_id", "ts", 600, limit).collect()}
    assert got == want
    totals = session_totals(df, "user_id", "ts", 600)
    assert totals.count() == sum(no.values())
    assert totals.agg(F.sum("events")).first()[0] == 600


def test_active_seconds_belong_to_the_day_a_session_starts(spark):
    rows = [(1, 1, at(86_000)), (2, 1, at(86_900)), (3, 1, at(100_000)), (4, 1, at(100_060))]
    got = {r.dt.day: (r.active_seconds, r.session_cnt) for r in
           active_seconds(spark.createDataFrame(rows, TIMED), "user_id", "ts").collect()}
    assert got == {1: (900, 1), 2: (60, 1)}


@pytest.mark.parametrize("limit", [2**70, 0])
def test_late_rows_equal_a_row_by_row_watermark(spark, limit):
    rnd = random.Random(5)
    rows = []
    for i in range(800):
        ts = rnd.randrange(0, 4000)
        rows.append((i, rnd.choice(["p", "p", "q"]), at(ts), at(ts + rnd.choice([0, 0, 0, 40, 130, 700]))))
    want, seen = set(), {}
    for event, source, ts, arrival in sorted(rows, key=lambda r: (r[3], r[0])):
        end = at((int((ts - at(0)).total_seconds()) // 60 + 1) * 60)
        if source in seen and end <= seen[source] - dt.timedelta(seconds=30):
            want.add(event)
        seen[source] = max(seen.get(source, ts), ts)
    df = spark.createDataFrame(rows, "event_id long, source string, ts timestamp_ntz, arrival_ts timestamp_ntz")
    judged = classify_late(df, "source", ["arrival_ts", "event_id"], "ts", 60, 30, limit)
    assert judged.count() == 800
    assert {r.event_id for r in judged.where("is_late").collect()} == want
    assert 0 < len(want) < 800
