"""Late rows of a running stream: side output, corrections, restarts."""

import datetime as dt
from collections import Counter

import pytest
from helpers import at
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.streaming import late

SCHEMA = "id long, g string, ts timestamp"
# (id, group, seconds): deliveries in order; the watermark before each is the latest time before it less 10.
DELIVERIES = [
    [(1, "a", 5), (2, "a", 65), (3, "b", 70)],
    [(4, "a", 59), (5, "a", 61), (6, None, 200), (7, "a", None)],  # mark 60: the first minute has ended at 60
    [],
    [(8, "b", 119), (9, "b", 185), (10, "b", 130), (11, None, 1)],  # mark 190: minutes that end at 180 or before are over
    [(12, "a", 1000)],
]
LATE = {4, 8, 10, 11}


def rows(delivery):
    return [(i, g, None if s is None else at(s)) for i, g, s in delivery]


def run(spark, folder):
    stream = spark.readStream.schema(SCHEMA).parquet(f"{folder}/in")
    late.count_with_corrections(stream, f"{folder}/out", "ts", "1 minute", "10 seconds", ["g"]).awaitTermination()


def deliver(spark, folder, delivery):
    spark.createDataFrame(rows(delivery), SCHEMA).write.mode("append").parquet(f"{folder}/in")


def results(spark, folder):
    side = late.late_rows(spark, f"{folder}/out", T.StructType.fromDDL(SCHEMA)).collect()
    counted = late.windows(spark, f"{folder}/out", T.StructType.fromDDL("g string")).collect()
    return side, {(r.window_start, r.g): (r.first_pv, r.late_pv, r.corrected_pv) for r in counted}


def expected():
    everything = [(*r, r[0] in LATE) for d in DELIVERIES for r in d]
    start = lambda s: None if s is None else at(s // 60 * 60)
    first = Counter((start(s), g) for _, g, s, is_late in everything if not is_late)
    after = Counter((start(s), g) for _, g, s, is_late in everything if is_late)
    return {k: (first[k], after[k], first[k] + after[k]) for k in first | after}


def test_on_time_and_late_make_the_corrected_window(spark, tmp_path):
    for delivery in DELIVERIES:
        deliver(spark, tmp_path, delivery)
        run(spark, tmp_path)
    side, counted = results(spark, tmp_path)
    assert {r.id for r in side} == LATE and len(side) == len(LATE)
    assert {r.id: r.window_start for r in side}[4] == at(0)
    assert counted == expected()


@pytest.mark.parametrize("table", ["late", "counts", "seen"])
@pytest.mark.parametrize("after", [False, True])
def test_a_stop_anywhere_loses_and_repeats_nothing(spark, tmp_path, monkeypatch, table, after):
    put = late._put

    def broken(df, path, batch_id):
        if path.endswith(table) and batch_id == 1:
            if after:
                put(df, path, batch_id)
            raise RuntimeError("stopped")
        put(df, path, batch_id)

    for n, delivery in enumerate(DELIVERIES):
        deliver(spark, tmp_path, delivery)
        if n == 1:
            with monkeypatch.context() as m:
                m.setattr(late, "_put", broken)
                with pytest.raises(Exception, match="stopped"):
                    run(spark, tmp_path)
            side, _ = results(spark, tmp_path)
            assert not side or table == "seen" and after  # a batch that is not done shows nothing
        run(spark, tmp_path)
    side, counted = results(spark, tmp_path)
    assert sorted(r.id for r in side) == sorted(LATE) and counted == expected()


def test_the_watermark_is_that_of_the_batches_before(spark, tmp_path):
    assert late.watermark(spark, str(tmp_path), 0, "1 second") is None
    for n, seconds in enumerate((100, 50, 300)):
        late._put(spark.createDataFrame([(at(seconds),)], "latest timestamp"), f"{tmp_path}/seen", n)
    assert [late.watermark(spark, str(tmp_path), n, "10 seconds") for n in range(4)] == [None, at(90), at(90), at(290)]
    assert late.watermark(spark, str(tmp_path), 9, "1 day") == at(300) - dt.timedelta(days=1)


def test_many_rows_of_one_window(spark, tmp_path):
    df = spark.range(50_000).select(F.col("id"), F.lit("hot").alias("g"), F.lit(at(5)).alias("ts"))
    deliver(spark, tmp_path, [(0, "a", 600)])
    run(spark, tmp_path)
    df.write.mode("append").parquet(f"{tmp_path}/in")
    run(spark, tmp_path)
    side, counted = results(spark, tmp_path)
    assert len(side) == 50_000 and counted[at(0), "hot"] == (0, 50_000, 50_000)
