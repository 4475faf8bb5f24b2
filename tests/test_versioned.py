"""Versioned rows (M11): branches after a rollback, NULLs and late columns in conditions."""

import pytest
from helpers import plan_of

from tidemart.operators import versioned as v

SCHEMA = "event_id long, country string"
ROWS = [(i, "SG" if i % 3 == 0 else "US") for i in range(9)] + [(9, None)]


@pytest.fixture(params=[v.delete_where, v.delete_by_rewrite])
def history(spark, tmp_path, request):
    h = v.begin(spark.createDataFrame(ROWS, SCHEMA), str(tmp_path))
    h = v.add_column(h, "platform", "string")
    h = v.append(h, spark.createDataFrame([(i, c, "app") for i, c in ROWS[:3]], SCHEMA + ", platform string"))
    return request.param(h, "country = 'SG'")


def ids(df):
    return sorted(r.event_id for r in df.collect())


def test_old_version_has_its_own_rows_and_columns(history):
    one = v.read_as_of(history, 1)
    assert one.columns == ["event_id", "country"]
    assert ids(one) == list(range(10))
    two = v.read_as_of(history, 2)
    assert two.columns[-1] == "platform" and two.where("platform IS NULL").count() == 10
    assert v.read_as_of(history, 3).count() == 13


def test_delete_spares_null(history):
    now = v.read_as_of(history)
    assert ids(now) == [1, 1, 2, 2, 4, 5, 7, 8, 9]
    assert now.where("country IS NULL").count() == 1


def test_row_ids_are_unique_over_appended_copies(history):
    rows = history.rows
    assert rows.count() == rows.select("_added_v", "_row_n").distinct().count() >= 13
    again = v.append(v.append(history, v.read_as_of(history)), v.read_as_of(history))
    assert again.rows.count() == again.rows.select("_added_v", "_row_n").distinct().count()


def test_rollback_starts_a_branch(spark, history):
    h = v.rollback_to(history, 3)
    assert v.read_as_of(h).count() == 13
    h = v.append(h, spark.createDataFrame([(50, "SG", "web")], SCHEMA + ", platform string"))
    assert h.head == 5 and v.read_as_of(h).count() == 14
    assert v.read_as_of(h, 4).count() == 9
    log = {r.version: (r.parent, r.op, r.added, r.is_current) for r in v.log(h).collect()}
    assert log[5] == (3, "append", 1, True)
    assert log[4][0] == 3 and not log[4][3] and len(log) == 5


def test_condition_on_a_column_added_later(spark, history):
    h = v.delete_where(history, "platform = 'app'")
    assert ids(v.read_as_of(h)) == [1, 2, 4, 5, 7, 8, 9]
    h = v.append(h, spark.createDataFrame([(60, "SG", "app")], SCHEMA + ", platform string"))
    assert 60 in ids(v.read_as_of(h))


def test_repeated_deletes_count_only_rows_still_there(history):
    h = v.delete_where(history, "country = 'SG' OR event_id = 1")
    assert {r.version: r.deleted for r in v.log(h).collect()}[5] == 2
    assert v.version_diff(h, 3, 5).first()["diff"] == -6


def test_a_random_delete_reads_the_same_every_time(spark, tmp_path):
    h = v.begin(spark.range(1000).toDF("event_id"), str(tmp_path))
    h = v.delete_where(h, "rand() < 0.5")
    deleted = {r.version: r.deleted for r in v.log(h).collect()}[2]
    reads = [ids(v.read_as_of(h)) for _ in range(3)]
    assert reads[0] == reads[1] == reads[2] and len(reads[0]) == 1000 - deleted


def test_a_delete_by_local_day_does_not_move_with_the_zone(spark, tmp_path):
    hours = spark.range(48).selectExpr("id AS event_id", "timestamp_seconds(1704067200 + id * 3600) AS ts")
    h = v.delete_where(v.begin(hours, str(tmp_path)), "to_date(ts) = DATE '2024-01-01'")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        assert ids(v.read_as_of(h)) == list(range(24, 48))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_a_rewrite_leaves_other_batches_alone(spark, tmp_path):
    h = v.begin(spark.createDataFrame([(1, "US")], SCHEMA), str(tmp_path))
    h = v.append(h, spark.createDataFrame([(2, "SG"), (3, "US")], SCHEMA))
    h = v.delete_by_rewrite(h, "country = 'SG'")
    h = v.delete_by_rewrite(h, "country = 'XX'")
    assert ids(v.read_as_of(h)) == [1, 3]
    assert {r.version: (r.added, r.deleted) for r in v.log(h).collect()} == {1: (1, 0), 2: (2, 0), 3: (1, 2), 4: (0, 0)}


def test_mistakes_are_refused(spark, history):
    with pytest.raises(ValueError, match="no version"):
        v.read_as_of(history, 77)
    with pytest.raises(ValueError, match="not in the table"):
        v.append(history, spark.createDataFrame([(1, "x")], "event_id long, colour string"))
    with pytest.raises(ValueError, match="exists"):
        v.add_column(history, "platform", "string")


def test_another_session_opens_the_history(spark, history):
    h = v.open_history(spark.newSession(), history.folder)
    assert h.head == history.head and ids(v.read_as_of(h)) == ids(v.read_as_of(history))
    assert ids(v.read_as_of(h, 1)) == list(range(10))
    v.rollback_to(h, 3)
    h = v.open_history(spark, history.folder)
    assert h.head == 3 and v.read_as_of(h).count() == 13
    h = v.append(h, spark.createDataFrame([(70, "JP", "web")], SCHEMA + ", platform string"))
    again = v.open_history(spark, history.folder)
    assert again.head == h.head == 5 and 70 in ids(v.read_as_of(again)) and len(v.log(again).collect()) == 5


def test_a_change_without_its_line_does_not_exist(spark, history, monkeypatch):
    before = ids(v.read_as_of(history))
    with monkeypatch.context() as m:
        m.setattr(v, "_commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError, match="stopped"):
            v.append(history, spark.createDataFrame([(80, "JP", "web")] * 3, SCHEMA + ", platform string"))
        with pytest.raises(RuntimeError, match="stopped"):
            v.delete_where(history, "event_id > 0")
    h = v.open_history(spark, history.folder)
    assert ids(v.read_as_of(h)) == before and h.rows.where("event_id = 80").count() == 0
    h = v.delete_where(h, "event_id = 1")
    assert ids(v.read_as_of(h)) == [i for i in before if i != 1]


def test_a_version_reads_only_its_own_files_and_joins_only_for_deletes(spark, tmp_path):
    h = v.begin(spark.createDataFrame(ROWS, SCHEMA), str(tmp_path))
    for _ in range(3):
        h = v.append(h, spark.createDataFrame(ROWS, SCHEMA))
    plan = plan_of(v.read_as_of(h, 2))
    assert "Join" not in plan and plan.count("Scan parquet") <= 2 and "_added_v" in plan.split("PartitionFilters")[1]
    assert len(v.read_as_of(h, 2).inputFiles()) >= 2
    deleted = plan_of(v.read_as_of(v.delete_where(h, "event_id = 3")))
    assert "LeftAnti" in deleted and "Union" not in deleted


@pytest.mark.parametrize("stop", ["before the line", "after the line"])
def test_a_stream_into_versions_survives_a_stop(spark, tmp_path, monkeypatch, stop):
    """Three deliveries; the second is stopped between its rows and its line, or between its line
    and the stream's own commit."""
    folder, source = str(tmp_path / "history"), str(tmp_path / "in")
    v.begin(spark.createDataFrame([], SCHEMA), folder)

    def deliver(n):
        spark.createDataFrame([(n * 10 + i, "US") for i in range(5)], SCHEMA).write.mode("append").json(source)

    def drain():
        stream = spark.readStream.schema(SCHEMA).json(source)
        stream.writeStream.foreachBatch(v.append_batch(folder, "feed")).option(
            "checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start().awaitTermination()

    deliver(1)
    drain()
    deliver(2)
    commit = v._commit

    def broken(*a, **k):
        if stop == "after the line":
            commit(*a, **k)
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(v, "_commit", broken)
        with pytest.raises(Exception, match="stopped"):
            drain()
    drain()
    deliver(3)
    drain()
    drain()
    h = v.open_history(spark, folder)
    assert ids(v.read_as_of(h)) == [n * 10 + i for n in (1, 2, 3) for i in range(5)]
    assert ids(v.read_as_of(h, 3)) == [n * 10 + i for n in (1, 2) for i in range(5)]
    assert [(r.version, r.added) for r in v.log(h).orderBy("version").collect()] == [(1, 0), (2, 5), (3, 5), (4, 5)]
