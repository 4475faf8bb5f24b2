"""The jobs end to end on string ids, as the event feed delivers them."""

import datetime as dt
import json

from helpers import at, feed, items, users
from pyspark.sql import functions as F

from tidemart import jobs
from tidemart.catalog import QUERIES
from tidemart.plans import warehouse as plan
from tidemart.sources import formats, views


def run(spark, *argv):
    return jobs.run(spark, jobs.arguments(list(argv)))


def strings(df, *columns):
    return df.withColumns({c: df[c].cast("string") for c in columns})


def test_layer_jobs_and_backfill(spark, sf_dir, tmp_path):
    out, delivered = str(tmp_path / "dw"), str(tmp_path / "feed")
    strings(views.raw_events(spark, sf_dir), "event_id", "user_id", "item_id").write.parquet(delivered)
    strings(views.dim_user(spark, sf_dir), "user_id").write.parquet(f"{out}/dim_user")
    strings(views.dim_item(spark, sf_dir), "item_id").write.parquet(f"{out}/dim_item")
    for job in ("ods", "dwd", "dws", "ads"):
        run(spark, job, out, "--events", delivered)
    assert run(spark, "verify", out).first().row_cnt == QUERIES["build_ads_funnel"](spark, sf_dir).count()
    assert run(spark, "report", out).count() == 15
    total = "SELECT SUM(pay_cnt) AS n, ROUND(SUM(pay_amount), 2) AS s FROM dws_user_daily"
    before = run(spark, "sql", out, "--query", total).collect()
    spoiled = plan.build_dws(spark.read.parquet(f"{out}/dwd_user_action").where("dt = DATE '2024-01-05'"))
    formats.overwrite_partitions(spoiled.withColumn("pay_cnt", F.lit(0)), f"{out}/dws_user_daily")
    spark.catalog.refreshByPath(out)
    assert run(spark, "sql", out, "--query", total).collect() != before
    run(spark, "backfill", out, "--from", "2024-01-04", "--to", "2024-01-06")
    spark.catalog.refreshByPath(out)
    assert run(spark, "sql", out, "--query", total).collect() == before


def test_backfill_sees_copies_on_other_days(spark, tmp_path):
    ms = 1704067200000
    raw = feed(spark, dict(event_id=1, event_ts=ms), dict(event_id=1, event_ts=ms + 86_400_000),
               dict(event_id=2, event_ts=ms + 86_400_000))
    dims = users(spark, {}), items(spark, {})
    layers = plan.run_layers(spark, raw, *dims, str(tmp_path))
    want = sorted(map(tuple, layers["dwd_user_action"].collect()))
    plan.backfill(spark, *dims, str(tmp_path), dt.date(2024, 1, 2), dt.date(2024, 1, 2))
    assert sorted(map(tuple, spark.read.schema(layers["dwd_user_action"].schema).parquet(
        f"{tmp_path}/dwd_user_action").select(*layers["dwd_user_action"].columns).collect())) == want
    assert len(want) == 2


def stored(spark, df, path):
    return sorted(map(tuple, spark.read.schema(df.schema).parquet(path).select(*df.columns).collect()), key=repr)


def test_a_withdrawn_day_is_emptied(spark, tmp_path):
    ms, day = 1704067200000, 86_400_000
    raw = feed(spark, *[dict(event_id=i, event_ts=ms + i % 3 * day) for i in range(9)])
    dims, out = (users(spark, {}), items(spark, {})), str(tmp_path / "dw")
    layers = plan.run_layers(spark, raw, *dims, out)
    formats.replace_days(layers["ods_events"].where("false"), f"{out}/ods_events", [dt.date(2024, 1, 2)])
    plan.backfill(spark, *dims, out, dt.date(2024, 1, 2), dt.date(2024, 1, 2))
    for name in ("dwd_user_action", "dws_user_daily", "ads_funnel_daily"):
        left = spark.read.schema(layers[name].schema).parquet(f"{out}/{name}")
        assert {r.dt.day for r in left.select("dt").collect()} == {1, 3}, name


def test_an_earlier_copy_moves_the_event_to_its_day(spark, tmp_path):
    ms, day = 1704067200000, 86_400_000
    dims, out = (users(spark, {}), items(spark, {})), str(tmp_path / "dw")
    first = feed(spark, dict(event_id=1, event_ts=ms + 2 * day), dict(event_id=2, event_ts=ms + 2 * day))
    late = feed(spark, dict(event_id=1, event_ts=ms))
    layers = plan.run_layers(spark, first, *dims, out)
    assert plan.increment(spark, late, *dims, out) == [dt.date(2024, 1, 1)]
    want = plan.build_dwd(plan.build_ods(first.unionByName(late)), *dims)
    assert stored(spark, layers["dwd_user_action"], f"{out}/dwd_user_action") == sorted(map(tuple, want.collect()), key=repr)
    assert stored(spark, layers["ads_funnel_daily"], f"{out}/ads_funnel_daily") == sorted(map(tuple, plan.build_ads(want).collect()), key=repr)


def test_daily_increments_give_what_one_load_gives(spark, sf_dir, tmp_path):
    raw, dims = views.raw_events(spark, sf_dir).where("event_ts < 1704067200000 + 4 * 86400000"), (
        views.dim_user(spark, sf_dir), views.dim_item(spark, sf_dir))
    out = str(tmp_path / "dw")
    for name, dim in zip(("dim_user", "dim_item"), dims, strict=True):
        dim.write.parquet(f"{out}/{name}")
    whole = plan.run_layers(spark, raw, *dims, str(tmp_path / "whole"))
    plan.run_layers(spark, raw.where("event_ts < 1704067200000 + 2 * 86400000"), *dims, out)
    for n in (2, 3, 3):
        path = str(tmp_path / f"delivery{n}")
        raw.where(f"floor((event_ts - 1704067200000) / 86400000) = {n}").write.mode("overwrite").parquet(path)
        run(spark, "increment", out, "--events", path)
    for name in ("dwd_user_action", "dws_user_daily"):
        assert stored(spark, whole[name], f"{out}/{name}") == stored(spark, whole[name], str(tmp_path / "whole" / name))


def test_answers_are_written_or_cut_with_a_word(spark, tmp_path, capsys):
    args = jobs.arguments(["sql", "x", "--limit", "3"])
    jobs.deliver(spark.range(5), args)
    assert "more than 3 rows" in capsys.readouterr().out
    jobs.deliver(spark.range(3), args)
    assert "more than" not in capsys.readouterr().out
    jobs.deliver(spark.range(5), jobs.arguments(["sql", "x", "--out", str(tmp_path / "answer")]))
    assert spark.read.parquet(str(tmp_path / "answer")).count() == 5


def test_event_time_and_arrival_jobs(spark, tmp_path):
    out, inbox = str(tmp_path / "dw"), tmp_path / "in"
    inbox.mkdir()
    line = lambda i, s: json.dumps({"event_id": str(i), "user_id": "u", "country": "US", "event_ts": 1704067200000 + s * 1000})
    (inbox / "1.json").write_text("\n".join(line(i, i) for i in range(50)) + "\n" + line(99, 9000))
    run(spark, "pv-event-time", out, "--events", str(inbox))
    assert [r.pv for r in spark.read.parquet(f"{out}/pv_event_time").collect()] == [50]
    query = jobs.stream_job(spark, jobs.arguments(["pv-arrival", out, "--events", str(inbox), "--trigger", "1 second"]), out)
    try:
        query.processAllAvailable()
        assert query.lastProgress.stateOperators[0].numRowsTotal == 1  # all arrive in one minute, whatever their event time
    finally:
        query.stop()


def test_streaming_job_restarts_where_it_stopped(spark, tmp_path):
    out, inbox = str(tmp_path / "dw"), tmp_path / "in"
    inbox.mkdir()
    line = lambda i, s, u: json.dumps({"event_id": str(i), "user_id": u, "country": "US", "event_ts": 1704067200000 + s * 1000})
    (inbox / "1.json").write_text("\n".join([line(1, 0, "a"), line(2, 3, "b"), "broken"]))
    run(spark, "pv-uv", out, "--events", str(inbox))
    (inbox / "2.json").write_text("\n".join([line(3, 59, "a"), line(4, 9000, "a")]))
    run(spark, "pv-uv", out, "--events", str(inbox))
    got = [(r.window_start, r.pv, r.uv) for r in spark.read.parquet(f"{out}/rt_pv_1min").collect()]
    assert got == [(at(0), 3, 2)]


def test_exact_money_stays_decimal(spark, sf_dir):
    ods = plan.build_ods(views.raw_events(spark, sf_dir), exact_money=True)
    dwd = plan.build_dwd(ods, views.dim_user(spark, sf_dir), views.dim_item(spark, sf_dir))
    assert dict(plan.build_ads(dwd).dtypes)["gmv"].startswith("decimal")
    assert dict(plan.build_dws(dwd).dtypes)["pay_amount"].startswith("decimal")
