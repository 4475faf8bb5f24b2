"""Micro fixtures for the warehouse layers and their operators (M1 to M6, M14)."""

import datetime as dt

import pytest
from helpers import feed, items, users
from pyspark.sql import functions as F

from tidemart.functions import event_day, event_time, pct
from tidemart.operators import checks
from tidemart.operators.aggregates import change_vs_previous, retention, share_of_total
from tidemart.operators.joins import attach, compare_by_key, hot_keys, salted_join
from tidemart.operators.rows import dedup, first_seen, upsert_latest
from tidemart.plans import warehouse as plan

MS = 1704067200000


def test_missing_users_and_dimensions(spark):
    raw = feed(spark, dict(event_id=1, user_id=None), dict(event_id=2, user_id=99), dict(event_id=3, item_id=99),
               dict(event_id=4, item_id=None))
    dwd = plan.build_dwd(plan.build_ods(raw), users(spark, {}), items(spark, {}))
    got = {r.event_id: r for r in dwd.collect()}
    assert set(got) == {2, 3, 4}
    assert (got[2].user_channel, got[2].age_group, got[2].item_brand) == (None, None, "b1")
    assert (got[3].user_channel, got[3].item_category) == ("ads", None)
    assert (got[4].item_id, got[4].item_brand) == (None, None)


def test_dimension_columns_win_only_where_they_should(spark):
    dwd = plan.build_dwd(plan.build_ods(feed(spark, {})), users(spark, {}), items(spark, {})).first()
    assert dwd.country == "US"
    assert dwd.item_category == "books"
    assert dwd.user_channel == "ads"


@pytest.mark.parametrize("limit", [2**70, 0])
def test_large_and_small_dimensions_give_the_same_detail(spark, limit):
    raw = feed(spark, *[dict(event_id=i, user_id=i % 5 if i % 7 else None, item_id=i % 4) for i in range(100)])
    dims = users(spark, *[dict(user_id=i, channel=f"c{i}") for i in range(3)]), items(spark, *[dict(item_id=i) for i in range(2)])
    a = plan.build_dwd(plan.build_ods(raw), *dims)
    b = plan.build_dwd(plan.build_ods(raw), *dims, limit=limit)
    assert checks.row_differences(a, b).isEmpty()


def test_dedup_keeps_the_earliest(spark):
    raw = feed(spark, dict(event_ts=MS + 2), dict(event_ts=MS + 1, device="iOS"), dict(event_ts=MS + 3))
    got = dedup(raw, ["event_id"], ["event_ts", "user_id"]).collect()
    assert [(r.event_ts, r.device) for r in got] == [(MS + 1, "iOS")]


def test_dedup_treats_missing_keys_as_one_key(spark):
    raw = feed(spark, dict(event_id=None), dict(event_id=None), dict(event_id=5))
    assert dedup(raw, ["event_id"], ["event_ts"]).count() == 2


def test_day_is_the_utc_day(spark):
    df = spark.createDataFrame([(1704067199999,), (1704067200000,)], "ms long")
    got = df.select(event_day("ms").alias("d"), event_time("ms").alias("t")).collect()
    assert [r.d for r in got] == [dt.date(2023, 12, 31), dt.date(2024, 1, 1)]
    assert got[0].t == dt.datetime(2023, 12, 31, 23, 59, 59, 999000)


def test_percentage_of_nothing_is_null(spark):
    df = spark.createDataFrame([(1, 0), (1, 3)], "a long, b long")
    assert [r.p for r in df.select(pct("a", "b").alias("p")).collect()] == [None, 33.33]


def test_changes_without_a_usable_previous_week_are_dropped(spark):
    rows = [("A", 1, 0.0), ("A", 2, 5.0), ("A", 3, 4.0), ("B", 1, 9.0), ("C", 1, 10.0), ("C", 2, 9.5)]
    df = spark.createDataFrame(rows, "country string, wk int, gmv double")
    got = change_vs_previous(df, "country", "wk", "gmv", -0.1).collect()
    assert [(r.country, r.wk, r.prev_gmv) for r in got] == [("A", 3, 5.0)]
    assert change_vs_previous(df, "country", "wk", "gmv").count() == 2


def test_user_in_two_categories(spark):
    raw = feed(spark, dict(event_id=1, action_type="impression", item_id=1),
               dict(event_id=2, action_type="impression", item_id=2),
               dict(event_id=3, action_type="pay", item_id=2, amount=2.5),
               dict(event_id=4, action_type="pay", item_id=2, amount=1.0))
    dims = items(spark, dict(item_id=1, category="a"), dict(item_id=2, category="b"))
    for two_step in (True, False):
        ads = plan.build_ads(plan.build_dwd(plan.build_ods(raw), users(spark, {}), dims), two_step)
        got = {r.category: (r.impression_uv, r.click_uv, r.pay_uv, r.gmv) for r in ads.collect()}
        assert got == {"a": (1, 0, 0, 0.0), "b": (1, 0, 1, 3.5)}
        report = plan.funnel_report(ads).first()
        assert (report.imp_uv, report.pay_uv, report.imp_to_pay_pct, report.gmv) == (2, 1, 50.0, 3.5)


def test_distinct_users_ignore_missing_ids_in_both_forms(spark):
    df = feed(spark, dict(user_id=None, action_type="pay", amount=4.0), dict(user_id=2, action_type="pay"))
    df = plan.build_ods(df).drop("category").withColumn("item_category", F.lit("x"))
    for two_step in (True, False):
        row = plan.build_ads(df, two_step).first()
        assert (row.pay_uv, row.gmv) == (1, 4.0)


def test_user_day_counts(spark):
    raw = feed(spark, dict(event_id=1, session_id="a"), dict(event_id=2, session_id="b", action_type="pay", amount=3.0),
               dict(event_id=3, session_id="b", country="DE"))
    dws = plan.build_dws(plan.build_dwd(plan.build_ods(raw), users(spark, {}), items(spark, {})))
    got = {r.country: (r.click_cnt, r.pay_cnt, r.pay_amount, r.session_cnt) for r in dws.collect()}
    assert got == {"US": (1, 1, 3.0, 2), "DE": (1, 0, 0.0, 1)}


def test_stored_layers_can_be_built_again(spark, tmp_path):
    raw = feed(spark, *[dict(event_id=i, event_ts=MS + i * 40_000_000, action_type="pay", amount=1.0) for i in range(5)])
    for _ in range(2):
        layers = plan.run_layers(spark, raw, users(spark, {}), items(spark, {}), str(tmp_path / "dw"))
    counts = {r.layer: r.row_cnt for r in checks.row_counts(layers).collect()}
    assert counts == {"ods_events": 5, "dwd_user_action": 5, "dws_user_daily": 2, "ads_funnel_daily": 2}
    assert (tmp_path / "dw" / "ods_events" / "dt=2024-01-02").is_dir()


def test_salted_join_equals_plain_join(spark):
    fact = spark.range(4000).select("id", F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, 7)
                                    .otherwise(F.col("id") % 50).cast("long").alias("k"))
    dim = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    hot = {r.k for r in hot_keys(fact, ["k"]).collect()}
    assert {None, 7} <= hot and len(hot) <= 200
    for how in ("left", "inner"):
        assert checks.row_differences(salted_join(fact, dim, "k", how, hint="merge"), fact.join(dim, "k", how)).isEmpty()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert checks.row_differences(attach(fact, dim, "k", "left", 0), fact.join(dim, "k", "left")).isEmpty()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_shares_add_up_over_groups_or_over_a_given_total(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 1.0)], "c string, gmv double")
    assert {r.c: r.pct for r in share_of_total(df, ["c"], "gmv").collect()} == {"a": 75.0, "b": 25.0}
    half = spark.createDataFrame([(8.0,)], "t double")
    assert {r.c: r.pct for r in share_of_total(df, ["c"], "gmv", half).collect()} == {"a": 37.5, "b": 12.5}


def test_retention_counts_users_that_never_came_back(spark):
    day = dt.date(2024, 1, 1)
    dim = users(spark, dict(user_id=1), dict(user_id=2), dict(user_id=3, register_date=day + dt.timedelta(1)))
    seen = spark.createDataFrame([(1, day), (1, day), (1, day + dt.timedelta(7)), (2, day), (3, day)], "user_id long, dt date")
    got = {(r.register_date.day, r.day_offset): (r.retained_users, r.total_new_users, r.retention_rate)
           for r in retention(dim, seen).collect()}
    assert got[(1, 0)] == (2, 2, 1.0)
    assert got[(1, 7)] == (1, 2, 0.5)
    assert got[(1, 30)] == (0, 2, 0.0)
    assert got[(2, 0)] == (0, 1, 0.0)
    assert len(got) == 8


def test_one_sided_rows_of_a_comparison_keep_their_keys(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "k string, pv int")
    b = spark.createDataFrame([("y", 5), ("z", 3)], "k string, pv int")
    got = {r.k: (r.a, r.b, r["diff"]) for r in compare_by_key(a, b, ["k"], "pv", ("a", "b")).collect()}
    assert got == {"x": (1, None, -1), "y": (2, 5, 3), "z": (None, 3, 3)}


def test_latest_update_wins_and_new_keys_are_added(spark):
    dim = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    updates = spark.createDataFrame([(2, "old", 1), (2, "new", 2), (3, "c", 1)], "k long, v string, n int")
    assert sorted(map(tuple, upsert_latest(dim, updates, "k", "n").collect())) == [(1, "a"), (2, "new"), (3, "c")]


def test_first_seen_value(spark):
    df = spark.createDataFrame([(1, "DE", 5), (1, "US", 3), (2, "FR", 1)], "u long, c string, t int")
    assert {r.u: r.c for r in first_seen(df, "u", "c", ["t"]).collect()} == {1: "US", 2: "FR"}


def test_same_size_is_not_the_same_result(spark):
    a = spark.createDataFrame([(1, None), (2, "x"), (2, "x")], "n int, s string")
    b = spark.createDataFrame([(1, None), (2, "x"), (3, "x")], "n int, s string")
    assert tuple(checks.same_rows(a, b).first()) == (3, 3, True, False)
    assert tuple(checks.same_rows(a, a).first()) == (3, 3, True, True)
    assert tuple(checks.same_rows(a, a.limit(0)).first()) == (3, 0, False, False)


def test_empty_table_fails_the_check(spark):
    with pytest.raises(Exception, match="ads has no rows"):
        checks.require_rows(spark.range(0), "ads").collect()
    assert tuple(checks.require_rows(spark.range(3), "ads").first()) == ("ads", 3)
