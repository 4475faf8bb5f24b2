"""Users from stored sketches: error bound, merging, plans, refresh."""

import datetime as dt

import pytest
from helpers import feed, items, plan_of, users
from pyspark.sql import functions as F

from tidemart import jobs
from tidemart.catalog import QUERIES
from tidemart.operators import sketches as sk
from tidemart.plans import warehouse as plan

DAY = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def days(spark):
    """Ten days of 60,000 users each, of whom 10,000 are new every day; a third of all rows is one user."""
    rows = spark.range(0, 60_000 * 10).selectExpr(
        "date_add(DATE '2024-01-01', cast(id div 60000 as int)) AS dt", "id % 60000 + 10000 * (id div 60000) AS user_id")
    hot = rows.withColumn("user_id", F.lit(5).cast("long")).limit(300_000)
    nobody = rows.limit(1000).withColumn("user_id", F.lit(None).cast("long"))
    return rows.unionByName(hot).unionByName(nobody)


@pytest.mark.parametrize("first, last", [(0, 0), (0, 9), (3, 8), (9, 9)])
def test_estimates_stay_within_the_bound(days, first, last):
    stored = sk.sketch_users(days, ["dt"])
    span = DAY + dt.timedelta(first), DAY + dt.timedelta(last)
    got = sk.users_between(stored, *span).first()
    exact = days.where(F.col("dt").between(*span)).agg(F.countDistinct("user_id").alias("n"), F.count(F.lit(1)).alias("e")).first()
    assert abs(got.uv - exact.n) <= 4 * sk.relative_error() * exact.n
    assert got.events == exact.e


def test_a_merged_sketch_counts_like_one_over_all_rows(days):
    merged = sk.count_users(sk.sketch_users(days, ["dt"])).first().uv
    exact = days.agg(F.countDistinct("user_id")).first()[0]
    assert abs(merged - exact) <= 4 * sk.relative_error() * exact
    again = sk.sketch_users(days, ["dt"])
    assert sk.count_users(again.unionByName(again)).first().uv == merged


def test_rolling_users(days):
    got = {r.dt: r.uv for r in sk.rolling_users(sk.sketch_users(days, ["dt"]), 3).collect()}
    assert sorted(got) == [DAY + dt.timedelta(n) for n in range(10)]
    for day, uv in got.items():
        exact = days.where(F.col("dt").between(day - dt.timedelta(2), day)).agg(F.countDistinct("user_id")).first()[0]
        assert abs(uv - exact) <= 4 * sk.relative_error() * exact


def test_small_groups_are_exact(spark):
    rows = spark.range(3000).selectExpr("DATE '2024-01-01' AS dt", "id % 700 AS user_id", "id % 3 AS g")
    assert {(r.g, r.uv) for r in sk.count_users(sk.sketch_users(rows, ["dt", "g"]), ["g"]).collect()} == {(0, 700), (1, 700), (2, 700)}


def test_empty_and_null(spark):
    none = spark.createDataFrame([], "dt date, user_id long")
    assert sk.sketch_users(none, ["dt"]).count() == 0
    assert sk.rolling_users(sk.sketch_users(none, ["dt"]), 7).count() == 0
    null = spark.createDataFrame([(DAY, None), (DAY, None)], "dt date, user_id long")
    assert tuple(sk.count_users(sk.sketch_users(null, ["dt"])).first()) == (0, 2)


@pytest.mark.parametrize("name", ["approx_uv", "users_last_days", "rolling_users_7_days"])
def test_no_event_is_read_and_no_row_copied_for_a_distinct_count(spark, sf_dir, name):
    text = plan_of(QUERIES[name](spark, sf_dir))
    assert "events.parquet" not in text and "dws_uv_sketches" in text and "Expand" not in text


def test_a_span_reads_its_days_only(spark, sf_dir):
    text = plan_of(QUERIES["users_last_days"](spark, sf_dir))
    assert "PartitionFilters: [isnotnull(dt" in text and "2024-01-24" in text


def test_an_increment_refreshes_the_sketches_of_its_days(spark, tmp_path):
    out = str(tmp_path)
    dims = users(spark, {}), items(spark, {})
    day = lambda n: 1704067200000 + n * 86_400_000
    plan.run_layers(spark, feed(spark, dict(event_id=1, user_id=1), dict(event_id=2, user_id=2, event_ts=day(1))), *dims, out)
    for df, name in zip(dims, ("dim_user", "dim_item"), strict=True):
        df.write.parquet(f"{out}/{name}")
    jobs.run(spark, jobs.arguments(["sketches", out]))
    ask = ["uv", out, "--from", "2024-01-01", "--to", "2024-01-02"]
    assert [r.uv for r in jobs.run(spark, jobs.arguments(ask)).collect()] == [2]
    plan.increment(spark, feed(spark, dict(event_id=3, user_id=3, event_ts=day(1)), dict(event_id=2, user_id=2, event_ts=day(1))), *dims, out)
    assert [(r.uv, r.events) for r in jobs.run(spark, jobs.arguments(ask)).collect()] == [(3, 3)]
    assert [r.uv for r in jobs.run(spark, jobs.arguments([*ask[:-1], "2024-01-01"])).collect()] == [1]
