"""The physical plans that the jobs are meant to get."""

import re

import pytest
from helpers import final_plan, plan_of
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemart.catalog import QUERIES
from tidemart.operators import versioned
from tidemart.operators.joins import attach, spread_join
from tidemart.operators.rows import dedup
from tidemart.plans import analytics, warehouse
from tidemart.sources import formats, views

# Queries that write tables before they read them back; their reading plans are trivial.
LAZY = sorted(
    name for name in QUERIES
    if QUERIES[name].__wrapped__.__module__.rsplit(".", 1)[1] in ("batch", "questions", "warehouse")
    and name not in ("stored_layers_funnel", "layer_row_counts")
)


@pytest.mark.parametrize("name", LAZY)
def test_no_pairing_joins_and_no_window_in_one_task(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert not re.search(r"Window [^\n]*\n(?:[^\n]*(?:Sort|WindowGroupLimit) [^\n]*\n)*[^\n]*Exchange SinglePartition", plan)


def test_the_check_above_sees_a_window_in_one_task(spark):
    df = spark.range(5).withColumn("n", F.row_number().over(Window.orderBy("id")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Window [^\n]*\n(?:[^\n]*(?:Sort|WindowGroupLimit) [^\n]*\n)*[^\n]*Exchange SinglePartition", plan)


def test_point_lookup_reaches_the_scan(spark, sf_dir):
    assert "EqualTo(event_id,777)" in plan_of(QUERIES["point_lookup"](spark, sf_dir))


def test_one_column_is_read_for_one_column(spark, sf_dir):
    assert "ReadSchema: struct<value:double>" in plan_of(QUERIES["global_sum"](spark, sf_dir))
    plan = plan_of(QUERIES["filter_count"](spark, sf_dir))
    assert "ReadSchema: struct<event_type:string>" in plan
    assert "EqualTo(event_type,purchase)" in plan


def test_funnel_reads_no_unused_column_and_copies_no_row(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    dims = views.dim_user(spark, sf_dir), views.dim_item(spark, sf_dir)
    dwd = warehouse.build_dwd(warehouse.build_ods(views.as_feed(events)), *dims)
    two, direct = plan_of(warehouse.build_ads(dwd)), plan_of(warehouse.build_ads(dwd, two_step=False))
    assert "Expand" not in two and "Expand" in direct
    assert "p_retailprice" not in two and "c_acctbal" not in two


def test_dimensions_are_broadcast_only_within_the_limit(spark, sf_dir):
    fact = views.raw_events(spark, sf_dir)
    items = views.dim_item(spark, sf_dir)
    small, large = plan_of(attach(fact, items, "item_id")), plan_of(attach(fact, items, "item_id", limit=0))
    assert "BroadcastHashJoin" in small and "SortMergeJoin" not in small
    assert "SortMergeJoin" in large and "BroadcastHashJoin" not in large


def test_input_of_unknown_size_is_not_broadcast(spark, sf_dir):
    unknown = spark.createDataFrame([(1, "x")], "item_id long, v string")
    assert "BroadcastHashJoin" not in plan_of(attach(views.raw_events(spark, sf_dir), unknown, "item_id"))


def test_forced_shuffle_star_join(spark, sf_dir):
    dims = views.dim_user(spark, sf_dir), views.dim_item(spark, sf_dir)
    plan = plan_of(analytics.star_join(views.ods_events(spark, sf_dir), *dims, spread_join))
    assert plan.split("(1) ")[0].count("SortMergeJoin") == 2


def test_hot_key_is_split_at_run_time(spark):
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        fact = spark.range(0, 200_000, 1, 16).select(
            "id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).alias("k")
        )
        dim = spark.range(1000).select(F.col("id").alias("k"), F.col("id").alias("v"))
        joined = spread_join(fact, dim, "k", "left")
        assert "SortMergeJoin(skew=true)" in final_plan(joined)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_copies_are_reduced_before_the_shuffle(spark, sf_dir):
    plan = plan_of(dedup(views.raw_events(spark, sf_dir), ["event_id"], ["event_ts"])).split("(1) ")[0]
    steps = re.findall(r"WindowGroupLimit|Exchange|Window", plan)
    assert steps == ["Window", "WindowGroupLimit", "Exchange", "WindowGroupLimit"]


def test_recent_days_prune_partitions(spark, sf_dir, tmp_path):
    ods = views.ods_events(spark, sf_dir)
    formats.append_partitioned(ods, str(tmp_path / "ods"), sort_by="event_id")
    stored = spark.read.schema(ods.schema).parquet(str(tmp_path / "ods"))
    plan = plan_of(analytics.recent(stored, views.AS_OF, 7))
    assert re.search(r"PartitionFilters: \[[^\]]*dt[^\]]* >= 2024-01-23", plan)
    assert sorted(p.name for p in (tmp_path / "ods").glob("dt=*"))[0] == "dt=2024-01-01"


def test_as_of_is_an_anti_join_without_a_hint(spark, tmp_path):
    h = versioned.begin(spark.createDataFrame([(i, "SG") for i in range(3)], "id long, country string"), str(tmp_path))
    plan = plan_of(versioned.read_as_of(versioned.delete_where(h, "id = 0")))
    assert "LeftAnti" in plan and "CartesianProduct" not in plan


DATED = (
    "total_gmv_7d top1_country pay_uv_country_day category_gmv_share scalar_subquery_total share_of_total_window overall_conversion "
    "lag_wow_drop arpu_by_age_group channel_gmv_share today_gmv pay_uv_by_country sort_by_ordinal having_vs_total"
).split()


@pytest.mark.parametrize("name", DATED)
def test_dated_questions_prune_days(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    filters = re.findall(r"PartitionFilters: \[([^\n]*)\]", plan)
    assert filters and all("dt" in f for f in filters) and "events.parquet" not in plan


@pytest.mark.parametrize("name", ["build_dws", "conditional_count", "group_sum_small"])
def test_user_days_join_no_dimension(spark, sf_dir, name):
    assert "Join" not in plan_of(QUERIES[name](spark, sf_dir))
