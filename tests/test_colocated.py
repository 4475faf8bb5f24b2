"""Joins of tables that are stored for them."""

import re

import pytest
from helpers import final_plan, plan_of
from pyspark.sql import functions as F

from tidemart.catalog import QUERIES
from tidemart.operators import colocated
from tidemart.plans import analytics


@pytest.fixture(scope="module")
def star(spark):
    """Half of all rows are one user's, some have no user, some users and items are unknown."""
    fact = spark.range(4000).select(
        F.when(F.col("id") % 2 == 0, F.lit(7)).when(F.col("id") % 37 == 0, None).otherwise(F.col("id") % 300).cast("long").alias("user_id"),
        (F.col("id") % 50).alias("item_id"), F.concat(F.lit("c"), F.col("id") % 3).alias("country"), F.col("id").cast("double").alias("amount"))
    users = spark.range(250).select(F.col("id").alias("user_id"), F.concat(F.lit("a"), F.col("id") % 4).alias("age_group"))
    items = spark.range(40).select(F.col("id").alias("item_id"), F.concat(F.lit("b"), F.col("id") % 5).alias("brand"))
    return fact, users, items


@pytest.fixture(scope="module")
def tables(spark, star, tmp_path_factory):
    return colocated.store(star[0], star[1], "user_id", "test_star", str(tmp_path_factory.mktemp("star")), 6)


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_equal_to_the_shuffled_join(spark, star, tables):
    assert rows(analytics.star_join_colocated(spark, tables, star[2])) == rows(analytics.star_join(*star))


def test_hot_and_missing_keys_lie_apart(spark, star, tables):
    hot = spark.table(tables.hot)
    assert hot.where("user_id = 7").count() == star[0].where("user_id = 7").count() > 2000 and hot.where("user_id IS NULL").count() > 0
    assert spark.table(tables.fact).where("user_id = 7 OR user_id IS NULL").count() == 0
    assert rows(colocated.read(spark, tables, star[0].columns).groupBy("country").count()) == rows(star[0].groupBy("country").count())


@pytest.mark.parametrize("how", ["inner", "left"])
def test_both_parts_are_the_join(spark, star, tables, how):
    key = F.expr("concat_ws('/', user_id, item_id, country, amount, age_group)")
    both = [p.select(key) for p in colocated.parts(spark, tables, star[0].columns, ["age_group"], how)]
    assert rows(both[0].union(both[1])) == rows(star[0].join(star[1], "user_id", how).select(key))


def fact_is_moved(plan: str) -> bool:
    """Is there an exchange between the scan of the fact and the first aggregation above it?"""
    tree = plan.split("\n")
    at = next(i for i, line in enumerate(tree) if "_fact" in line)
    up = []
    depth = len(re.match(r"[\s:+|-]*", tree[at])[0])
    for line in reversed(tree[:at]):
        own = len(re.match(r"[\s:+|-]*", line)[0])
        if own < depth:
            up.append(line)
            depth = own
    below = up[: next((i for i, line in enumerate(up) if "HashAggregate" in line), len(up))]
    return any(re.search(r"\bExchange\b", line) for line in below)


def test_the_fact_is_not_moved(spark, star, tables):
    with_buckets = analytics.star_join_colocated(spark, tables, star[2])
    plan = with_buckets._jdf.queryExecution().executedPlan().toString()
    assert not fact_is_moved(plan) and "SortMergeJoin" in plan and "Bucketed: true" in plan


def test_the_check_above_sees_a_moved_fact(spark, star, tables):
    plain = spark.read.parquet(spark.table(tables.fact).inputFiles()[0].rsplit("/", 1)[0])
    moved = plain.join(star[1].hint("merge"), "user_id").groupBy("country").count()
    assert fact_is_moved(moved._jdf.queryExecution().executedPlan().toString())


def test_users_are_counted_where_they_lie(spark, sf_dir):
    plan = QUERIES["colocated_star_join"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not fact_is_moved(plan) and "Bucketed: true" in plan


def test_empty_tables(spark, star, tmp_path):
    fact, users, items = star
    none = colocated.store(fact.limit(0), users, "user_id", "test_none", str(tmp_path / "a"), 3)
    assert analytics.star_join_colocated(spark, none, items).count() == 0
    nobody = colocated.store(fact, users.limit(0), "user_id", "test_nobody", str(tmp_path / "b"), 3)
    assert analytics.star_join_colocated(spark, nobody, items).count() == 0
    assert "Exchange" in plan_of(analytics.star_join(fact, users, items)) and final_plan(fact.limit(1))
