"""Two tables compared by digests of their rows."""

import re

import pytest
from helpers import final_plan
from pyspark.sql import functions as F

from tidemart.operators import checks

SCHEMA = "id long, name string, x double, day date, tags array<string>"


@pytest.fixture(scope="module")
def table(spark):
    return spark.range(5000).selectExpr(
        "id", "if(id % 7 = 0, null, concat('n', id % 100)) AS name", "if(id % 5 = 0, null, id / 3) AS x",
        "date_add(DATE '2024-01-01', cast(id % 30 AS int)) AS day", "if(id % 11 = 0, null, array('a', null, concat('t', id % 3))) AS tags",
    )


def verdict(a, b):
    return tuple(checks.same_rows(a, b).first())


def differences(a, b):
    return sorted((r.id, r.surplus) for r in checks.row_differences(a, b).collect())


def test_order_layout_and_column_order_do_not_matter(table):
    other = table.repartition(7, "name").sortWithinPartitions("x").select("tags", "x", "id", "day", "name")
    assert verdict(table, other) == (5000, 5000, True, True) and differences(table, other) == []


def test_a_changed_a_lost_and_a_doubled_row_are_found(table):
    changed = table.withColumn("x", F.when(F.col("id") == 17, -1.0).otherwise(F.col("x")))
    assert verdict(table, changed) == (5000, 5000, True, False) and differences(table, changed) == [(17, -1), (17, 1)]
    lost = table.where("id <> 4321")
    assert verdict(table, lost) == (5000, 4999, False, False) and differences(table, lost) == [(4321, 1)]
    doubled = table.unionByName(table.where("id = 5"))
    assert verdict(table, doubled) == (5000, 5001, False, False) and differences(table, doubled) == [(5, -1)]
    swapped = lost.unionByName(table.where("id = 5"))
    assert verdict(table, swapped) == (5000, 5000, True, False) and differences(table, swapped) == [(5, -1), (4321, 1)]


def test_missing_values_count_and_where_they_are(spark):
    a = spark.createDataFrame([(1, None, "x"), (None, None, None)], "id long, p string, q string")
    b = spark.createDataFrame([(1, "x", None), (None, None, None)], "id long, p string, q string")
    assert verdict(a, a)[3] and not verdict(a, b)[3] and len(differences(a, b)) == 2


def test_numbers_of_other_types_and_zeros(spark):
    a = spark.createDataFrame([(1, 0.0), (2, float("nan"))], "id long, x double")
    b = spark.createDataFrame([(1, -0.0), (2, float("nan"))], "id int, x double")
    assert verdict(a, b)[3] and differences(a, b) == []


def test_empty_tables(table):
    none = table.limit(0)
    assert verdict(none, none) == (0, 0, True, True) and differences(none, none) == []
    assert verdict(table, none) == (5000, 0, False, False)
    assert differences(table.where("id < 3"), none) == [(0, 1), (1, 1), (2, 1)]


def test_no_row_is_moved_to_compare_equal_tables(table):
    digest = checks.digests(table)
    assert digest.count() <= checks.BUCKETS and digest.agg(F.sum("n")).first()[0] == 5000
    plan = final_plan(checks.same_rows(table, table.repartition(3)))
    partial = re.findall(r"HashAggregate\(keys=\[_groupingexpression[^\]]*\], functions=\[partial_count", plan) or "partial_count" in plan
    assert partial and "name#" not in "".join(line for line in plan.split("\n") if "Exchange hashpartitioning" in line)


def test_odd_column_names(spark):
    a = spark.createDataFrame([(1, 2)], "`a.b` long, bucket long")
    assert verdict(a, a)[3] and checks.row_differences(a, a.limit(0)).count() == 1
