"""Sources and sinks (C rows). Written tables go to a new scratch folder per run."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemart.catalog.registry import query
from tidemart.catalog.sql import DIMS, DWD, ODS, with_
from tidemart.operators.joins import attach
from tidemart.session import scratch_dir
from tidemart.sources import formats, views


@query("SELECT * FROM events")
def scan_parquet(spark, sf_dir):
    return views.load(spark, sf_dir, "events")


@query(with_(ODS, "SELECT * EXCLUDE (dt) FROM ods"))
def jsonl_ingest(spark, sf_dir):
    raw = views.raw_events(spark, sf_dir)
    path = scratch_dir(spark, "jsonl")
    formats.write_jsonl(raw, path)
    return formats.read_jsonl(spark, path, raw.schema)


@query(with_(ODS, """
SELECT f.format, o.* FROM (SELECT * EXCLUDE (dt) FROM ods) o
CROSS JOIN (VALUES ('csv'), ('csv_gz'), ('parquet_snappy'), ('parquet_zstd')) f(format)"""))
def format_roundtrip(spark, sf_dir):
    """All rows as they come back from each of the four formats."""
    raw = views.raw_events(spark, sf_dir)
    path = scratch_dir(spark, "formats")
    back = None
    for name in formats.FORMATS:
        formats.write_as(raw, name, f"{path}/{name}")
        rows = formats.read_as(spark, name, f"{path}/{name}", raw.schema).select(F.lit(name).alias("format"), "*")
        back = rows if back is None else back.unionByName(rows)
    return back


@query(with_(ODS, "SELECT * FROM ods UNION ALL SELECT * FROM ods"))
def partitioned_append(spark, sf_dir):
    """Two appends to a day-partitioned table."""
    ods = views.ods_events(spark, sf_dir)
    path = scratch_dir(spark, "append")
    formats.append_partitioned(ods, path)
    formats.append_partitioned(ods, path)
    return spark.read.schema(ods.schema).parquet(path).select(*ods.columns)


@query(with_(DIMS, "SELECT * FROM dim_item"))
def create_table_as(spark, sf_dir):
    """Created twice: the second run replaces the first. The name is the run's own, so that two
    runs do not meet."""
    items = views.dim_item(spark, sf_dir)
    path = scratch_dir(spark, "ctas")
    name = "tidemart_" + path.rsplit("/", 1)[1].replace("-", "_")
    formats.rebuild_table(items, name, path)
    return formats.rebuild_table(items, name, path)


@query(with_(DWD, """
SELECT d.category, u.age_group, COUNT(*) AS pay_count, ROUND(SUM(d.amount), 2) AS gmv
FROM (SELECT user_id, item_category AS category, amount FROM dwd WHERE action_type = 'pay') d
JOIN dim_user u ON d.user_id = u.user_id GROUP BY 1, 2"""))
def multi_source_join(spark, sf_dir):
    """Facts from Parquet, users from CSV, items from JSON Lines; a JDBC table would be one
    more reader."""
    path = scratch_dir(spark, "sources")
    users = views.dim_user(spark, sf_dir).select("user_id", "age_group")
    items = views.dim_item(spark, sf_dir).select("item_id", "category")
    formats.write_as(users, "csv", f"{path}/users")
    formats.write_jsonl(items, f"{path}/items")
    facts = views.raw_events(spark, sf_dir).where("action_type = 'pay'").select("user_id", "item_id", "amount")
    joined = attach(
        attach(facts, formats.read_as(spark, "csv", f"{path}/users", users.schema), "user_id", "inner"),
        formats.read_jsonl(spark, f"{path}/items", items.schema), "item_id", "left",
    )
    return joined.groupBy("category", "age_group").agg(
        F.count(F.lit(1)).alias("pay_count"), F.round(F.sum("amount"), 2).alias("gmv")
    )


@query(with_(ODS, """
SELECT * REPLACE (CASE WHEN dt >= DATE '2024-01-20' THEN amount ELSE 0 END AS amount) FROM ods"""))
def partition_overwrite(spark, sf_dir):
    """A table with wrong amounts, of which the days from 20 January on are computed again."""
    ods = views.ods_events(spark, sf_dir)
    path = scratch_dir(spark, "overwrite")
    formats.append_partitioned(ods.withColumn("amount", F.lit(0.0)), path)
    formats.overwrite_partitions(ods.where(F.col("dt") >= F.lit(dt.date(2024, 1, 20))), path)
    return spark.read.schema(ods.schema).parquet(path).select(*ods.columns)
