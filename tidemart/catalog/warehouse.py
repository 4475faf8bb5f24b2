"""Warehouse layers (G rows), the layer checks and the board charts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.catalog.registry import query
from tidemart.catalog.sql import ADS, DIMS, DWD, DWS, ODS, REPLAYED, dwd_from, with_
from tidemart.catalog.stored import stored_folder
from tidemart.operators import checks
from tidemart.operators.aggregates import retention
from tidemart.operators.joins import attach
from tidemart.operators.rows import upsert_latest
from tidemart.operators.sessions import active_seconds, session_totals
from tidemart.operators.sessions import sessionize as add_session_no
from tidemart.plans import warehouse as plan
from tidemart.session import scratch_dir
from tidemart.sources import formats, views


_STORED: dict[tuple, tuple[str, dict]] = {}


def stored_layers(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The four layers, stored below the shared folder once per application and state of the
    source files, as an analyst finds them."""
    state = (spark.sparkContext.applicationId, sf_dir, *(
        views.source_state(spark, sf_dir, t) for t in ("events", "customer", "nation", "region", "part")))
    if state not in _STORED:
        folder = scratch_dir(spark, "layers")
        layers = plan.run_layers(
            spark, views.raw_events(spark, sf_dir), views.dim_user(spark, sf_dir), views.dim_item(spark, sf_dir), folder)
        _STORED[state] = folder, {name: df.schema for name, df in layers.items()}
    folder, schemas = _STORED[state]
    return {name: spark.read.schema(schema).parquet(f"{folder}/{name}").select(*schema.names) for name, schema in schemas.items()}


def uv_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored sketches of users per day, country and step."""
    folder = stored_folder(spark, sf_dir, "sketches", ("events",), lambda out: plan.store(
        spark, plan.build_uv_sketches(views.ods_events(spark, sf_dir)), out, "dws_uv_sketches"))
    return spark.read.parquet(f"{folder}/dws_uv_sketches")


def dwd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_layers(spark, sf_dir)["dwd_user_action"]


def dws(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_layers(spark, sf_dir)["dws_user_daily"]


def ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_layers(spark, sf_dir)["ads_funnel_daily"]


def _cents(df: DataFrame, *columns: str) -> DataFrame:
    """Sums of doubles depend on their order in the last bits."""
    return df.withColumns({c: F.round(c, 2) for c in columns})


@query(with_(ODS, "SELECT * FROM ods"))
def build_ods(spark, sf_dir):
    return plan.build_ods(views.raw_events(spark, sf_dir))


@query(with_(f"{REPLAYED},{DIMS},{dwd_from('replayed_ods')}", "SELECT * FROM dwd"))
def build_dwd(spark, sf_dir):
    """On the feed with copies and lost user ids, so that cleaning has something to do."""
    ods = plan.build_ods(views.replayed_events(spark, sf_dir))
    return plan.build_dwd(ods, views.dim_user(spark, sf_dir), views.dim_item(spark, sf_dir))


@query(with_(DWS, "SELECT * REPLACE (ROUND(pay_amount, 2) AS pay_amount) FROM dws"))
def build_dws(spark, sf_dir):
    """From the events: the user days need no dimension."""
    return _cents(plan.build_dws(plan.clean_events(views.ods_events(spark, sf_dir))), "pay_amount")


@query(with_(ADS, "SELECT * REPLACE (ROUND(gmv, 2) AS gmv) FROM ads"))
def build_ads_funnel(spark, sf_dir):
    """From the events; of the dimensions only the items are joined."""
    items = views.dim_item(spark, sf_dir).select("item_id", F.col("category").alias("item_category"))
    detail = attach(plan.clean_events(views.ods_events(spark, sf_dir)), items, "item_id")
    return _cents(plan.build_ads(detail), "gmv")


@query(with_(ADS, "SELECT * REPLACE (ROUND(gmv, 2) AS gmv) FROM ads"))
def backfill_days(spark, sf_dir):
    """Layers of all days but one, of which a wrong amount was delivered too; the day comes
    later, the wrong rows are withdrawn, and the two days are computed again."""
    raw, out = views.raw_events(spark, sf_dir), scratch_dir(spark, "backfill")
    dims = views.dim_user(spark, sf_dir), views.dim_item(spark, sf_dir)
    day = F.to_date(F.timestamp_millis("event_ts"))
    missing, spoiled = F.lit("2024-01-20").cast("date"), F.lit("2024-01-10").cast("date")
    wrong = raw.where(day == spoiled).withColumns({"event_id": F.col("event_id") + 10**9, "amount": F.lit(1.0)})
    plan.run_layers(spark, raw.where(day != missing).unionByName(wrong), *dims, out)
    right = plan.build_ods(raw.where((day == missing) | (day == spoiled)))
    formats.overwrite_partitions(right, f"{out}/ods_events")
    plan.refresh_days(spark, *dims, out, [dt.date(2024, 1, 10), dt.date(2024, 1, 20)])
    schema = plan.build_ads(plan.build_dwd(plan.build_ods(raw), *dims)).schema
    return _cents(spark.read.schema(schema).parquet(f"{out}/ads_funnel_daily").select(*schema.names), "gmv")


@query(with_(ADS, "SELECT * REPLACE (ROUND(gmv, 2) AS gmv) FROM ads"))
def stored_layers_funnel(spark, sf_dir):
    """The funnel read from stored layers: every layer is written and the next reads it."""
    return _cents(stored_layers(spark, sf_dir)["ads_funnel_daily"], "gmv")


@query(with_(ADS, """
SELECT dt, country, CAST(SUM(impression_uv) AS BIGINT) AS imp_uv, CAST(SUM(click_uv) AS BIGINT) AS clk_uv,
  CAST(SUM(pay_uv) AS BIGINT) AS pay_uv,
  ROUND(CAST(SUM(pay_uv) AS DOUBLE) * 100.0 / NULLIF(CAST(SUM(impression_uv) AS DOUBLE), 0), 2) AS imp_to_pay_pct,
  ROUND(SUM(gmv), 2) AS gmv
FROM ads GROUP BY dt, country ORDER BY dt DESC, gmv DESC, country LIMIT 15"""))
def funnel_report(spark, sf_dir):
    return plan.funnel_report(ads(spark, sf_dir))


@query(with_(DWD, """
SELECT item_id, dt,
  COUNT(*) FILTER (action_type = 'impression') AS impression_cnt, COUNT(*) FILTER (action_type = 'click') AS click_cnt,
  COUNT(*) FILTER (action_type = 'add_cart') AS add_cart_cnt, COUNT(*) FILTER (action_type = 'order') AS order_cnt,
  COUNT(*) FILTER (action_type = 'pay') AS pay_cnt, ROUND(COALESCE(SUM(amount), 0), 2) AS pay_amount,
  COUNT(DISTINCT user_id) AS user_cnt
FROM dwd GROUP BY item_id, dt"""))
def build_dws_item_daily(spark, sf_dir):
    return _cents(plan.build_item_daily(dwd(spark, sf_dir)), "pay_amount")


@query(with_(f"{ODS},{DIMS}", """
SELECT u.register_date, CAST(o.day_offset AS INTEGER) AS day_offset,
  COUNT(DISTINCT a.user_id) AS retained_users, COUNT(DISTINCT u.user_id) AS total_new_users,
  ROUND(COUNT(DISTINCT a.user_id) / CAST(COUNT(DISTINCT u.user_id) AS DOUBLE), 4) AS retention_rate
FROM dim_user u CROSS JOIN (VALUES (0), (1), (7), (30)) o(day_offset)
LEFT JOIN ods a ON a.user_id = u.user_id AND a.dt = u.register_date + CAST(o.day_offset AS INTEGER)
GROUP BY u.register_date, o.day_offset"""))
def retention_daily(spark, sf_dir):
    return retention(views.dim_user(spark, sf_dir), views.ods_events(spark, sf_dir))


_SESSIONS = ODS + """,
gaps AS (
  SELECT event_id, user_id, make_timestamp(event_ts * 1000) AS ts,
    event_ts - LAG(event_ts) OVER (PARTITION BY user_id ORDER BY event_ts, event_id) AS gap_ms
  FROM ods),
sessions AS (
  SELECT event_id, user_id, ts, CAST(SUM(CASE WHEN gap_ms < 1800000 THEN 0 ELSE 1 END)
    OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_no
  FROM gaps),
totals AS (
  SELECT user_id, session_no, MIN(ts) AS session_start, MAX(ts) AS last_event, COUNT(*) AS events
  FROM sessions GROUP BY user_id, session_no)"""


def _timed(spark, sf_dir):
    ods = views.ods_events(spark, sf_dir)
    return ods.select("event_id", "user_id", F.timestamp_millis("event_ts").alias("ts"))


@query(with_(_SESSIONS, "SELECT event_id, user_id, session_no FROM sessions"))
def sessionize(spark, sf_dir):
    return add_session_no(_timed(spark, sf_dir), "user_id", "ts").select("event_id", "user_id", "session_no")


@query(with_(_SESSIONS, "SELECT * FROM totals"))
def session_list(spark, sf_dir):
    out = session_totals(_timed(spark, sf_dir), "user_id", "ts")
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "last_event")})


@query(with_(_SESSIONS, """
SELECT user_id, CAST(session_start AS DATE) AS dt,
  CAST(SUM(epoch_us(last_event) - epoch_us(session_start)) AS BIGINT) // 1000000 AS active_seconds,
  COUNT(*) AS session_cnt
FROM totals GROUP BY user_id, CAST(session_start AS DATE)"""))
def active_seconds_daily(spark, sf_dir):
    return active_seconds(_timed(spark, sf_dir), "user_id", "ts")


@query(with_(DIMS, """
SELECT user_id, register_date, country, CASE WHEN is_active THEN channel ELSE 'RECALLED' END AS channel, age_group,
  is_active FROM dim_user
UNION ALL
SELECT user_id + 1000000000, register_date, country, 'NEW', age_group, is_active FROM dim_user"""))
def scd1_dim_upsert(spark, sf_dir):
    """Inactive users get a new channel, after an older correction that must lose; and as
    many users again are new."""
    dim = views.dim_user(spark, sf_dir)
    inactive = dim.where(~F.col("is_active"))
    updates = (
        inactive.withColumn("channel", F.lit("OUTDATED")).withColumn("changed", F.lit(1))
        .unionByName(inactive.withColumn("channel", F.lit("RECALLED")).withColumn("changed", F.lit(2)))
        .unionByName(
            dim.withColumn("user_id", F.col("user_id") + 1_000_000_000)
            .withColumn("channel", F.lit("NEW")).withColumn("changed", F.lit(1))
        )
    )
    return upsert_latest(dim, updates, "user_id", "changed")


_LAYER_COUNTS = """
SELECT 'ods_events' AS layer, COUNT(*) AS row_cnt FROM ods
UNION ALL SELECT 'dwd_user_action', COUNT(*) FROM dwd
UNION ALL SELECT 'dws_user_daily', COUNT(*) FROM (SELECT DISTINCT user_id, dt, country FROM dwd)
UNION ALL SELECT 'ads_funnel_daily', COUNT(*) FROM (SELECT DISTINCT dt, country, item_category FROM dwd)"""


@query(with_(DWD, _LAYER_COUNTS))
def layer_row_counts(spark, sf_dir):
    """Counts of the stored tables, from their file footers."""
    return checks.row_counts(stored_layers(spark, sf_dir))


@query(with_(ADS, "SELECT 'ads_funnel_daily' AS layer, COUNT(*) AS row_cnt FROM ads"))
def verify_non_empty(spark, sf_dir):
    return checks.require_rows(ads(spark, sf_dir), "ads_funnel_daily")
