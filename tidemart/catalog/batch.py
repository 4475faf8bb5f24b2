"""Single operators: projections and filters (F), joins (J), aggregations (A), order (O)."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from tidemart.catalog.registry import query
from tidemart.catalog.sql import ADS, ARRIVALS, DIMS, DWS, ODS, REPLAYED, TODAY, with_
from tidemart.catalog.warehouse import ads, dwd, dws, uv_sketches
from tidemart.functions import (
    event_day, event_time, json_field, pct, value_when, week_of, within_days, zero_if_null,
)
from tidemart.operators.aggregates import funnel_uv, step_counts
from tidemart.operators.joins import compare_by_key, enrich
from tidemart.operators.rows import dedup, first_seen
from tidemart.operators.sketches import count_users, rolling_users, users_between
from tidemart.plans.warehouse import DWD_COLUMNS
from tidemart.sources import views
from tidemart.sources.views import AS_OF, STEPS


@query("SELECT event_id, CAST(ts AS DATE) AS dt FROM events")
def derive_dt(spark, sf_dir):
    return views.raw_events(spark, sf_dir).select("event_id", event_day("event_ts").alias("dt"))


@query("SELECT event_id, make_timestamp(epoch_us(ts) // 1000 * 1000) AS ts FROM events")
def ms_to_timestamp(spark, sf_dir):
    return views.raw_events(spark, sf_dir).select("event_id", event_time("event_ts").alias("ts"))


@query(with_(f"{ODS},{DIMS}", """
SELECT event_id, o.user_id, o.item_id, action_type, event_ts, session_id, amount, o.country, device,
  i.category AS item_category, i.brand AS item_brand, u.channel AS user_channel, u.age_group, dt
FROM ods o LEFT JOIN dim_user u ON o.user_id = u.user_id LEFT JOIN dim_item i ON o.item_id = i.item_id"""))
def project_rename(spark, sf_dir):
    dim_user = views.dim_user(spark, sf_dir).select("user_id", F.col("channel").alias("user_channel"), "age_group")
    dim_item = views.dim_item(spark, sf_dir).select(
        "item_id", F.col("category").alias("item_category"), F.col("brand").alias("item_brand")
    )
    joined = enrich(views.ods_events(spark, sf_dir), [(dim_user, "user_id"), (dim_item, "item_id")])
    return joined.select(*DWD_COLUMNS)


@query(with_(REPLAYED, "SELECT * FROM replayed WHERE user_id IS NOT NULL"))
def filter_not_null(spark, sf_dir):
    return views.replayed_events(spark, sf_dir).where(F.col("user_id").isNotNull())


@query(with_(ODS, "SELECT * FROM ods WHERE event_id = 777"))
def point_lookup(spark, sf_dir):
    return views.ods_events(spark, sf_dir).where(F.col("event_id") == 777)


@query("SELECT COUNT(*) AS n FROM events WHERE event_type = 'purchase'")
def filter_count(spark, sf_dir):
    """Reads one column; the equality reaches the Parquet scan."""
    events = views.load(spark, sf_dir, "events")
    return events.where(F.col("event_type") == "purchase").agg(F.count(F.lit(1)).alias("n"))


@query(with_(REPLAYED, """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY event_ts) AS rn FROM replayed) WHERE rn = 1"""))
def dedup_by_key(spark, sf_dir):
    return dedup(views.replayed_events(spark, sf_dir), ["event_id"], ["event_ts", "user_id"])


@query(with_(ODS, f"""
SELECT event_id, dt, dt >= {TODAY} - 7 AS last_7, dt = {TODAY} AS today FROM ods WHERE dt >= {TODAY} - 30"""))
def recent_days_filter(spark, sf_dir):
    ods = views.ods_events(spark, sf_dir)
    return ods.where(within_days("dt", AS_OF, 30)).select(
        "event_id", "dt", within_days("dt", AS_OF, 7).alias("last_7"), (F.col("dt") == F.lit(AS_OF)).alias("today")
    )


@query(with_(ODS, "SELECT event_id, CAST(date_trunc('week', dt) AS DATE) AS wk FROM ods"))
def week_bucket(spark, sf_dir):
    return views.ods_events(spark, sf_dir).select("event_id", week_of("dt").alias("wk"))


@query(with_(ADS, """
SELECT dt, country, category,
  ROUND(pay_uv * 100.0 / NULLIF(CAST(impression_uv AS DOUBLE), 0), 2) AS imp_to_pay_pct FROM ads"""))
def ratio_pct(spark, sf_dir):
    return ads(spark, sf_dir).select("dt", "country", "category", pct("pay_uv", "impression_uv").alias("imp_to_pay_pct"))


@query(with_(ODS, "SELECT user_id, dt, COALESCE(ROUND(SUM(amount), 2), 0) AS amount FROM ods GROUP BY user_id, dt"))
def coalesce_zero(spark, sf_dir):
    grouped = views.ods_events(spark, sf_dir).groupBy("user_id", "dt")
    return grouped.agg(zero_if_null(F.round(F.sum("amount"), 2)).alias("amount"))


@query(with_(ODS, """
SELECT event_id, CASE WHEN action_type = 'pay' THEN amount ELSE 0 END AS paid,
  CASE WHEN action_type = 'click' THEN user_id END AS clicker FROM ods"""))
def conditional_value(spark, sf_dir):
    return views.ods_events(spark, sf_dir).select(
        "event_id", value_when("action_type", "pay", "amount", 0.0).alias("paid"),
        value_when("action_type", "click", "user_id").alias("clicker"),
    )


@query(with_(ODS, """
SELECT 'user' AS kind, user_id AS id, first(country ORDER BY event_ts, event_id) AS country FROM ods GROUP BY user_id
UNION ALL SELECT DISTINCT 'item', item_id, NULL FROM ods"""))
def distinct_keys(spark, sf_dir):
    ods = views.ods_events(spark, sf_dir)
    users = first_seen(ods, "user_id", "country", ["event_ts", "event_id"])
    items = ods.select("item_id").distinct()
    return users.select(F.lit("user").alias("kind"), F.col("user_id").alias("id"), "country").unionByName(
        items.select(F.lit("item").alias("kind"), F.col("item_id").alias("id"), F.lit(None).cast("string").alias("country"))
    )


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.absent') AS absent FROM events")
def json_props(spark, sf_dir):
    events = views.load(spark, sf_dir, "events")
    return events.select("event_id", json_field("props", "$.k", "long").alias("k"), json_field("props", "$.absent").alias("absent"))


@query(with_(f"{REPLAYED},{DIMS}", """
SELECT e.event_id, e.event_ts, e.user_id, e.item_id, u.country AS user_country, u.channel AS user_channel, u.age_group,
  i.category AS item_category, i.brand AS item_brand
FROM replayed e LEFT JOIN dim_user u ON e.user_id = u.user_id LEFT JOIN dim_item i ON e.item_id = i.item_id"""))
def broadcast_left_enrich(spark, sf_dir):
    """Events without a user keep their row with empty user attributes."""
    feed = views.replayed_events(spark, sf_dir).select("event_id", "event_ts", "user_id", "item_id")
    users = views.dim_user(spark, sf_dir).select(
        "user_id", F.col("country").alias("user_country"), F.col("channel").alias("user_channel"), "age_group"
    )
    items = views.dim_item(spark, sf_dir).select(
        "item_id", F.col("category").alias("item_category"), F.col("brand").alias("item_brand")
    )
    return enrich(feed, [(users, "user_id"), (items, "item_id")]).select(
        "event_id", "event_ts", "user_id", "item_id", "user_country", "user_channel", "age_group",
        "item_category", "item_brand",
    )


@query(with_(ODS, "SELECT dt, COUNT(*) AS cnt FROM ods GROUP BY dt ORDER BY dt LIMIT 5"))
def count_by_partition(spark, sf_dir):
    counts = views.ods_events(spark, sf_dir).groupBy("dt").agg(F.count(F.lit(1)).alias("cnt"))
    return counts.orderBy("dt").limit(5)


@query("SELECT ROUND(SUM(value), 2) AS total FROM events")
def global_sum(spark, sf_dir):
    return views.load(spark, sf_dir, "events").agg(F.round(F.sum("value"), 2).alias("total"))


@query(with_(DWS, "SELECT user_id, dt, country, impression_cnt, click_cnt, add_cart_cnt, order_cnt, pay_cnt FROM dws"))
def conditional_count(spark, sf_dir):
    return step_counts(dwd(spark, sf_dir), ["user_id", "dt", "country"], STEPS)


@query(with_(ODS, "SELECT user_id, dt, COUNT(DISTINCT session_id) AS session_cnt FROM ods GROUP BY user_id, dt"))
def count_distinct(spark, sf_dir):
    return views.ods_events(spark, sf_dir).groupBy("user_id", "dt").agg(F.countDistinct("session_id").alias("session_cnt"))


@query(with_(ADS, "SELECT dt, country, category, impression_uv, click_uv, add_cart_uv, order_uv, pay_uv FROM ads"))
def conditional_distinct(spark, sf_dir):
    """The literal form with one COUNT(DISTINCT CASE ...) per step."""
    category = dwd(spark, sf_dir).withColumnRenamed("item_category", "category")
    return funnel_uv(category, ["dt", "country", "category"], STEPS, two_step=False).drop("gmv")


@query(with_(DWS, """
SELECT country, ROUND(SUM(pay_amount), 2) AS gmv, CAST(SUM(pay_cnt) AS BIGINT) AS pay_cnt FROM dws GROUP BY country"""))
def group_sum_small(spark, sf_dir):
    return dws(spark, sf_dir).groupBy("country").agg(
        F.round(F.sum("pay_amount"), 2).alias("gmv"), F.sum("pay_cnt").alias("pay_cnt")
    )


@query(with_(ODS, "SELECT dt, country, COUNT(DISTINCT user_id) AS uv, COUNT(*) AS events FROM ods GROUP BY dt, country"))
def approx_uv(spark, sf_dir):
    """Users per day and country over all steps, merged from the stored sketches."""
    return count_users(uv_sketches(spark, sf_dir), ["dt", "country"])


@query(with_(ODS, f"""
SELECT CAST(n AS INTEGER) AS days, country, action_type, COUNT(DISTINCT user_id) AS uv, COUNT(*) AS events
FROM ods, (VALUES (7), (30)) d(n) WHERE dt > {TODAY} - n AND dt <= {TODAY} GROUP BY n, country, action_type"""))
def users_last_days(spark, sf_dir):
    """Users of the last 7 and 30 days per country and step, from the stored sketches."""
    sketches = uv_sketches(spark, sf_dir)
    spans = [
        users_between(sketches, AS_OF - timedelta(n - 1), AS_OF, ["country", "action_type"]).select(F.lit(n).alias("days"), "*")
        for n in (7, 30)
    ]
    return spans[0].unionByName(spans[1])


@query(with_(ODS, """
SELECT d.dt, country, COUNT(DISTINCT user_id) AS uv, COUNT(*) AS events
FROM (SELECT DISTINCT dt FROM ods) d JOIN ods o ON o.dt > d.dt - 7 AND o.dt <= d.dt GROUP BY d.dt, country"""))
def rolling_users_7_days(spark, sf_dir):
    """For every day the users of the seven days that end with it, from the stored sketches."""
    return rolling_users(uv_sketches(spark, sf_dir), 7, ["country"])


@query(with_(ADS, "SELECT dt, country, category, ROUND(gmv, 2) AS gmv FROM ads ORDER BY dt DESC, ROUND(gmv, 2) DESC, country, category LIMIT 15"))
def order_limit(spark, sf_dir):
    cells = ads(spark, sf_dir).select("dt", "country", "category", F.round("gmv", 2).alias("gmv"))
    return cells.orderBy(F.desc("dt"), F.desc("gmv"), "country", "category").limit(15)


_BY_TIME = ARRIVALS + """,
by_event AS (SELECT date_trunc('minute', ts) AS window_start, country, COUNT(*) AS pv FROM arrived GROUP BY 1, 2),
by_arrival AS (SELECT date_trunc('minute', arrival_ts) AS window_start, country, COUNT(*) AS pv FROM arrived GROUP BY 1, 2)"""


def minute_pv(spark, sf_dir, clock: str):
    """Batch page views per minute and country by ``ts`` or ``arrival_ts``."""
    minute = F.date_trunc("minute", clock).cast("timestamp_ntz").alias("window_start")
    arrived = views.arrivals(views.raw_events(spark, sf_dir))
    return arrived.groupBy(minute, "country").agg(F.count(F.lit(1)).alias("pv"))


@query(with_(_BY_TIME, """
SELECT window_start, country, p.pv AS proctime_pv, e.pv AS eventtime_pv,
  COALESCE(e.pv, 0) - COALESCE(p.pv, 0) AS diff
FROM by_arrival p FULL OUTER JOIN by_event e USING (window_start, country)"""))
def full_outer_compare(spark, sf_dir):
    return compare_by_key(
        minute_pv(spark, sf_dir, "arrival_ts"), minute_pv(spark, sf_dir, "ts"),
        ["window_start", "country"], "pv", ("proctime_pv", "eventtime_pv"),
    )


@query(with_(_BY_TIME, """
SELECT 'proctime' AS by_what, window_start, country, pv FROM by_arrival
WHERE window_start >= (SELECT date_trunc('minute', MAX(ts)) FROM arrived) - INTERVAL 9 MINUTE
UNION ALL SELECT 'eventtime', window_start, country, pv FROM by_event
WHERE window_start >= (SELECT date_trunc('minute', MAX(ts)) FROM arrived) - INTERVAL 9 MINUTE"""))
def union_all_tagged(spark, sf_dir):
    """Both clocks side by side for the ten minutes up to the end of the data."""
    last = views.raw_events(spark, sf_dir).agg(F.date_trunc("minute", F.timestamp_millis(F.max("event_ts"))).alias("last"))
    since = last.select((F.col("last") - F.expr("INTERVAL 9 MINUTES")).cast("timestamp_ntz")).scalar()
    tagged = [
        minute_pv(spark, sf_dir, clock).where(F.col("window_start") >= since)
        .select(F.lit(name).alias("by_what"), "window_start", "country", "pv")
        for name, clock in (("proctime", "arrival_ts"), ("eventtime", "ts"))
    ]
    return tagged[0].unionByName(tagged[1]).orderBy("country", "window_start", "by_what")
