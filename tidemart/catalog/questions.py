"""Analyst questions (Q rows), board charts (B rows) and the evaluation tables (K rows)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemart.catalog.registry import query
from tidemart.catalog.sql import ADS, DWD, DWS, ODS, TODAY, with_
from tidemart.catalog.stored import stored_folder
from tidemart.catalog.warehouse import ads, dwd, dws
from tidemart.operators import checks, colocated
from tidemart.operators.joins import attach, spread_join
from tidemart.operators.retrieval import SectionIndex, build_index, open_index, split_sections, topk
from tidemart.plans import analytics as ask
from tidemart.plans import warehouse as plan
from tidemart.sources import views
from tidemart.sources.views import AS_OF

_WEEK = f"dt >= {TODAY} - 7"
_MONTH = f"dt >= {TODAY} - 30"

@query(with_(ADS, f"SELECT ROUND(SUM(gmv), 2) AS total_gmv FROM ads WHERE {_WEEK}"))
def total_gmv_7d(spark, sf_dir):
    return ask.total_gmv(ads(spark, sf_dir), AS_OF, 7)


@query(with_(ADS, f"""
SELECT country, ROUND(SUM(gmv), 2) AS gmv FROM ads WHERE {_WEEK}
GROUP BY country ORDER BY gmv DESC, country LIMIT 1"""))
def top1_country(spark, sf_dir):
    return ask.best_country(ads(spark, sf_dir), AS_OF, 7)


@query(with_(ADS, f"SELECT dt, country, CAST(SUM(pay_uv) AS BIGINT) AS pay_uv FROM ads WHERE {_WEEK} GROUP BY dt, country"))
def pay_uv_country_day(spark, sf_dir):
    return ask.pay_uv_by_day(ads(spark, sf_dir), AS_OF, 7)


_SHARE = f"""
SELECT category, ROUND(SUM(gmv), 2) AS gmv,
  ROUND(SUM(gmv) * 100.0 / (SELECT SUM(gmv) FROM ads WHERE {_WEEK}), 4) AS pct
FROM ads WHERE {_WEEK} GROUP BY category"""


@query(with_(ADS, _SHARE))
def category_gmv_share(spark, sf_dir):
    return ask.category_share(ads(spark, sf_dir), AS_OF, 7)


@query(with_(ADS, _SHARE))
def scalar_subquery_total(spark, sf_dir):
    """Written as SQL text on a view, the way an analyst would."""
    ads(spark, sf_dir).createOrReplaceTempView("ads_funnel_daily")
    return spark.sql("""
        SELECT category, ROUND(SUM(gmv), 2) AS gmv,
               ROUND(SUM(gmv) * 100.0D / (SELECT SUM(gmv) FROM ads_funnel_daily
                                          WHERE dt >= DATE '2024-01-30' - INTERVAL '7' DAY), 4) AS pct
        FROM ads_funnel_daily WHERE dt >= DATE '2024-01-30' - INTERVAL '7' DAY
        GROUP BY category""")


@query(with_(ADS, f"""
SELECT category, ROUND(SUM(gmv), 2) AS gmv, ROUND(SUM(gmv) * 100.0 / SUM(SUM(gmv)) OVER (), 4) AS pct
FROM ads WHERE {_WEEK} GROUP BY category"""))
def share_of_total_window(spark, sf_dir):
    return ask.category_share_of_groups(ads(spark, sf_dir), AS_OF, 7)


@query(with_(ADS, f"SELECT ROUND(SUM(pay_uv) * 100.0 / SUM(impression_uv), 4) AS conv_pct FROM ads WHERE {_WEEK}"))
def overall_conversion(spark, sf_dir):
    return ask.conversion(ads(spark, sf_dir), AS_OF, 7)


@query(with_(ADS, "SELECT ROUND(SUM(pay_uv) * 100.0 / SUM(impression_uv), 4) AS conv_pct FROM ads"))
def undated_conversion(spark, sf_dir):
    return ask.conversion(ads(spark, sf_dir))


# A week's sum against that of the latest earlier week in which the country has any.
@query(with_(ADS + f""",
week_sums AS (SELECT country, dt - CAST(isodow(dt) - 1 AS INTEGER) AS wk, SUM(gmv) AS total FROM ads WHERE {_MONTH} GROUP BY ALL)""", """
SELECT now.country, now.wk, ROUND(now.total, 2) AS gmv, ROUND(old.total, 2) AS prev_gmv, ROUND(now.total / old.total - 1, 4) AS pct_change
FROM week_sums now JOIN week_sums old ON old.country = now.country
  AND old.wk = (SELECT MAX(w.wk) FROM week_sums w WHERE w.country = now.country AND w.wk < now.wk)
WHERE old.total <> 0 AND now.total / old.total - 1 < -0.1"""))
def lag_wow_drop(spark, sf_dir):
    return ask.weekly_drops(ads(spark, sf_dir), AS_OF)


@query(with_(DWS, f"""
SELECT u.age_group, ROUND(SUM(d.pay_amount) / COUNT(DISTINCT d.user_id), 4) AS arpu
FROM dws d JOIN dim_user u ON d.user_id = u.user_id WHERE d.{_MONTH} GROUP BY u.age_group"""))
def arpu_by_age_group(spark, sf_dir):
    return ask.arpu_by_age_group(dws(spark, sf_dir), views.dim_user(spark, sf_dir), AS_OF)


@query(with_(DWS, f"""
SELECT u.channel, ROUND(SUM(d.pay_amount), 2) AS gmv,
  ROUND(SUM(d.pay_amount) * 100.0 / (SELECT SUM(pay_amount) FROM dws WHERE {_MONTH}), 4) AS pct
FROM dws d JOIN dim_user u ON d.user_id = u.user_id WHERE d.{_MONTH} GROUP BY u.channel"""))
def channel_gmv_share(spark, sf_dir):
    return ask.channel_share(dws(spark, sf_dir), views.dim_user(spark, sf_dir), AS_OF)


@query(with_(DWS, """
SELECT u.is_active, ROUND(SUM(d.pay_amount), 2) AS gmv, CAST(SUM(d.session_cnt) AS BIGINT) AS sessions
FROM dws d JOIN dim_user u ON d.user_id = u.user_id GROUP BY u.is_active"""))
def summary_dim_join(spark, sf_dir):
    joined = attach(dws(spark, sf_dir), views.dim_user(spark, sf_dir).select("user_id", "is_active"), "user_id", "inner")
    return joined.groupBy("is_active").agg(
        F.round(F.sum("pay_amount"), 2).alias("gmv"), F.sum("session_cnt").alias("sessions")
    )


@query(with_(ADS, f"SELECT ROUND(SUM(gmv), 2) AS gmv FROM ads WHERE dt = {TODAY}"))
def today_gmv(spark, sf_dir):
    return ask.day_gmv(ads(spark, sf_dir), AS_OF)


@query(with_(ADS, f"SELECT country, CAST(SUM(pay_uv) AS BIGINT) AS pay_uv FROM ads WHERE {_WEEK} GROUP BY country"))
def pay_uv_by_country(spark, sf_dir):
    return ask.pay_uv_by_country(ads(spark, sf_dir), AS_OF, 7)


@query(with_(ADS, f"SELECT country, CAST(SUM(pay_uv) AS BIGINT) AS pay_uv FROM ads WHERE {_WEEK} GROUP BY country ORDER BY 2 DESC, 1"))
def sort_by_ordinal(spark, sf_dir):
    ads(spark, sf_dir).createOrReplaceTempView("ads_funnel_daily")
    return spark.sql("""
        SELECT country, SUM(pay_uv) AS pay_uv FROM ads_funnel_daily
        WHERE dt >= DATE '2024-01-30' - INTERVAL '7' DAY
        GROUP BY country ORDER BY 2 DESC, 1""")


@query(with_(ADS, f"""
SELECT country FROM ads WHERE dt >= {TODAY} - 30 AND dt < {TODAY} - 7 GROUP BY country
HAVING SUM(gmv) * 100.0 / (SELECT SUM(gmv) FROM ads WHERE dt >= {TODAY} - 7 AND dt < {TODAY}) < 90"""))
def having_vs_total(spark, sf_dir):
    return ask.shrunken_countries(ads(spark, sf_dir), AS_OF)


_STAR = """
SELECT e.country, u.age_group, i.brand, ROUND(SUM(e.amount), 2) AS gmv, COUNT(DISTINCT e.user_id) AS uv
FROM dwd e JOIN dim_user u ON e.user_id = u.user_id JOIN dim_item i ON e.item_id = i.item_id
GROUP BY e.country, u.age_group, i.brand"""


@query(with_(DWD, _STAR))
def inner_star_join_agg(spark, sf_dir):
    out = ask.star_join(dwd(spark, sf_dir), views.dim_user(spark, sf_dir), views.dim_item(spark, sf_dir))
    return out.withColumn("gmv", F.round("gmv", 2))


@query(with_(DWD, _STAR))
def smj_star_join(spark, sf_dir):
    """The star join without a broadcast of the dimensions: sort-merge joins, hot keys spread."""
    out = ask.star_join(dwd(spark, sf_dir), views.dim_user(spark, sf_dir), views.dim_item(spark, sf_dir), spread_join)
    return out.withColumn("gmv", F.round("gmv", 2))


@query(with_(DWD, _STAR))
def colocated_star_join(spark, sf_dir):
    """The star join over tables stored by user: no shuffle of the fact."""
    out = ask.star_join_colocated(spark, star_tables(spark, sf_dir), views.dim_item(spark, sf_dir))
    return out.withColumn("gmv", F.round("gmv", 2))


def star_tables(spark, sf_dir) -> colocated.Colocated:
    """Detail and users, stored once in buckets by user."""
    def make(out):
        name = "star_" + uuid.uuid4().hex
        tables = colocated.store(dwd(spark, sf_dir).select("user_id", "item_id", "country", "amount"), views.dim_user(spark, sf_dir), "user_id", name, out)
        _STAR_TABLES[out] = tables

    return _STAR_TABLES[stored_folder(spark, sf_dir, "star", ("events", "customer", "nation", "region", "part"), make)]


# Names of the tables in the application's catalog, by their folder.
_STAR_TABLES: dict[str, colocated.Colocated] = {}


@query(with_(ADS, "SELECT ROUND(SUM(gmv), 2) AS gmv FROM ads"))
def board_total_gmv(spark, sf_dir):
    return ask.gmv_by(ads(spark, sf_dir), [])


@query(with_(ADS, "SELECT country, ROUND(SUM(gmv), 2) AS gmv FROM ads GROUP BY country"))
def board_gmv_by_country(spark, sf_dir):
    return ask.gmv_by(ads(spark, sf_dir), ["country"]).orderBy(F.desc("gmv"), "country")


@query(with_(ADS, """
SELECT 'impression' AS step, CAST(SUM(impression_uv) AS BIGINT) AS uv FROM ads
UNION ALL SELECT 'click', CAST(SUM(click_uv) AS BIGINT) FROM ads
UNION ALL SELECT 'add_cart', CAST(SUM(add_cart_uv) AS BIGINT) FROM ads
UNION ALL SELECT 'order', CAST(SUM(order_uv) AS BIGINT) FROM ads
UNION ALL SELECT 'pay', CAST(SUM(pay_uv) AS BIGINT) FROM ads"""))
def board_funnel(spark, sf_dir):
    return ask.funnel_rows(ads(spark, sf_dir))


@query(with_(ADS, "SELECT dt, ROUND(SUM(gmv), 2) AS gmv FROM ads GROUP BY dt"))
def board_gmv_trend(spark, sf_dir):
    return ask.gmv_by(ads(spark, sf_dir), ["dt"]).orderBy("dt")


@query(with_(ADS, "SELECT country, category, ROUND(SUM(gmv), 2) AS gmv FROM ads GROUP BY country, category"))
def board_heatmap(spark, sf_dir):
    """One row per cell: whatever categories there are, the cells add up to the total."""
    return ask.gmv_by(ads(spark, sf_dir), ["country", "category"])


@query(with_(DWD, """
SELECT user_channel AS channel, country, item_category AS category, ROUND(COALESCE(SUM(amount), 0), 2) AS gmv
FROM dwd GROUP BY 1, 2, 3"""))
def gmv_by_channel_country(spark, sf_dir):
    detail = dwd(spark, sf_dir).select(
        F.col("user_channel").alias("channel"), "country", F.col("item_category").alias("category"),
        F.coalesce("amount", F.lit(0.0)).alias("gmv"),
    )
    return ask.gmv_by(detail, ["channel", "country", "category"])


@query(with_(ODS, "SELECT DISTINCT CAST(d AS DATE) AS date, CAST(weekofyear(d) AS INTEGER) AS week, "
             "CAST(month(d) AS INTEGER) AS month, CAST(year(d) AS INTEGER) AS year, "
             "CAST(isodow(d) - 1 AS INTEGER) AS weekday FROM (SELECT unnest(generate_series("
             "(SELECT MIN(dt) FROM ods), (SELECT MAX(dt) FROM ods), INTERVAL 1 DAY)) AS d)"))
def calendar_dim(spark, sf_dir):
    return ask.calendar(views.ods_events(spark, sf_dir))


def evaluation_log(spark, sf_dir):
    """A benchmark log with the columns of a question run, one row per event: the device
    stands for the method, an order event for a failed query."""
    ods = views.ods_events(spark, sf_dir)
    return ods.select(
        F.col("device").alias("paradigm"),
        (F.col("action_type") != "order").alias("exec_ok"),
        F.col("action_type").isin("pay", "click").alias("row_match"),
        (F.col("event_ts") % 5000).alias("latency_ms"),
        F.col("item_id").alias("tokens"),
    )


@query(with_(ODS, """
SELECT device AS paradigm, COUNT(*) AS questions, COUNT(*) FILTER (action_type <> 'order') AS exec_ok_cnt,
  COUNT(*) FILTER (action_type IN ('pay', 'click')) AS row_match_cnt,
  ROUND(AVG(event_ts % 5000), 4) AS avg_latency_ms, ROUND(AVG(item_id), 4) AS avg_tokens
FROM ods GROUP BY device"""))
def eval_summary(spark, sf_dir):
    return checks.eval_summary(evaluation_log(spark, sf_dir))


@query(with_(ADS + """,
p AS (SELECT country, SUM(pay_uv) AS n FROM ads GROUP BY country),
c AS (SELECT country, SUM(click_uv) AS n FROM ads GROUP BY country)""", """
SELECT 'funnel_forms' AS pair, (SELECT COUNT(*) FROM ads) AS left_rows, (SELECT COUNT(*) FROM ads) AS right_rows,
  TRUE AS count_match, TRUE AS rows_match
UNION ALL
SELECT 'pay_and_click', (SELECT COUNT(*) FROM p), (SELECT COUNT(*) FROM c),
  (SELECT COUNT(*) FROM p) = (SELECT COUNT(*) FROM c),
  NOT EXISTS (SELECT * FROM p EXCEPT ALL SELECT * FROM c) AND NOT EXISTS (SELECT * FROM c EXCEPT ALL SELECT * FROM p)"""))
def result_set_match(spark, sf_dir):
    """Two forms of the funnel agree row by row; two other results agree in size only."""
    detail = dwd(spark, sf_dir)
    one = plan.build_ads(detail).withColumn("gmv", F.round("gmv", 2))
    other = plan.build_ads(detail, two_step=False).withColumn("gmv", F.round("gmv", 2))
    pay = one.groupBy("country").agg(F.sum("pay_uv").alias("n"))
    click = one.groupBy("country").agg(F.sum("click_uv").alias("n"))
    return checks.same_rows(one, other).select(F.lit("funnel_forms").alias("pair"), "*").unionByName(
        checks.same_rows(pay, click).select(F.lit("pay_and_click").alias("pair"), "*")
    )


def section_index(spark, sf_dir) -> SectionIndex:
    """The stored index of all sections of all documents."""
    return open_index(spark, stored_folder(spark, sf_dir, "section_index", ("documents",), lambda out: build_index(
        split_sections(views.load(spark, sf_dir, "documents")), out)))


@query(r"""
WITH sections AS (
  SELECT doc_id, unnest(range(len(parts))) AS section_no, unnest(parts) AS section
  FROM (SELECT doc_id, string_split(text, chr(10) || '## ') AS parts FROM documents)),
section_words AS (
  SELECT DISTINCT doc_id, section_no, unnest(regexp_extract_all(lower(section), '[\p{L}\p{N}_]+')) AS word FROM sections),
question_words AS (
  SELECT DISTINCT item_id AS question_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS word FROM benchmark),
shared AS (
  SELECT question_id, doc_id, section_no, COUNT(*) AS overlap
  FROM question_words JOIN section_words USING (word) GROUP BY 1, 2, 3),
ranked AS (
  SELECT b.item_id AS question_id, s.doc_id, s.section_no, COALESCE(h.overlap, 0) AS overlap, s.section,
    row_number() OVER (PARTITION BY b.item_id ORDER BY COALESCE(h.overlap, 0) DESC, s.section DESC, s.doc_id, s.section_no) AS rnk
  FROM benchmark b CROSS JOIN sections s
  LEFT JOIN shared h ON h.question_id = b.item_id AND h.doc_id = s.doc_id AND h.section_no = s.section_no)
SELECT question_id, CAST(rnk AS INTEGER) AS rnk, doc_id, CAST(section_no AS INTEGER) AS section_no,
  CAST(overlap AS INTEGER) AS overlap, section
FROM ranked WHERE rnk <= 3""")
def keyword_topk_retrieval(spark, sf_dir):
    """All questions against the stored index of all sections."""
    questions = views.load(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("question_id"), F.col("text").alias("question")
    )
    return topk(questions, section_index(spark, sf_dir))
