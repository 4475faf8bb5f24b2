"""Common table expressions for the oracle SQL: the same tables, written independently."""

ODS = """
ods AS (
  SELECT event_id, user_id,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
    CASE event_type WHEN 'view' THEN 'impression' WHEN 'click' THEN 'click' WHEN 'signup' THEN 'add_cart'
      WHEN 'error' THEN 'order' WHEN 'purchase' THEN 'pay' END AS action_type,
    epoch_us(ts) // 1000 AS event_ts,
    user_id || '-' || strftime(ts, '%Y-%m-%d') || '-' || hour(ts) AS session_id,
    CASE WHEN event_type = 'purchase' THEN value END AS amount,
    'NATION_' || ((user_id + CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END) % 25) AS country,
    CASE event_id % 3 WHEN 0 THEN 'iOS' WHEN 1 THEN 'Android' ELSE 'Web' END AS device,
    'CAT_' || (event_id % 6) AS category,
    'CH_' || (user_id % 5) AS channel,
    CAST(ts AS DATE) AS dt
  FROM events)"""

REPLAYED = ODS + """,
replayed AS (
  SELECT event_id, NULLIF(user_id, 7) AS user_id, item_id, action_type, event_ts, session_id, amount,
    country, device, category, channel
  FROM (SELECT * FROM ods UNION ALL SELECT * REPLACE (event_ts + 1000 AS event_ts) FROM ods)),
replayed_ods AS (SELECT *, CAST(make_timestamp(event_ts * 1000) AS DATE) AS dt FROM replayed)"""

DIMS = """
dim_user AS (
  SELECT c_custkey AS user_id, CAST(DATE '2023-12-02' + CAST(c_custkey % 60 AS INTEGER) AS DATE) AS register_date,
    n_name AS country, c_mktsegment AS channel, r_name AS age_group, c_acctbal >= 0 AS is_active
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey),
dim_item AS (
  SELECT p_partkey AS item_id, p_type AS category, p_name AS sub_category, p_brand AS brand, p_retailprice AS price,
    CAST(DATE '2023-01-01' + CAST(p_partkey % 365 AS INTEGER) AS DATE) AS listed_date
  FROM part)"""


def dwd_from(table: str) -> str:
    return f"""
dwd AS (
  SELECT e.event_id, e.user_id, e.item_id, e.action_type, e.event_ts, e.session_id, e.amount, e.country, e.device,
    i.category AS item_category, i.brand AS item_brand, u.channel AS user_channel, u.age_group, e.dt
  FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY event_ts, user_id) AS rn
        FROM {table} WHERE user_id IS NOT NULL) e
  LEFT JOIN dim_user u ON e.user_id = u.user_id
  LEFT JOIN dim_item i ON e.item_id = i.item_id
  WHERE rn = 1)"""


DWD = f"{ODS},{DIMS},{dwd_from('ods')}"

# Stated on the rows per group and action, which are then laid side by side.
DWS = DWD + """,
user_day_actions AS (
  SELECT user_id, dt, country, action_type, COUNT(*) AS n FROM dwd GROUP BY ALL),
user_day_totals AS (
  SELECT user_id, dt, country, SUM(amount) AS paid, COUNT(DISTINCT session_id) AS visits FROM dwd GROUP BY ALL),
user_day_wide AS (
  PIVOT user_day_actions ON action_type IN ('impression', 'click', 'add_cart', 'order', 'pay') USING SUM(n) GROUP BY user_id, dt, country),
dws AS (
  SELECT t.user_id, t.dt, t.country,
    CAST(IFNULL(w.impression, 0) AS BIGINT) AS impression_cnt, CAST(IFNULL(w.click, 0) AS BIGINT) AS click_cnt,
    CAST(IFNULL(w.add_cart, 0) AS BIGINT) AS add_cart_cnt, CAST(IFNULL(w."order", 0) AS BIGINT) AS order_cnt,
    CAST(IFNULL(w.pay, 0) AS BIGINT) AS pay_cnt, IFNULL(t.paid, 0) AS pay_amount, t.visits AS session_cnt
  FROM user_day_totals t LEFT JOIN user_day_wide w
    ON t.user_id IS NOT DISTINCT FROM w.user_id AND t.dt = w.dt AND t.country IS NOT DISTINCT FROM w.country)"""

# Stated on the distinct users of each group and action.
ADS = DWD + """,
cell_users AS (
  SELECT DISTINCT dt, country, item_category, action_type, user_id FROM dwd),
cell_steps AS (
  SELECT dt, country, item_category, action_type, COUNT(user_id) AS users FROM cell_users GROUP BY ALL),
cell_money AS (
  SELECT dt, country, item_category, SUM(amount) AS paid FROM dwd WHERE action_type = 'pay' GROUP BY ALL),
cell_wide AS (
  PIVOT cell_steps ON action_type IN ('impression', 'click', 'add_cart', 'order', 'pay') USING SUM(users)
  GROUP BY dt, country, item_category),
ads AS (
  SELECT w.dt, w.country, w.item_category AS category,
    CAST(IFNULL(w.impression, 0) AS BIGINT) AS impression_uv, CAST(IFNULL(w.click, 0) AS BIGINT) AS click_uv,
    CAST(IFNULL(w.add_cart, 0) AS BIGINT) AS add_cart_uv, CAST(IFNULL(w."order", 0) AS BIGINT) AS order_uv,
    CAST(IFNULL(w.pay, 0) AS BIGINT) AS pay_uv, IFNULL(m.paid, 0) AS gmv
  FROM cell_wide w LEFT JOIN cell_money m
    ON w.dt = m.dt AND w.country IS NOT DISTINCT FROM m.country AND w.item_category IS NOT DISTINCT FROM m.item_category)"""

# Day that stands for "today".
TODAY = "DATE '2024-01-30'"

ARRIVALS = ODS + """,
arrived AS (
  SELECT *, make_timestamp(event_ts * 1000) AS ts,
    make_timestamp((event_ts + CASE WHEN event_id % 10 = 0 THEN 10 + event_id % 21 ELSE 0 END * 1000) * 1000)
      AS arrival_ts
  FROM ods)"""

# The same with delays of up to two hours, which cross many windows.
SLOW_ARRIVALS = ARRIVALS.replace("10 + event_id % 21", "event_id * 37 % 7200")


def with_(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select.strip()}"
