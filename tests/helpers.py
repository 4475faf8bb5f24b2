"""Small hand-made tables."""

import datetime as dt
import math
from collections import Counter

from tidemart.sources.views import EVENT_COLUMNS

FEED = (
    "event_id long, user_id long, item_id long, action_type string, event_ts long, session_id string, "
    "amount double, country string, device string, category string, channel string"
)


def feed(spark, *rows):
    """Events given by their interesting columns only."""
    base = dict(event_id=1, user_id=1, item_id=1, action_type="click", event_ts=1704067200000, session_id="s",
                amount=None, country="US", device="Web", category="toys", channel="organic")
    return spark.createDataFrame([tuple({**base, **r}[c] for c in EVENT_COLUMNS) for r in rows], FEED)


def users(spark, *rows):
    schema = "user_id long, register_date date, country string, channel string, age_group string, is_active boolean"
    base = dict(user_id=1, register_date=dt.date(2024, 1, 1), country="CN", channel="ads", age_group="18-24", is_active=True)
    return spark.createDataFrame([tuple({**base, **r}.values()) for r in rows], schema)


def items(spark, *rows):
    schema = "item_id long, category string, sub_category string, brand string, price double, listed_date date"
    base = dict(item_id=1, category="books", sub_category="novels", brand="b1", price=1.0, listed_date=dt.date(2024, 1, 1))
    return spark.createDataFrame([tuple({**base, **r}.values()) for r in rows], schema)


def plan_of(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def final_plan(df):
    """The adaptive plan after the query has run."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def at(seconds, day="2024-01-01"):
    return dt.datetime.fromisoformat(day) + dt.timedelta(seconds=seconds)


def canonical(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return ("b", value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else ("f", round(value, 6) + 0.0)
    if isinstance(value, int):
        return ("i", value)
    if isinstance(value, dt.datetime):
        return ("t", value.isoformat())
    if isinstance(value, dt.date):
        return ("d", value.isoformat())
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(canonical(r[i]) for i in order) for r in rows)
