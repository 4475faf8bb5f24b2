"""Versioned tables (T rows): each query makes a new history of the events.

History used throughout: version 1 holds all events; 2 adds the column ``platform``; 3
appends the paid events again with a platform; 4 deletes one country's rows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemart.catalog.registry import query
from tidemart.catalog.sql import ODS, with_
from tidemart.operators import versioned
from tidemart.session import scratch_dir
from tidemart.sources import views

_COLUMNS = "event_id, user_id, action_type, amount, country, dt"
_V1 = f"v1 AS (SELECT {_COLUMNS} FROM ods)"
_V3 = f"""{_V1},
v3 AS (SELECT *, CAST(NULL AS VARCHAR) AS platform FROM v1
       UNION ALL SELECT *, 'mobile_app' FROM v1 WHERE action_type = 'pay')"""
_V4 = f"{_V3},\nv4 AS (SELECT * FROM v3 WHERE country <> 'NATION_3' OR country IS NULL)"
CONDITION = "country = 'NATION_3'"


def _history(spark, sf_dir, upto: int, rewrite: bool = False) -> versioned.History:
    events = views.ods_events(spark, sf_dir).select(*_COLUMNS.split(", "))
    h = versioned.begin(events, scratch_dir(spark, "versions"))
    if upto >= 2:
        h = versioned.add_column(h, "platform", "string")
    if upto >= 3:
        paid = versioned.read_as_of(h).where("action_type = 'pay'")
        h = versioned.append(h, paid.withColumn("platform", F.lit("mobile_app")))
    if upto >= 4:
        h = (versioned.delete_by_rewrite if rewrite else versioned.delete_where)(h, CONDITION)
    return h


@query(with_(f"{ODS},\n{_V3}", "SELECT * FROM v3"))
def version_append(spark, sf_dir):
    return versioned.read_as_of(_history(spark, sf_dir, 3))


@query(with_(f"{ODS},\n{_V1}", "SELECT * FROM v1"))
def read_as_of(spark, sf_dir):
    """Version 1 after three more changes: its rows and its columns."""
    return versioned.read_as_of(_history(spark, sf_dir, 4), 1)


@query(with_(f"{ODS},\n{_V1}", "SELECT *, CAST(NULL AS VARCHAR) AS platform FROM v1"))
def add_column(spark, sf_dir):
    return versioned.read_as_of(_history(spark, sf_dir, 2))


@query(with_(f"{ODS},\n{_V4}", "SELECT * FROM v4"))
def delete_where(spark, sf_dir):
    return versioned.read_as_of(_history(spark, sf_dir, 4))


@query(with_(f"{ODS},\n{_V4}", "SELECT * FROM v4"))
def delete_copy_on_write(spark, sf_dir):
    return versioned.read_as_of(_history(spark, sf_dir, 4, rewrite=True))


@query(with_(f"{ODS},\n{_V3}", "SELECT * FROM v3 UNION ALL SELECT *, 'web' FROM v1 WHERE action_type = 'click'"))
def rollback_to(spark, sf_dir):
    """Back to version 3 and on from there: the delete does not apply to the new branch."""
    h = versioned.rollback_to(_history(spark, sf_dir, 4), 3)
    clicks = versioned.read_as_of(h, 1).where("action_type = 'click'")
    return versioned.read_as_of(versioned.append(h, clicks.withColumn("platform", F.lit("web"))))


@query(with_(f"{ODS},\n{_V3}", """
SELECT CAST(1 AS BIGINT) AS version, CAST(NULL AS BIGINT) AS parent, 'append' AS op,
  (SELECT COUNT(*) FROM v1) AS added, CAST(0 AS BIGINT) AS deleted, FALSE AS is_current
UNION ALL SELECT 2, 1, 'add_column', 0, 0, FALSE
UNION ALL SELECT 3, 2, 'append', (SELECT COUNT(*) FROM v1 WHERE action_type = 'pay'), 0, FALSE
UNION ALL SELECT 4, 3, 'delete', 0, (SELECT COUNT(*) FROM v3 WHERE country = 'NATION_3'), TRUE"""))
def snapshot_log(spark, sf_dir):
    return versioned.log(_history(spark, sf_dir, 4))


@query(with_(f"{ODS},\n{_V3}", "SELECT * FROM v3 WHERE country = 'NATION_3' AND platform IS NULL"))
def scan_filter_limit(spark, sf_dir):
    rows = versioned.read_as_of(_history(spark, sf_dir, 3))
    return rows.where("country = 'NATION_3' AND platform IS NULL")


@query(with_(f"{ODS},\n{_V3}", """
SELECT (SELECT COUNT(*) FROM v1) AS old_rows, (SELECT COUNT(*) FROM v3) AS new_rows,
  (SELECT COUNT(*) FROM v3) - (SELECT COUNT(*) FROM v1) AS diff"""))
def version_diff(spark, sf_dir):
    return versioned.version_diff(_history(spark, sf_dir, 3), 1, 3)
