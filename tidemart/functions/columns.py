"""Scalar expressions. All of them stay inside whole-stage code generation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def instant(epoch_ms: ColumnLike) -> Column:
    """Epoch milliseconds -> TIMESTAMP, keeping the milliseconds."""
    return F.timestamp_millis(_col(epoch_ms))


def event_time(epoch_ms: ColumnLike) -> Column:
    """Epoch milliseconds -> zone-less UTC timestamp, for results that are compared as text."""
    return instant(epoch_ms).cast("timestamp_ntz")


def event_day(epoch_ms: ColumnLike) -> Column:
    """Epoch milliseconds -> day in the session zone (UTC in this package)."""
    return F.to_date(instant(epoch_ms))


def week_of(day: ColumnLike) -> Column:
    """Monday of the week as a DATE."""
    return F.trunc(_col(day), "week")


def within_days(day: ColumnLike, as_of: dt.date, days: int) -> Column:
    """``day >= as_of - days``.

    Both sides are dates, so the test prunes ``dt`` partitions. With data on ``as_of``
    itself the range holds ``days + 1`` dates.
    """
    return _col(day) >= F.lit(as_of - dt.timedelta(days=days))


def null_if_zero(c: ColumnLike) -> Column:
    return F.nullif(_col(c), F.lit(0))


def ratio(x: ColumnLike, y: ColumnLike) -> Column:
    """``x / y`` as DOUBLE, NULL where ``y`` is zero (ANSI mode would fail instead)."""
    return _col(x).cast("double") / null_if_zero(_col(y).cast("double"))


def pct(x: ColumnLike, y: ColumnLike, digits: int = 2) -> Column:
    """``x`` as a percentage of ``y``, rounded; NULL where ``y`` is zero."""
    return F.round(
        _col(x).cast("double") * F.lit(100.0) / null_if_zero(_col(y).cast("double")), digits
    )


def zero_if_null(c: ColumnLike) -> Column:
    """Zero in the column's own type: decimal sums stay decimal."""
    return F.coalesce(_col(c), F.lit(0))


def value_when(column: str, equals: str, value: ColumnLike, otherwise=None) -> Column:
    """``CASE WHEN column = equals THEN value [ELSE otherwise] END``."""
    picked = F.when(F.col(column) == equals, _col(value))
    return picked if otherwise is None else picked.otherwise(F.lit(otherwise))


def json_field(document: ColumnLike, path: str, type_name: str = "string") -> Column:
    """One field of a JSON string column; NULL where it is absent or not of the type."""
    return F.get_json_object(_col(document), path).try_cast(type_name)


def bucket_of(ts: ColumnLike, seconds: int) -> Column:
    """Number of the fixed time slice that ``ts`` falls into."""
    whole = F.unix_micros(_col(ts).cast("timestamp"))
    return F.floor(whole / F.lit(seconds * 1_000_000)).cast("long")
