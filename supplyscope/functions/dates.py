"""Calendar arithmetic. The clock is always an argument, so a report can be rerun for a past day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .coerce import parse_ts, to_day


def as_of_column(as_of: dt.date | None) -> Column:
    """The report's day; today where none is given."""
    return F.current_date() if as_of is None else F.lit(as_of)


def date_text(c: Column) -> Column:
    """The ``yyyy-mm-dd`` prefix of a date, timestamp or ISO text."""
    return F.substring(c.cast("string"), 1, 10)


def week_monday(c: Column) -> Column:
    """Monday on or before the day."""
    return F.date_sub(F.next_day(to_day(c), "Mon"), 7)


def months_ago(as_of: dt.date | None, n: int) -> Column:
    """``n`` months earlier, clamped to the end of a shorter month."""
    return F.add_months(as_of_column(as_of), -n)


def days_ago(as_of: dt.date | None, n: int) -> Column:
    return F.date_sub(as_of_column(as_of), n)


def age_days(c: Column, as_of: dt.date | None) -> Column:
    """Whole days from ``c`` to the report's day (or moment, when ``as_of`` is a datetime)."""
    if isinstance(as_of, dt.datetime):
        return F.timestamp_diff("DAY", parse_ts(c), F.lit(as_of).cast("timestamp_ntz")).cast("int")
    return F.date_diff(as_of_column(as_of), to_day(c))
