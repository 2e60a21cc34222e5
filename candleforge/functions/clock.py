"""Time buckets and ages. "Now" is always an argument, so results are reproducible."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def hour_bucket(time: Column) -> Column:
    return F.date_trunc("HOUR", time)


def whole_hours_between(earlier: Column, later: Column) -> Column:
    """Completed hours, cut toward zero."""
    return F.timestamp_diff("HOUR", earlier, later)


def age_in_days(day: Column, as_of: Column) -> Column:
    return F.datediff(as_of, day)


def previous_day(as_of: dt.date) -> dt.date:
    """The newest day whose file is final: files close at UTC midnight."""
    return as_of - dt.timedelta(days=1)
