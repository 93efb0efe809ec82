"""Snapshot dates: the first day of a month."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def snapshot_of(column: Column | str) -> Column:
    """The snapshot a date or timestamp belongs to."""
    return F.trunc(column, "month")


def as_date(value: str | dt.date) -> dt.date:
    """A date from ``YYYY-MM-DD``; other texts are refused."""
    if isinstance(value, dt.datetime):
        return value.date()
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def shift_months(day: dt.date, months: int) -> dt.date:
    """Calendar month arithmetic on the driver, clamped to the end of the month."""
    index = day.year * 12 + day.month - 1 + months
    year, month = divmod(index, 12)
    next_month = dt.date(year + (month == 11), (month + 1) % 12 + 1, 1)
    return dt.date(year, month + 1, min(day.day, (next_month - dt.timedelta(days=1)).day))
