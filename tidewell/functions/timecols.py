"""Time helpers.  Day differences are elapsed whole 24-hour days (truncated),
not calendar-midnight counts."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def as_ts(value: dt.datetime) -> Column:
    """A timestamp_ntz literal (wall clock in UTC)."""
    return F.lit(value).cast("timestamp_ntz")


def floor_days(later: Column | str, earlier: Column | str) -> Column:
    """Whole elapsed days from ``earlier`` to ``later`` (truncated toward zero)."""
    return F.timestamp_diff("DAY", _c(earlier), _c(later))


def month_index(x: Column | str) -> Column:
    """Months since year 0: year*12 + month - 1, for month arithmetic."""
    c = _c(x)
    return F.year(c) * 12 + F.month(c) - 1
