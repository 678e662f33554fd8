"""Date helpers: calendar parts, batch stamps, month partitions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import STAMP_LAG_HOURS


def date_parts(c: Column, prefix: str) -> list[Column]:
    """``<prefix>_date`` plus its year, month and day (the EXTRACTs of the time mart)."""
    return [
        c.alias(f"{prefix}_date"),
        F.year(c).alias(f"{prefix}_year"),
        F.month(c).alias(f"{prefix}_month"),
        F.dayofmonth(c).alias(f"{prefix}_day"),
    ]


def stamp_time(batch_time: dt.datetime | str | None = None, lag_hours: int = STAMP_LAG_HOURS) -> Column:
    """The batch stamp: a fixed time if given, else now minus ``lag_hours``.

    The reference stamps ``CURRENT_TIMESTAMP() - INTERVAL 3 HOUR`` (a shift to
    local time). ``current_timestamp`` is fixed once per query, so every row
    of a batch gets the same stamp.
    """
    if batch_time is None:
        return (F.current_timestamp() - F.expr(f"INTERVAL {int(lag_hours)} HOURS")).cast("timestamp_ntz")
    if isinstance(batch_time, str):
        batch_time = dt.datetime.fromisoformat(batch_time)
    return ntz_lit(batch_time)


def ntz_lit(value: dt.datetime | dt.date) -> Column:
    """A ``timestamp_ntz`` literal, independent of the Python process time zone."""
    if not isinstance(value, dt.datetime):
        value = dt.datetime.combine(value, dt.time())
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def month_key(c: Column) -> Column:
    """Partition value for a month: ``yyyy-MM`` of a timestamp."""
    return F.date_format(c, "yyyy-MM")


def month_range(month: str) -> tuple[dt.date, dt.date]:
    """``'1998-09'`` -> (first day, first day of the next month)."""
    year, mon = (int(x) for x in month.split("-")[:2])
    start = dt.date(year, mon, 1)
    end = dt.date(year + (mon == 12), mon % 12 + 1, 1)
    return start, end
