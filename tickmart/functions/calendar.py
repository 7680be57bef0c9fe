"""Time columns: tolerant parsing, calendar parts and ISO text."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def instant(text: Column | str) -> Column:
    """ISO-8601 text to an instant. Offsets are honoured, zone-less text is UTC, junk is null."""
    return F.try_to_timestamp(F.col(text) if isinstance(text, str) else text)


def calendar_parts(ts: Column | str) -> dict[str, Column]:
    """Date, hour, weekday (1 = Sunday), ISO week, month and calendar year of a timestamp."""
    return {
        "date": F.to_date(ts),
        "hour": F.hour(ts),
        "day_of_week": F.dayofweek(ts),
        "week_of_year": F.weekofyear(ts),
        "month": F.month(ts),
        "year": F.year(ts),
    }


def iso_text(ts: Column | str) -> Column:
    return F.date_format(ts, ISO_MILLIS)


def iso_week_year(date: Column | str) -> Column:
    """The year an ISO week belongs to; differs from the calendar year around New Year."""
    return F.extract(F.lit("YEAROFWEEK"), F.col(date) if isinstance(date, str) else date).cast("int")


def days_before(as_of: Column | dt.date | dt.datetime, days: int) -> Column:
    """The calendar date ``days`` before ``as_of``."""
    return F.date_sub(F.to_date(as_of if isinstance(as_of, Column) else F.lit(as_of)), days)


def as_column(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)
