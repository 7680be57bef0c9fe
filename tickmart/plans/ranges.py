"""Driver-side decisions of the incremental jobs: which days and periods to work on."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = dt.timedelta(days=1)


def days_of(start: dt.date, end: dt.date) -> Iterable[dt.date]:
    return (start + i * DAY for i in range((end - start).days + 1))


def week_key(day: dt.date) -> tuple[int, int]:
    """Calendar year and ISO week, the key of the weekly table."""
    return day.year, day.isocalendar().week


def months_of_weeks(weeks: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Calendar months that hold any day of the given weeks."""
    wanted = set(weeks)
    years = sorted({y for y, _ in weeks})
    return sorted({(d.year, d.month) for y in years for d in days_of(dt.date(y, 1, 1), dt.date(y, 12, 31))
                   if week_key(d) in wanted})


def in_pairs(first: str, second: str, pairs: list[tuple[int, int]]) -> Column:
    """``(first, second) IN pairs`` as one OR term per year; prunes a table partitioned by them.

    The list is bounded by the calendar: at most 53 entries per year of history.
    """
    by_first: dict[int, list[int]] = {}
    for a, b in pairs:
        by_first.setdefault(a, []).append(b)
    terms = [(F.col(first) == a) & F.col(second).isin(b) for a, b in by_first.items()]
    return reduce(lambda x, y: x | y, terms, F.lit(False))
