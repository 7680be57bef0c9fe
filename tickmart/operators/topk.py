"""Most frequent values over any range of days, from one small sketch a day instead of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Values a sketch follows. Counts are exact while no more than these differ.
TRACKED = 4096


def count_error(rows: int, tracked: int = TRACKED) -> float:
    """What a count may be too large by at most, over ``rows`` rows: 3.5 shares of the sketch's table, which has a power of two slots
    of which three quarters are used."""
    slots = 1 << (max(tracked * 4 // 3, 8) - 1).bit_length()
    return 3.5 * rows / slots


def daily_sketches(rows: DataFrame, column: str, at: str, tracked: int = TRACKED) -> DataFrame:
    """``day, sketch, rows``: the values of each day. Sketches build up inside map tasks, so a frequent value costs no shuffle."""
    return rows.where(F.col(column).isNotNull()).groupBy(F.to_date(at).alias("day")).agg(
        F.expr(f"approx_top_k_accumulate({column}, {int(tracked)})").alias("sketch"), F.count("*").alias("rows"))


def most_frequent(sketches: DataFrame, size: int, tracked: int = TRACKED) -> DataFrame:
    """``item, count`` of the most frequent values over all given days; a count is never too small and at most ``count_error`` too large.

    All followed values leave the sketch and are ordered here, so equal counts go by the value.
    """
    whole = sketches.agg(F.expr(f"approx_top_k_estimate(approx_top_k_combine(sketch, {int(tracked)}), {int(tracked)})").alias("top"))
    return whole.select(F.inline("top")).orderBy(F.desc("count"), "item").limit(size)
