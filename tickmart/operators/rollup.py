"""Daily, weekly and monthly open/high/low/close tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tickmart.functions.calendar import calendar_parts, iso_week_year

COIN = ["coin_id", "symbol", "name"]


def first_by(value: str, order: str) -> Column:
    """Earliest non-null value. Both buffers are fixed-width, so this stays a hash aggregate."""
    return F.expr(f"min_by({value}, {order}) FILTER (WHERE {value} IS NOT NULL)")


def last_by(value: str, order: str) -> Column:
    return F.expr(f"max_by({value}, {order}) FILTER (WHERE {value} IS NOT NULL)")


def percent_of(part: Column, whole: Column) -> Column:
    """Percentage; null where the base is zero."""
    return F.try_divide(part, whole) * 100


def daily_ohlc(clean: DataFrame, order: str = "crawl_ts") -> DataFrame:
    """Coin-day aggregates. Ticks collapse map-side, so one dominant coin does not skew the shuffle."""
    return clean.groupBy(*COIN, "date").agg(
        first_by("current_price", order).alias("open_price"),
        last_by("current_price", order).alias("close_price"),
        F.max("current_price").alias("high_price"),
        F.min("current_price").alias("low_price"),
        last_by("total_volume", order).alias("volume_sum_day"),  # the day's last 24h figure, not a sum
        last_by("market_cap", order).alias("market_cap_close"),
        last_by("market_cap_rank", order).alias("market_cap_rank_close"),
        F.count("*").alias("record_count"),
    )


#: What a state keeps of each tick column: its value and time at the first and last tick that has one.
STATE_ENDS = {"open": ("current_price", min), "close": ("current_price", max), "volume": ("total_volume", max),
              "cap": ("market_cap", max), "rank": ("market_cap_rank", max)}


def _end(value: str, order: str, side) -> Column:
    return first_by(value, order) if side is min else last_by(value, order)


def tick_states(clean: DataFrame, period: Sequence[str], order: str = "crawl_ts") -> DataFrame:
    """Partial coin-period aggregates that ``merged_states`` can put together to longer periods.

    Each first or last value goes with its time, all fixed-width, so this and every merge stay hash aggregates.
    """
    ends = []
    for name, (value, side) in STATE_ENDS.items():
        pick = "min" if side is min else "max"
        ends += [F.expr(f"{pick}({order}) FILTER (WHERE {value} IS NOT NULL)").alias(f"{name}_at"), _end(value, order, side).alias(name)]
    return clean.groupBy(*COIN, *period).agg(*ends, F.max("current_price").alias("high"), F.min("current_price").alias("low"),
                                             F.count("*").alias("records"))


def merged_states(states: DataFrame, period: Sequence[str]) -> DataFrame:
    """States of a coarser period. In whatever order and grouping states are merged, the result is the same."""
    ends = []
    for name, (_, side) in STATE_ENDS.items():
        ends += [(F.min if side is min else F.max)(f"{name}_at").alias(f"{name}_at"), _end(name, f"{name}_at", side).alias(name)]
    return states.groupBy(*COIN, *period).agg(*ends, F.max("high").alias("high"), F.min("low").alias("low"), F.sum("records").alias("records"))


def ohlc_of_states(states: DataFrame) -> DataFrame:
    """The columns of ``daily_ohlc`` from states of coin-days."""
    return states.select(
        *COIN, "date", F.col("open").alias("open_price"), F.col("close").alias("close_price"), F.col("high").alias("high_price"),
        F.col("low").alias("low_price"), F.col("volume").alias("volume_sum_day"), F.col("cap").alias("market_cap_close"),
        F.col("rank").alias("market_cap_rank_close"), F.col("records").alias("record_count"))


def with_ratios(df: DataFrame, suffix: str, tail: str = "") -> DataFrame:
    o, c, h, low = (F.col(f"{side}_price{tail}") for side in ("open", "close", "high", "low"))
    return df.withColumns({f"return_pct_{suffix}": percent_of(c - o, o),
                           f"volatility_{suffix}": percent_of(h - low, o)})


def with_price_ranks(daily: DataFrame) -> DataFrame:
    """Rank of each coin by price among the coins of the day; ties go by coin id.

    Both windows share one exchange. A window group is the list of coins quoted on one day, one row
    each, whatever the number of ticks behind it.
    """
    def rank(price: str) -> Column:
        order = [F.desc(price), "coin_id", "symbol", "name"]
        return F.row_number().over(Window.partitionBy("date").orderBy(*order))

    return (daily.withColumn("rank_open", rank("open_price")).withColumn("rank_close", rank("close_price"))
            .withColumn("rank_change", F.col("rank_open") - F.col("rank_close")))


def daily_metrics(clean: DataFrame, order: str = "crawl_ts") -> DataFrame:
    return day_metrics(daily_ohlc(clean, order))


def day_metrics(ohlc: DataFrame) -> DataFrame:
    """Coin-days completed with ratios, ranks and calendar columns."""
    parts = calendar_parts("date")
    daily = with_price_ranks(
        with_ratios(ohlc, "day")
        .withColumn("price_range_day", F.col("high_price") - F.col("low_price")))
    daily = daily.withColumns({c: parts[c] for c in ("year", "month", "week_of_year", "day_of_week")})
    return daily.select(
        "date", "year", "month", "week_of_year", "day_of_week", *COIN,
        "open_price", "close_price", "high_price", "low_price",
        "return_pct_day", "volatility_day", "price_range_day",
        "volume_sum_day", "market_cap_close", "market_cap_rank_close",
        "rank_open", "rank_close", "rank_change", "record_count",
    )


def period_rollup(daily: DataFrame, period: Sequence[str], suffix: str) -> DataFrame:
    """Roll daily rows up to the period named by the ``period`` columns."""
    tail = f"_{suffix}"
    out = daily.groupBy(*COIN, *period).agg(
        F.min("date").alias(f"{suffix}_start_date"),
        F.max("date").alias(f"{suffix}_end_date"),
        first_by("open_price", "date").alias(f"open_price{tail}"),
        last_by("close_price", "date").alias(f"close_price{tail}"),
        F.max("high_price").alias(f"high_price{tail}"),
        F.min("low_price").alias(f"low_price{tail}"),
        F.sum("volume_sum_day").alias(f"volume_sum{tail}"),
        F.avg("volatility_day").alias(f"avg_volatility{tail}"),
        F.avg("rank_close").alias(f"avg_rank{tail}"),
        F.count("*").alias(f"days_in{tail}"),
    )
    out = with_ratios(out, suffix, tail)
    return out.select(
        *period, f"{suffix}_start_date", f"{suffix}_end_date", *COIN,
        *[f"{side}_price{tail}" for side in ("open", "close", "high", "low")],
        f"return_pct{tail}", f"volatility{tail}", f"avg_volatility{tail}",
        f"volume_sum{tail}", f"avg_rank{tail}", f"days_in{tail}",
    )


def weekly_metrics(daily: DataFrame, iso_year: bool = False) -> DataFrame:
    """Weekly table. By default the calendar year is paired with the ISO week, as in the daily table,
    so late-December days of week 1 join January of the same calendar year; ``iso_year`` uses the
    year the week belongs to instead."""
    if iso_year:
        daily = daily.withColumn("year", iso_week_year("date"))
    return period_rollup(daily, ["year", "week_of_year"], "week")


def monthly_metrics(daily: DataFrame) -> DataFrame:
    return period_rollup(daily, ["year", "month"], "month")


def period_averages(daily: DataFrame, period: Sequence[str]) -> DataFrame:
    """Average, highest and lowest price with volumes and change over a period."""
    out = daily.groupBy(*COIN, *period).agg(
        F.avg("close_price").alias("avg_price"), F.max("high_price").alias("max_price"),
        F.min("low_price").alias("min_price"), F.sum("volume_sum_day").alias("total_volume"),
        F.avg("volume_sum_day").alias("avg_daily_volume"),
        first_by("open_price", "date").alias("_open"), last_by("close_price", "date").alias("_close"),
        F.max("high_price").alias("_high"), F.min("low_price").alias("_low"),
    )
    o = F.col("_open")
    return out.select(*period, *COIN, "avg_price", "max_price", "min_price", "total_volume",
                      "avg_daily_volume", percent_of(F.col("_close") - o, o).alias("price_change_pct"),
                      percent_of(F.col("_high") - F.col("_low"), o).alias("volatility"))


def touched_periods(metrics: DataFrame, since, period: Sequence[str], end: str) -> DataFrame:
    """Weekly or monthly rows of the periods that hold a day from ``since`` on.

    A period's newest day over all coins decides. It is a window over one period's coins, so the daily rows behind
    the table are read once.
    """
    newest = F.max(end).over(Window.partitionBy(*period))
    return metrics.withColumn("_newest", newest).where(F.col("_newest") >= since).drop("_newest")


def date_bounds(df: DataFrame) -> DataFrame:
    return df.agg(F.min("date").alias("min_date"), F.max("date").alias("max_date"))


def records_per_date(df: DataFrame) -> DataFrame:
    return df.groupBy("date").agg(F.count("*").alias("records")).orderBy("date")


def day_sequence(clean: DataFrame) -> DataFrame:
    """First and last tick of every coin-day with the number of ticks between them.

    An aggregate, not a numbering window, so a day of one coin never has to fit into one task.
    """
    return clean.groupBy("coin_id", "date").agg(
        F.count("*").alias("ticks"),
        F.min("crawl_ts").alias("first_ts"), F.max("crawl_ts").alias("last_ts"),
        F.min_by("current_price", "crawl_ts").alias("first_price"),
        F.max_by("current_price", "crawl_ts").alias("last_price"),
    )
