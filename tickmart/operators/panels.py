"""Aggregates behind the dashboard panels and their filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickmart.functions.calendar import as_column, days_before
from tickmart.functions.classify import PUMP_1H, PUMP_24H, gauge_band, move_band, traffic_light

# Symbols pegged to a currency.
STABLECOINS = ["USDT", "USDC", "BUSD", "DAI"]


def rolling_range(df: DataFrame, as_of, days: int = 30, column: str = "date") -> DataFrame:
    """Rows of the last ``days`` days up to ``as_of``."""
    return df.where(F.col(column).between(days_before(as_of, days), F.to_date(as_column(as_of))))


def metric_condition(cap_above=None, volume_above=None, volatility_above=None, return_above=None, return_below=None,
                     cap_between=None, symbols=None, without=None) -> Column:
    """The saved dashboard filters, combined with AND; comparisons are strict, the range is inclusive."""
    terms = [F.col(column) > bound for column, bound in (
        ("market_cap_close", cap_above), ("volume_sum_day", volume_above), ("volatility_day", volatility_above),
        ("return_pct_day", return_above)) if bound is not None]
    if return_below is not None:
        terms.append(F.col("return_pct_day") < return_below)
    if cap_between is not None:
        terms.append(F.col("market_cap_close").between(*cap_between))
    if symbols:
        terms.append(F.col("symbol").isin(list(symbols)))
    if without:
        terms.append(~F.col("symbol").isin(list(without)))
    return reduce(lambda x, y: x & y, terms, F.lit(True))


def metric_filter(daily: DataFrame, **bounds) -> DataFrame:
    return daily.where(metric_condition(**bounds))


def panel_price_trend(daily: DataFrame, symbols, as_of, days: int = 30) -> DataFrame:
    return (rolling_range(daily, as_of, days).where(F.col("symbol").isin(list(symbols)))
            .groupBy("date", "symbol").agg(F.avg("close_price").alias("avg_close")))


def panel_volume_heatmap(daily: DataFrame, as_of, days: int = 30, top: int = 10) -> DataFrame:
    """Volume by day and symbol for the most traded symbols.

    A symbol's days, at most ``days + 1``, travel with its total, so picking the top symbols and
    listing their days is one pass without a join.
    """
    matrix = rolling_range(daily, as_of, days).groupBy("date", "symbol") \
        .agg(F.sum("volume_sum_day").alias("volume"))
    busiest = (matrix.groupBy("symbol").agg(F.sum("volume").alias("total"),
                                            F.collect_list(F.struct("date", "volume")).alias("days"))
               .orderBy(F.desc_nulls_last("total"), "symbol").limit(top))
    return busiest.select("symbol", F.inline("days")).select("date", "symbol", "volume")


def panel_weekly_perf(weekly: DataFrame, as_of, days: int = 7, top: int = 10) -> DataFrame:
    """Average weekly return of the best symbols among weeks that start in the range."""
    return (rolling_range(weekly, as_of, days, "week_start_date")
            .groupBy("symbol").agg(F.avg("return_pct_week").alias("avg_return"))
            .withColumn("colour", F.when(F.col("avg_return") >= 0, "green").otherwise("red"))
            .orderBy(F.desc_nulls_last("avg_return"), "symbol").limit(top))


def panel_monthly_trend(monthly: DataFrame, symbols, as_of, days: int = 365) -> DataFrame:
    return (rolling_range(monthly, as_of, days, "month_start_date")
            .where(F.col("symbol").isin(list(symbols)))
            .groupBy(F.trunc("month_start_date", "month").alias("month_start"), "symbol")
            .agg(F.avg("close_price_month").alias("avg_close")))


def panel_alert_types(alerts: DataFrame, size: int = 10) -> DataFrame:
    return (alerts.groupBy("alert_type").agg(F.count("*").alias("alerts"))
            .orderBy(F.desc("alerts"), "alert_type").limit(size))


def panel_alert_coins(messages: DataFrame, size: int = 15) -> DataFrame:
    """Symbols with the newest alerts, one line per alert type.

    One aggregate over the messages; a symbol then carries its lines, one per alert type.
    """
    per_type = messages.groupBy("symbol", "alert_type").agg(
        F.count("*").alias("alerts"), F.max(F.struct("alert_time", "current_price", "change_1h", "change_24h")).alias("r")) \
        .select("symbol", "alert_type", "alerts", F.col("r.current_price").alias("latest_price"), "r.change_1h", "r.change_24h", "r.alert_time")
    lines = F.struct("alert_type", "alerts", "latest_price", "change_1h", "change_24h", "alert_time")
    newest = (per_type.groupBy("symbol").agg(F.max("alert_time").alias("newest"), F.collect_list(lines).alias("lines"))
              .orderBy(F.desc("newest"), "symbol").limit(size))
    return newest.select("symbol", F.inline("lines")).withColumns(
        {"band_1h": move_band(F.col("change_1h"), PUMP_1H), "band_24h": move_band(F.col("change_24h"), PUMP_24H)})


def panel_sentiment_series(sentiment: DataFrame, interval: str = "minute") -> DataFrame:
    """Shares over time with the reference lines of the chart."""
    return sentiment.groupBy(F.date_trunc(interval, "window_start").alias("time")).agg(
        F.avg("bullish_pct").alias("bullish_pct"), F.avg("bearish_pct").alias("bearish_pct")) \
        .withColumns({"bullish_line": F.lit(60), "bearish_line": F.lit(40)})


def panel_sentiment_now(sentiment: DataFrame) -> DataFrame:
    """The newest window with its gauge band and colour."""
    now = sentiment.agg(F.max_by(F.struct("window_start", "sentiment", "bullish_pct", "bearish_pct",
                                          "avg_change_24h"), "window_start").alias("s")).select("s.*")
    return now.withColumns({
        "neutral_pct": F.round(100 - F.col("bullish_pct") - F.col("bearish_pct"), 2),
        "gauge": gauge_band(F.col("bullish_pct")), "light": traffic_light(F.col("bullish_pct"))})


def select_sentiment(sentiment: DataFrame, labels: list[str]) -> DataFrame:
    return sentiment.where(F.col("sentiment").isin(labels))
