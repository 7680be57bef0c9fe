"""Market mood: bullish and bearish shares per time bucket, in batch and in streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickmart.functions.classify import sentiment
from tickmart.operators.rollup import COIN


def mood_columns(df: DataFrame, bucket: list[Column | str], change: str, average: str) -> DataFrame:
    """Counts, shares and label per bucket. A null change counts in the total and nowhere else."""
    move = F.col(change)
    out = df.groupBy(*bucket).agg(
        F.count("*").alias("total_coins"),
        F.count_if(move > 0).alias("bullish_count"), F.count_if(move < 0).alias("bearish_count"),
        F.count_if(move == 0).alias("neutral_count"), F.avg(move).alias(average),
    )
    share = {f"{side}_pct": F.round(F.col(f"{side}_count") / F.col("total_coins") * 100, 2)
             for side in ("bullish", "bearish")}
    return out.withColumns(share).withColumn("sentiment", sentiment(F.col("bullish_pct"), F.col("bearish_pct")))


def sentiment_1m(ticks: DataFrame) -> DataFrame:
    """Tumbling one-minute sentiment. Give a watermarked stream for the streaming form."""
    out = mood_columns(ticks, [F.window("crawl_ts", "1 minute")], "price_change_percentage_24h", "avg_change_24h")
    return out.select(F.col("window.start").alias("window_start"), "total_coins", "bullish_count",
                      "bearish_count", "neutral_count", "bullish_pct", "bearish_pct", "sentiment",
                      "avg_change_24h")


def latest_prices_1m(ticks: DataFrame) -> DataFrame:
    """Last price of every coin in each minute, with the minute's other closing figures.

    All figures are those of one tick; ticks of one time are ordered by the figures themselves.
    """
    last = F.max(F.struct("crawl_ts", "current_price", "price_change_percentage_24h", "market_cap_rank", "total_volume"))
    return ticks.groupBy(F.window("crawl_ts", "1 minute"), *COIN).agg(last.alias("r")).select(
        *COIN, F.col("r.current_price").alias("latest_price"), F.col("r.price_change_percentage_24h").alias("change_24h"),
        F.col("r.market_cap_rank").alias("rank"), F.col("r.total_volume").alias("volume"), F.col("r.crawl_ts").alias("last_update"))


def sentiment_daily(daily: DataFrame) -> DataFrame:
    return mood_columns(daily, ["date"], "return_pct_day", "avg_return_pct")
