"""Tick-shaped views over the star-schema test tables (see FIXTURES.md, section 3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def event_ticks(events: DataFrame, truncate: bool = True) -> DataFrame:
    """Rows of ``events`` as raw ticks. With ``truncate`` the crawl time is cut to the hour, which yields
    several copies per coin and crawl time; without it every tick has its own time (live feed)."""
    crawl_ts = "CAST(date_trunc('hour', ts) AS TIMESTAMP_NTZ)" if truncate else "ts"
    base = events.selectExpr(
        "event_id", "ts", "event_type", "value", "CAST(user_id % 20 AS INT) AS k",
        "CAST(regexp_extract(props, '[0-9]+', 0) AS INT) AS jk")
    return base.selectExpr(
        "concat('coin-', k) AS coin_id", "concat('C', k) AS symbol", "concat('Coin ', k) AS name",
        f"{crawl_ts} AS crawl_ts", "ts AS last_updated", "event_type AS source",
        "value AS current_price",
        "CAST(round(value * 100) AS BIGINT) * 1000 * (k + 1) AS market_cap",
        "k + 1 AS market_cap_rank",
        "(event_id * 7919) % 1000000 AS total_volume",
        "CAST(jk - 50 AS DOUBLE) / 5 AS price_change_percentage_1h",
        "CAST((event_id * 37) % 401 - 200 AS DOUBLE) / 10 AS price_change_percentage_24h",
        "CAST((event_id * 53) % 551 - 250 AS DOUBLE) / 10 AS price_change_percentage_7d")


def ticks(spark: SparkSession, folder: str, truncate: bool = True) -> DataFrame:
    return event_ticks(table(spark, folder, "events"), truncate)


def live_ticks(spark: SparkSession, folder: str) -> DataFrame:
    return ticks(spark, folder, truncate=False)


def order_ticks(spark: SparkSession, folder: str) -> DataFrame:
    """``orders`` as valid ticks over seven years: the priority plays the coin, the total its price.
    The order key gives the sequence within a day."""
    return table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("coin_id"), F.col("o_orderpriority").alias("symbol"),
        F.col("o_orderpriority").alias("name"), F.to_date("o_orderdate").alias("date"),
        F.col("o_orderkey"), F.col("o_totalprice").alias("current_price"),
        F.col("o_custkey").alias("total_volume"), F.col("o_custkey").alias("market_cap"),
        F.lit(1).alias("market_cap_rank"))


def order_moves(spark: SparkSession, folder: str) -> DataFrame:
    """``orders`` as clean ticks with changes; the order key makes their times distinct."""
    return table(spark, folder, "orders").selectExpr(
        "o_orderpriority AS coin_id", "o_orderpriority AS symbol", "to_date(o_orderdate) AS date",
        "timestampadd(MICROSECOND, o_orderkey, o_orderdate) AS crawl_ts", "o_totalprice AS current_price",
        "o_custkey AS total_volume", "CAST((o_orderkey * 37) % 401 - 200 AS DOUBLE) / 10 AS price_change_percentage_24h",
        "CAST((o_orderkey * 53) % 551 - 250 AS DOUBLE) / 10 AS price_change_percentage_7d")
