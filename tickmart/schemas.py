"""Fixed schemas of every table and message. Nothing is inferred at run time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Column lists are kept as DDL text so that they can be read next to each other.
# These names and types are the interchange format.

#: Number fields of a raw message arrive as int, float or quoted text, so they are read as text and
#: coerced later: one malformed cell then becomes null without voiding the row.
RAW_DDL = """
    crawl_time string, source string, coin_id string, symbol string, name string,
    current_price string, price_change_24h string, price_change_percentage_24h string,
    price_change_percentage_1h string, price_change_percentage_7d string,
    market_cap string, market_cap_rank string, total_volume string,
    circulating_supply string, total_supply string, max_supply string,
    high_24h string, low_24h string, ath string, ath_change_percentage string, ath_date string,
    atl string, atl_change_percentage string, atl_date string,
    image_url string, last_updated string, fake_date string, fake_minute string
"""

#: One element of the price API's answer.
PAYLOAD_DDL = """
    id string, symbol string, name string, image string,
    current_price string, price_change_24h string, price_change_percentage_24h string,
    price_change_percentage_1h_in_currency string, price_change_percentage_7d_in_currency string,
    market_cap string, market_cap_rank string, total_volume string,
    circulating_supply string, total_supply string, max_supply string,
    high_24h string, low_24h string, ath string, ath_change_percentage string, ath_date string,
    atl string, atl_change_percentage string, atl_date string, last_updated string
"""

#: Target type of each coerced measure.
MEASURES = {
    "current_price": "double",
    "market_cap": "bigint",
    "market_cap_rank": "int",
    "total_volume": "bigint",
    "circulating_supply": "double",
    "total_supply": "double",
    "max_supply": "double",
    "price_change_24h": "double",
    "price_change_percentage_24h": "double",
    "price_change_percentage_1h": "double",
    "price_change_percentage_7d": "double",
    "high_24h": "double",
    "low_24h": "double",
    "ath": "double",
    "atl": "double",
}

#: Clean tick table, in output order. ``crawl_ts`` and ``last_updated`` keep the type they come with.
CLEAN_COLUMNS = {
    "coin_id": "string", "symbol": "string", "name": "string",
    "crawl_ts": "timestamp", "date": "date", "hour": "int", "day_of_week": "int",
    "week_of_year": "int", "month": "int", "year": "int",
    "current_price": "double", "high_24h": "double", "low_24h": "double",
    "ath": "double", "atl": "double",
    "market_cap": "bigint", "market_cap_rank": "int", "total_volume": "bigint",
    "circulating_supply": "double", "total_supply": "double", "max_supply": "double",
    "price_change_24h": "double", "price_change_percentage_24h": "double",
    "price_change_percentage_1h": "double", "price_change_percentage_7d": "double",
    "source": "string", "last_updated": "string",
}

ALERT_DDL = """
    alert_category string, alert_type string, coin_id string, symbol string, name string,
    current_price double, change_1h double, change_24h double, total_volume bigint,
    crawl_time string, alert_time timestamp
"""

SENTIMENT_DDL = """
    window_start timestamp, total_coins bigint, bullish_count bigint, bearish_count bigint,
    neutral_count bigint, bullish_pct double, bearish_pct double, sentiment string,
    avg_change_24h double
"""


#: Metric tables as they are stored.
DAILY_DDL = """
    date date, week_of_year int, day_of_week int, coin_id string, symbol string, name string,
    open_price double, close_price double, high_price double, low_price double,
    return_pct_day double, volatility_day double, price_range_day double,
    volume_sum_day bigint, market_cap_close bigint, market_cap_rank_close int,
    rank_open int, rank_close int, rank_change int, record_count bigint,
    year int, month int, day int
"""


#: Partial aggregates of one coin and hour.
HOUR_STATE_DDL = """
    coin_id string, symbol string, name string, open_at timestamp, open double, close_at timestamp, close double,
    volume_at timestamp, volume bigint, cap_at timestamp, cap bigint, rank_at timestamp, rank int,
    high double, low double, records bigint, date date, hour int
"""


def period_ddl(suffix: str, part: str) -> str:
    prices = ", ".join(f"{side}_price_{suffix} double" for side in ("open", "close", "high", "low"))
    return f"""
        {suffix}_start_date date, {suffix}_end_date date, coin_id string, symbol string, name string, {prices},
        return_pct_{suffix} double, volatility_{suffix} double, avg_volatility_{suffix} double,
        volume_sum_{suffix} bigint, avg_rank_{suffix} double, days_in_{suffix} bigint, year int, {part} int
    """


METRIC_DDL = {"daily_metrics": DAILY_DDL, "weekly_metrics": period_ddl("week", "week_of_year"),
              "monthly_metrics": period_ddl("month", "month")}


def clean_schema() -> T.StructType:
    return T.StructType.fromDDL(", ".join(f"{c} {t}" for c, t in CLEAN_COLUMNS.items()))


def raw_schema() -> T.StructType:
    return T.StructType.fromDDL(RAW_DDL)


def typed_or_null(df: DataFrame, columns: dict[str, str]) -> list[Column]:
    """Select list in the given order; a column the input lacks becomes a typed null."""
    present = set(df.columns)
    return [F.col(c) if c in present else F.lit(None).cast(t).alias(c) for c, t in columns.items()]
