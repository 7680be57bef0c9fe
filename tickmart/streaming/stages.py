"""Transformations from messages to the streaming outputs; each is also valid on a batch frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickmart.functions.calendar import instant
from tickmart.functions.classify import WHALE_RATIO
from tickmart.operators import alerts, clean
from tickmart.operators.alerts import as_keyed_json, valid_alerts, valid_sentiment
from tickmart.operators.sentiment import latest_prices_1m, sentiment_1m
from tickmart.schemas import ALERT_DDL, SENTIMENT_DDL
from tickmart.sources.raw import routed
from tickmart.streaming import volume_state

LATENESS = "1 minute"
#: How far apart, in event time, copies of a message may come and still be told from a new one.
REPEATS_WITHIN = "1 day"

# Fields of the stream and their types.
STREAM_COLUMNS = {
    "crawl_time": "string", "coin_id": "string", "symbol": "string", "name": "string",
    "current_price": "double", "price_change_24h": "double", "price_change_percentage_24h": "double",
    "price_change_percentage_1h": "double", "price_change_percentage_7d": "double",
    "market_cap": "bigint", "market_cap_rank": "bigint", "total_volume": "bigint",
    "circulating_supply": "bigint", "high_24h": "double", "low_24h": "double",
}


def parse_ticks(messages: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Message values to typed ticks. A bad cell is null; a message that is no JSON is all null."""
    as_text = ", ".join(f"{c} string" for c in STREAM_COLUMNS)
    parsed = messages.select(F.from_json(F.col("value").cast("string"), as_text).alias("m")).select("m.*")
    types = {f.name: f.dataType for f in parsed.schema.fields}
    typed = parsed.select(*[clean.coerce(c, types[c], t).alias(c) for c, t in STREAM_COLUMNS.items()])
    return typed.withColumns({"crawl_ts": instant("crawl_time"),
                              "processing_time": F.current_timestamp() if processed_at is None else processed_at})


def watermarked(ticks: DataFrame) -> DataFrame:
    return ticks.withWatermark("crawl_ts", LATENESS)


def unique_ticks(ticks: DataFrame, within: str = REPEATS_WITHIN) -> DataFrame:
    """The first arrival of every coin and crawl time.

    A key is remembered for ``within`` of event time after it was seen, so the state holds that much of the feed and
    no more. A message that comes later than that behind the newest one is dropped as late; the landing folders
    have it, and the batch jobs take it from there. Ticks without event time can't be told apart and all pass.
    """
    timed, untimed = ticks.where("crawl_ts IS NOT NULL"), ticks.where("crawl_ts IS NULL")
    keys = ["coin_id", "crawl_ts"]
    if not ticks.isStreaming:
        return timed.dropDuplicates(keys).unionByName(untimed)
    return timed.withWatermark("crawl_ts", within).dropDuplicatesWithinWatermark(keys).unionByName(untimed)


def clean_messages(ticks: DataFrame) -> DataFrame:
    return as_keyed_json(clean.validate(ticks), "coin_id")


def rejected_messages(messages: DataFrame) -> DataFrame:
    """Original text of the messages that do not make a valid tick."""
    kept = messages.select(F.col("value").cast("string").alias("_message"), "value")
    as_text = ", ".join(f"{c} string" for c in STREAM_COLUMNS)
    parsed = kept.select("_message", F.from_json("_message", as_text).alias("m")).select("_message", "m.*")
    return clean.rejects(clean.coerce_measures(parsed)).select(F.col("_message").alias("value"))


def alert_stream(ticks: DataFrame, alert_time: Column | None = None) -> DataFrame:
    return alerts.alert_messages(alerts.price_alerts(ticks), alert_time)


def monitor_rows(ticks: DataFrame) -> DataFrame:
    return alerts.price_alerts(ticks).select("crawl_ts", "symbol", "alert_type", "current_price",
                                             "price_change_percentage_1h", "price_change_percentage_24h")


def sentiment_stream(ticks: DataFrame) -> DataFrame:
    return sentiment_1m(watermarked(ticks))


def latest_price_stream(ticks: DataFrame) -> DataFrame:
    return latest_prices_1m(watermarked(ticks))


def whale_day_stream(ticks: DataFrame) -> DataFrame:
    """Volume spikes of closed days, judged by the days before as the stream itself has seen them."""
    return volume_state.whale_days(clean.validate(ticks), LATENESS)


def whale_stream(ticks: DataFrame, baseline: DataFrame, ratio: float = WHALE_RATIO) -> DataFrame:
    """Ticks whose volume exceeds ``ratio`` x the coin's usual volume, at once and tick by tick.

    ``baseline`` is a stored table with one row per coin (``coin_id, normal_volume``).
    """
    spike = F.try_divide(F.col("total_volume").cast("double"), F.col("normal_volume")) * 100
    return (ticks.join(baseline.select("coin_id", "normal_volume"), "coin_id")
            .withColumn("volume_spike_pct", spike).where(F.col("volume_spike_pct") > ratio * 100)
            .select(F.lit("WHALE_ALERT").alias("alert_type"), "coin_id", "symbol", "name", "current_price",
                    F.col("total_volume").alias("current_volume"), "normal_volume", "volume_spike_pct", "crawl_ts"))


def read_alerts(messages: DataFrame) -> DataFrame:
    parsed = messages.select(F.from_json(F.col("value").cast("string"), ALERT_DDL).alias("m")).select("m.*")
    return valid_alerts(parsed)


def read_sentiment(messages: DataFrame) -> DataFrame:
    parsed = messages.select(F.from_json(F.col("value").cast("string"), SENTIMENT_DDL).alias("m")).select("m.*")
    return valid_sentiment(parsed)


def landing_rows(messages: DataFrame) -> DataFrame:
    """Message text on one line each, with its landing folder."""
    line = F.regexp_replace(F.col("value").cast("string"), "[\\r\\n]+", " ")
    parts = messages.select(line.alias("value")).withColumn(
        "m", F.from_json("value", "crawl_time string, fake_date string"))
    return routed(parts.select("value", "m.crawl_time", "m.fake_date")).select("value", "dt", "hr")
