"""Price alerts, whale and pump/dump detection, and the queries on the alert store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tickmart.functions.calendar import as_column, days_before
from tickmart.functions.classify import WHALE_RATIO, alert_type, severity
from tickmart.operators.rollup import COIN


def price_alerts(ticks: DataFrame) -> DataFrame:
    """Ticks that trip a threshold, with the rule's name. Stateless: the same for batch and stream."""
    return ticks.withColumn("alert_type", alert_type()).where(F.col("alert_type").isNotNull())


def alert_messages(alerts: DataFrame, alert_time: Column | None = None) -> DataFrame:
    """Alert rows in message form."""
    crawl_time = "crawl_time" if "crawl_time" in alerts.columns else "crawl_ts"
    return alerts.select(
        F.lit("price_alert").alias("alert_category"), "alert_type", *COIN, "current_price",
        F.col("price_change_percentage_1h").alias("change_1h"),
        F.col("price_change_percentage_24h").alias("change_24h"),
        "total_volume", F.col(crawl_time).cast("string").alias("crawl_time"),
        (F.current_timestamp() if alert_time is None else alert_time).alias("alert_time"),
    )


def as_keyed_json(df: DataFrame, key: Column | str) -> DataFrame:
    """Key and JSON value, the shape of a message-log sink. Null fields are left out of the JSON."""
    key = F.col(key) if isinstance(key, str) else key
    return df.select(key.cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))


def valid_alerts(messages: DataFrame) -> DataFrame:
    return messages.where((F.length("coin_id") > 0) & (F.length("alert_type") > 0))


def valid_sentiment(messages: DataFrame) -> DataFrame:
    return messages.where(F.col("window_start").isNotNull() & (F.length("sentiment") > 0))


def price_alert_records(ticks: DataFrame) -> DataFrame:
    """Price alerts in the shape of the alert store; the change is the one that tripped the rule."""
    change = F.when(F.col("alert_type").endswith("_1H"), F.col("price_change_percentage_1h")) \
        .otherwise(F.col("price_change_percentage_24h"))
    return price_alerts(ticks).select(
        "symbol", "name", "alert_type", severity(change).alias("severity"),
        change.alias("price_change_percent"), "current_price", F.col("crawl_ts").alias("detected_at"))


def with_volume_baseline(daily: DataFrame, days: int = 7) -> DataFrame:
    """Average volume of the ``days`` calendar days before each day, that day excluded.

    The window runs over one row per coin and day, so its size is the length of the calendar.
    """
    by_day = Window.partitionBy("coin_id").orderBy(F.unix_date("date")).rangeBetween(-days, -1)
    return daily.withColumn("normal_volume", F.avg("volume_sum_day").over(by_day))


def usual_volume(daily: DataFrame, days: int = 7) -> DataFrame:
    """Usual volume per coin as of its newest day, that day excluded."""
    per_day = with_volume_baseline(daily, days)
    return per_day.groupBy("coin_id").agg(F.max_by("normal_volume", F.struct("date", "symbol", "name")).alias("normal_volume"))


def whale_detection(daily: DataFrame, ratio: float = WHALE_RATIO, days: int = 7) -> DataFrame:
    spike = F.try_divide(F.col("volume_sum_day").cast("double"), F.col("normal_volume")) * 100
    return (
        with_volume_baseline(daily, days).withColumn("volume_spike_pct", spike)
        .where(F.col("volume_spike_pct") > ratio * 100)
        .select(*COIN, "date", F.col("volume_sum_day").alias("current_volume"), "normal_volume",
                "volume_spike_pct", "return_pct_day", "close_price")
    )


def whale_alert_records(daily: DataFrame) -> DataFrame:
    """Whale days in the shape of the alert store, stamped with the start of the day."""
    return whale_detection(daily).select(
        "symbol", "name", F.lit("WHALE_ALERT").alias("alert_type"),
        severity(F.col("return_pct_day")).alias("severity"),
        F.col("return_pct_day").alias("price_change_percent"), F.col("close_price").alias("current_price"),
        F.col("date").cast("timestamp_ntz").alias("detected_at"))


def pump_dump(daily: DataFrame, change: float = 10.0, ratio: float = WHALE_RATIO) -> DataFrame:
    """Days on which the price moved by more than ``change`` % on more than ``ratio`` x the usual volume."""
    move = F.col("return_pct_day")
    return (
        whale_detection(daily, ratio)
        .withColumn("type", F.when(move > change, "PUMP").when(move < -change, "DUMP"))
        .where(F.col("type").isNotNull())
        .select(*COIN, "date", "type", move.alias("price_change_pct"),
                F.col("volume_spike_pct").alias("volume_change_pct"), severity(move).alias("severity"))
    )


def pump_dump_list(events: DataFrame, kind: str = "all", on=None, limit: int = 50) -> DataFrame:
    """Largest events of one kind and day, each with the kind's totals over the whole selection.

    The totals come from one scalar subquery.
    """
    if on is not None:
        events = events.where(F.col("date") == as_column(on))
    totals = events.agg(F.struct(F.count_if(F.col("type") == "PUMP").alias("pumps"),
                                 F.count_if(F.col("type") == "DUMP").alias("dumps"))).scalar()
    if kind.lower() != "all":
        events = events.where(F.col("type") == kind.upper())
    top = events.orderBy(F.desc(F.abs("price_change_pct")), "coin_id", "date", "symbol", "name").limit(limit)
    return top.withColumns({"total_pumps": totals["pumps"], "total_dumps": totals["dumps"]})


def recent_alerts(alerts: DataFrame, kind: str | None = None, level: str | None = None,
                  limit: int = 50) -> DataFrame:
    """Newest alerts, optionally of one type and severity."""
    if kind:
        alerts = alerts.where(F.col("alert_type") == kind.upper())
    if level:
        alerts = alerts.where(F.col("severity") == level.upper())
    return newest(alerts, limit)


def newest(alerts: DataFrame, limit: int) -> DataFrame:
    return alerts.orderBy(F.desc("detected_at"), "symbol", "alert_type", "name").limit(limit)


def volume_spikes(alerts: DataFrame, limit: int = 100) -> DataFrame:
    """Whale alerts and every type that mentions volume (lower case), newest first."""
    kind = F.col("alert_type")
    return newest(alerts.where(kind.isin("whale_alert", "WHALE_ALERT") | kind.like("%volume%")), limit)


def since(alerts: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Alerts from the start of the calendar day ``days`` before ``as_of``."""
    return alerts.where(F.col("detected_at") >= days_before(as_of, days).cast("timestamp_ntz"))


def alerts_total(alerts: DataFrame, as_of, days: int = 7) -> DataFrame:
    return since(alerts, as_of, days).agg(F.count("*").alias("total_count"))


def alerts_by(alerts: DataFrame, column: str, as_of, days: int = 7, size: int = 20) -> DataFrame:
    """Most frequent values of a column."""
    return (since(alerts, as_of, days).where(F.col(column).isNotNull())
            .groupBy(column).agg(F.count("*").alias("alerts"))
            .orderBy(F.desc("alerts"), column).limit(size))


def alerts_by_day(alerts: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Alerts per day from the first to the last day with one; days in between without any count 0.

    Each counted day unfolds into itself and the empty days up to the next one. The window runs over
    the counted days, at most one row per calendar day.
    """
    counts = since(alerts, as_of, days).groupBy(F.to_date("detected_at").alias("day")) \
        .agg(F.count("*").alias("n"))
    following = F.lead("day").over(Window.orderBy("day"))
    until = F.coalesce(F.date_sub(following, 1), F.col("day"))
    return (counts.withColumn("until", until)
            .select("n", F.posexplode(F.sequence("day", "until")).alias("offset", "date"))
            .select("date", F.when(F.col("offset") == 0, F.col("n")).otherwise(0).alias("alerts")))


def alert_counts(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy(F.to_date("detected_at").alias("date"), "alert_type") \
        .agg(F.count("*").alias("alerts"))


def alerts_recent_by_coin(alerts: DataFrame, as_of, kind: str = "PUMP_1H", hours: int = 1) -> DataFrame:
    recent = F.col("detected_at") >= as_column(as_of) - F.expr(f"INTERVAL {int(hours)} HOURS")
    return alerts.where((F.col("alert_type") == kind) & recent) \
        .groupBy("symbol").agg(F.count("*").alias("alerts"))


def select_alerts(alerts: DataFrame, kinds: list[str] | None = None,
                  symbols: list[str] | None = None) -> DataFrame:
    """Multi-select dashboard filter."""
    if kinds:
        alerts = alerts.where(F.col("alert_type").isin(kinds))
    if symbols:
        alerts = alerts.where(F.col("symbol").isin(symbols))
    return alerts
