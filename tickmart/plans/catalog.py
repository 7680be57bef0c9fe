"""Every query of the engine, bound to the test tables: name -> callable(spark, folder)."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickmart.functions.calendar import calendar_parts, instant
from tickmart.operators import alerts, clean, export, fuzzy, market, merge, panels, rollup, sentiment, serving, topk
from tickmart.schemas import ALERT_DDL
from tickmart.session import pin_utc
from tickmart.sources import payload, raw
from tickmart.sources import tick_tables as tt
from tickmart.streaming import replay, stages

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TICK_COLUMNS = ["coin_id", "symbol", "name", "crawl_ts", "last_updated", "source", "current_price", "market_cap",
                "market_cap_rank", "total_volume", "price_change_percentage_1h", "price_change_percentage_24h",
                "price_change_percentage_7d"]
CLEAN_OUT = ["coin_id", "symbol", "name", "crawl_ts", "date", "hour", "day_of_week", "week_of_year", "month",
             "year", "current_price", "market_cap", "market_cap_rank", "total_volume",
             "price_change_percentage_24h", "price_change_percentage_1h", "price_change_percentage_7d",
             "source", "last_updated"]
BASE, SECOND = "coin-0", "coin-1"
#: The test feed's capitalisations are small; these bounds fill all three tiers.
TIER_BOUNDS = (50_000_000, 200_000_000)


class Feed:
    """Lazy inputs of one query over one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = pin_utc(spark), folder

    def table(self, name: str) -> DataFrame:
        return tt.table(self.spark, self.folder, name)

    @cached_property
    def ticks(self) -> DataFrame:
        return tt.ticks(self.spark, self.folder)

    @cached_property
    def live(self) -> DataFrame:
        return tt.live_ticks(self.spark, self.folder)

    @cached_property
    def streamed(self) -> DataFrame:
        """The live ticks as a stream of the table's files."""
        events = replay.table_stream(self.spark, self.folder, "events")
        return tt.event_ticks(events, truncate=False).withColumn("crawl_ts", F.col("crawl_ts").cast("timestamp"))

    @cached_property
    def spoiled(self) -> DataFrame:
        """The ticks with cells broken in every way that validation knows."""
        v = F.col("total_volume")
        return self.ticks.withColumns({
            "current_price": F.when(v % 13 == 0, F.lit(None)).when(v % 17 == 0, F.lit(-1.0)).when(v % 19 == 0, F.lit(0.0))
            .otherwise(F.col("current_price")),
            "market_cap": F.when(v % 23 == 0, F.lit(None)).when(v % 29 == 0, F.lit(0)).otherwise(F.col("market_cap")),
            "total_volume": F.when(v % 31 == 0, F.lit(None)).when(v % 37 == 0, -v).otherwise(v),
            "coin_id": F.when(v % 41 != 0, F.col("coin_id")), "symbol": F.when(v % 43 != 0, F.col("symbol"))})

    @cached_property
    def clean(self) -> DataFrame:
        return clean.clean_ticks(self.ticks)

    @cached_property
    def daily(self) -> DataFrame:
        return rollup.daily_metrics(self.clean)

    @cached_property
    def weekly(self) -> DataFrame:
        return rollup.weekly_metrics(self.daily)

    @cached_property
    def monthly(self) -> DataFrame:
        return rollup.monthly_metrics(self.daily)

    @cached_property
    def latest(self) -> DataFrame:
        return serving.latest_snapshot(self.clean)

    @cached_property
    def history(self) -> DataFrame:
        return serving.history_table(self.daily)

    @cached_property
    def alert_store(self) -> DataFrame:
        return alerts.price_alert_records(self.live).unionByName(alerts.whale_alert_records(self.daily))

    @cached_property
    def messages(self) -> DataFrame:
        return alerts.alert_messages(alerts.price_alerts(self.live), alert_time=F.col("crawl_ts"))

    @cached_property
    def as_of(self) -> Column:
        """The newest event time; stands in for the clock, so results repeat."""
        return self.table("events").agg(F.max("ts")).scalar()


def query(fn: Callable[[Feed], DataFrame]) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return fn(Feed(spark, folder))

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return run


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Sums of doubles depend on the order of addition; compare them to a fixed number of digits.

    A sum that cancels out may round to minus zero, which is zero.
    """
    def fixed(c: str) -> Column:
        r = F.round(c, digits)
        return F.when(r == 0, F.lit(0.0)).otherwise(r)

    return df.withColumns({c: fixed(c) for c in columns})


def ntz(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


# --- cleaning ---------------------------------------------------------------------------------

@query
def clean_cast(f: Feed) -> DataFrame:
    text = f.ticks.select("coin_id", "last_updated", *[
        F.when(F.col("total_volume") % 97 == 0, F.lit("n/a")).otherwise(F.col(c).cast("string")).alias(c)
        for c in ("market_cap", "market_cap_rank", "total_volume")],
        F.when(F.col("total_volume") % 89 == 0, F.lit("?"))
        .otherwise(F.col("current_price").cast("string")).alias("current_price"),
        F.concat(F.col("market_cap").cast("string"), F.lit(".9")).alias("max_supply"))
    return clean.coerce_measures(text)


@query
def dedup_latest(f: Feed) -> DataFrame:
    return clean.dedup_latest(f.ticks).select(*TICK_COLUMNS)


@query
def dedup_hourly(f: Feed) -> DataFrame:
    return clean.dedup_hourly(f.live).select("coin_id", "crawl_ts", "current_price", "total_volume")


@query
def clean_validate(f: Feed) -> DataFrame:
    return clean.validate(f.spoiled).select(*TICK_COLUMNS)


@query
def clean_ticks(f: Feed) -> DataFrame:
    return clean.clean_ticks(f.spoiled).select(*CLEAN_OUT)


@query
def quality_report(f: Feed) -> DataFrame:
    return clean.quality_report(f.spoiled)


@query
def incremental_window(f: Feed) -> DataFrame:
    until = f.as_of - F.expr("INTERVAL 1 DAY")
    return clean.incremental_window(f.live, until - F.expr("INTERVAL 7 DAYS"), until).select(*TICK_COLUMNS)


@query
def fn_calendar(f: Feed) -> DataFrame:
    iso = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    text = F.when(F.col("o_orderkey") % 50 == 0, F.lit("not a time")).otherwise(iso)
    parsed = f.table("orders").select("o_orderkey", instant(text).cast("timestamp_ntz").alias("ts"))
    return parsed.select("o_orderkey", "ts", *[c.alias(n) for n, c in calendar_parts("ts").items()],
                         F.dayofmonth("ts").alias("day"))


@query
def scan_date_range(f: Feed) -> DataFrame:
    day = F.to_date(f.as_of)
    return f.clean.where(F.col("date").between(F.date_sub(day, 10), F.date_sub(day, 3))) \
        .select("coin_id", "crawl_ts", "date", "current_price", "total_volume")


@query
def raw_partition_route(f: Feed) -> DataFrame:
    v = F.col("total_volume")
    iso = F.date_format("last_updated", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    messages = f.ticks.select(
        "coin_id", "last_updated",
        F.when(v % 7 == 0, F.lit("garbled")).when(v % 11 != 0, iso).alias("crawl_time"),
        F.when(v % 3 == 0, F.lit("2023-12-31")).alias("fake_date"))
    return raw.routed(messages).select("coin_id", "last_updated", "dt", "hr")


@query
def affected_partitions(f: Feed) -> DataFrame:
    return clean.affected_partitions(f.clean)


@query
def records_per_date(f: Feed) -> DataFrame:
    return rollup.records_per_date(f.clean)


@query
def date_bounds(f: Feed) -> DataFrame:
    return rollup.date_bounds(f.clean)


# --- parsing ----------------------------------------------------------------------------------

@query
def parse_json(f: Feed) -> DataFrame:
    return f.table("events").select("event_id", F.from_json("props", "k INT").alias("p")).select("event_id", "p.k")


@query
def normalize_payload(f: Feed) -> DataFrame:
    coin = F.struct(
        F.concat(F.lit("part-"), F.col("p_partkey")).alias("id"), F.lower("p_brand").alias("symbol"),
        F.col("p_name").alias("name"), F.col("p_retailprice").alias("current_price"),
        (F.col("p_partkey") + 1).alias("market_cap"), F.col("p_size").alias("market_cap_rank"),
        F.when(F.col("p_partkey") % 4 != 0, F.col("p_size") - 25)
        .alias("price_change_percentage_1h_in_currency"))
    answers = f.table("part").select(F.to_json(F.array(coin)).alias("body"))
    rows = clean.coerce_measures(payload.normalize_payload(answers, "body", F.lit("2024-01-01T00:00:00")))
    return rows.select("crawl_time", "source", "coin_id", "symbol", "name", "current_price", "market_cap",
                       "market_cap_rank", "price_change_percentage_1h")


@query
def alert_json(f: Feed) -> DataFrame:
    """Alerts written as JSON messages and read back."""
    sent = alerts.as_keyed_json(f.messages, "coin_id")
    back = sent.select("key", F.from_json("value", ALERT_DDL).alias("a")).select("key", "a.*")
    return ntz(back, "alert_time").drop("crawl_time")


# --- rollups ----------------------------------------------------------------------------------

@query
def daily_ohlc(f: Feed) -> DataFrame:
    return rollup.daily_ohlc(f.clean)


@query
def merged_states(f: Feed) -> DataFrame:
    """Daily metrics from stored-form states: hours merged to half days, half days to days."""
    hours = rollup.tick_states(f.clean, ["date", "hour"])
    halves = rollup.merged_states(hours.withColumn("half", F.floor(F.col("hour") / 12)), ["date", "half"])
    return rollup.day_metrics(rollup.ohlc_of_states(rollup.merged_states(halves, ["date"])))


@query
def daily_metrics(f: Feed) -> DataFrame:
    return f.daily


@query
def daily_ranks(f: Feed) -> DataFrame:
    return f.daily.select("coin_id", "date", "open_price", "close_price", "rank_open", "rank_close", "rank_change")


@query
def day_sequence(f: Feed) -> DataFrame:
    return rollup.day_sequence(f.clean)


@query
def weekly_metrics(f: Feed) -> DataFrame:
    return rounded(f.weekly, 6, "avg_volatility_week", "avg_rank_week")


@query
def monthly_metrics(f: Feed) -> DataFrame:
    return rounded(f.monthly, 6, "avg_volatility_month", "avg_rank_month")


def recent_day(f: Feed) -> Column:
    """Daily rows from this day on have just arrived."""
    return F.date_sub(F.to_date(f.as_of), 3)


@query
def affected_weeks(f: Feed) -> DataFrame:
    weeks = rollup.touched_periods(f.weekly, recent_day(f), ["year", "week_of_year"], "week_end_date")
    return rounded(weeks, 6, "avg_volatility_week", "avg_rank_week")


@query
def affected_months(f: Feed) -> DataFrame:
    months = rollup.touched_periods(f.monthly, recent_day(f), ["year", "month"], "month_end_date")
    return rounded(months, 6, "avg_volatility_month", "avg_rank_month")


@query
def weekly_avg(f: Feed) -> DataFrame:
    return rounded(rollup.period_averages(f.daily, ["year", "week_of_year"]), 6, "avg_price", "avg_daily_volume")


@query
def monthly_avg(f: Feed) -> DataFrame:
    return rounded(rollup.period_averages(f.daily, ["year", "month"]), 6, "avg_price", "avg_daily_volume")


def order_days(f: Feed) -> DataFrame:
    return rollup.daily_metrics(tt.order_ticks(f.spark, f.folder), order="o_orderkey")


@query
def orders_weekly(f: Feed) -> DataFrame:
    return rounded(rollup.weekly_metrics(order_days(f)), 6, "avg_volatility_week", "avg_rank_week")


@query
def orders_weekly_iso(f: Feed) -> DataFrame:
    return rounded(rollup.weekly_metrics(order_days(f), iso_year=True), 6, "avg_volatility_week", "avg_rank_week")


@query
def orders_monthly(f: Feed) -> DataFrame:
    return rounded(rollup.monthly_metrics(order_days(f)), 6, "avg_volatility_month", "avg_rank_month")


# --- newest period, snapshot, history ---------------------------------------------------------

@query
def latest_daily(f: Feed) -> DataFrame:
    return serving.daily_report(f.daily)


@query
def latest_weekly(f: Feed) -> DataFrame:
    return serving.weekly_report(f.weekly)


@query
def latest_monthly(f: Feed) -> DataFrame:
    return serving.monthly_report(f.monthly)


@query
def latest_snapshot(f: Feed) -> DataFrame:
    return f.latest


@query
def history_table(f: Feed) -> DataFrame:
    return f.history


@query
def latest_page(f: Feed) -> DataFrame:
    return serving.latest_page(f.latest, limit=5, offset=5)


@query
def coin_detail(f: Feed) -> DataFrame:
    return serving.coin_detail(f.latest, "c3")


# --- alerts -----------------------------------------------------------------------------------

@query
def price_alerts(f: Feed) -> DataFrame:
    return alerts.price_alerts(f.live).select(
        "coin_id", "crawl_ts", "alert_type", "current_price", "price_change_percentage_1h",
        "price_change_percentage_24h")


@query
def valid_alerts(f: Feed) -> DataFrame:
    v = F.col("total_volume")
    messages = f.messages.withColumns({
        "coin_id": F.when(v % 10 == 0, F.lit("")).otherwise(F.col("coin_id")),
        "alert_type": F.when(v % 7 != 0, F.col("alert_type"))})
    return alerts.valid_alerts(messages).select("coin_id", "alert_type", "alert_time", "total_volume")


@query
def recent_alerts(f: Feed) -> DataFrame:
    return alerts.recent_alerts(f.alert_store, kind="pump_24h", level="low", limit=50)


@query
def alerts_total(f: Feed) -> DataFrame:
    return alerts.alerts_total(f.alert_store, f.as_of)


@query
def alerts_by_type(f: Feed) -> DataFrame:
    return alerts.alerts_by(f.alert_store, "alert_type", f.as_of, size=20)


@query
def sketch_top_symbols(f: Feed) -> DataFrame:
    """The range's most alerted symbols from daily sketches."""
    sketches = topk.daily_sketches(f.alert_store, "symbol", "detected_at")
    recent = sketches.where(F.col("day") >= F.date_sub(F.to_date(f.as_of), 7))
    return topk.most_frequent(recent, 10).select(F.col("item").alias("symbol"), F.col("count").alias("alerts"))


@query
def alerts_by_severity(f: Feed) -> DataFrame:
    return alerts.alerts_by(f.alert_store, "severity", f.as_of, size=10)


@query
def recent_alerts_all(f: Feed) -> DataFrame:
    """A list longer than a page: no hidden cap."""
    return alerts.recent_alerts(f.alert_store, limit=1000)


@query
def alerts_by_day(f: Feed) -> DataFrame:
    return alerts.alerts_by_day(f.alert_store, f.as_of, days=30)


@query
def alerts_by_day_gaps(f: Feed) -> DataFrame:
    """Rare alerts only, so that days without one occur."""
    rare = f.alert_store.where("alert_type = 'WHALE_ALERT' AND severity = 'HIGH'")
    return alerts.alerts_by_day(rare, f.as_of, days=30)


@query
def volume_spikes(f: Feed) -> DataFrame:
    return alerts.volume_spikes(f.alert_store)


@query
def alert_counts(f: Feed) -> DataFrame:
    return alerts.alert_counts(f.alert_store)


@query
def alerts_recent_by_coin(f: Feed) -> DataFrame:
    return alerts.alerts_recent_by_coin(f.alert_store, f.as_of)


@query
def whale_detection(f: Feed) -> DataFrame:
    return rounded(alerts.whale_detection(f.daily), 6, "normal_volume", "volume_spike_pct")


@query
def stream_whale_days(f: Feed) -> DataFrame:
    """The whole feed through the stream that keeps each coin's last week as state; days still open have no row."""
    found = replay.replayed(stages.whale_day_stream(f.streamed), "whale-days")
    return rounded(found, 6, "normal_volume", "volume_spike_pct")


@query
def stream_unique(f: Feed) -> DataFrame:
    """Ticks per coin and day after the whole feed came twice."""
    keys = ["coin_id", "crawl_ts"]
    unique = replay.replayed(stages.unique_ticks(f.streamed.union(f.streamed), "60 days").select(*keys), "unique")
    return unique.groupBy("coin_id", F.to_date("crawl_ts").alias("date")).agg(F.count("*").alias("ticks"))


@query
def pump_dump_batch(f: Feed) -> DataFrame:
    return rounded(alerts.pump_dump(f.daily), 6, "volume_change_pct")


@query
def pump_dump_list(f: Feed) -> DataFrame:
    return rounded(alerts.pump_dump_list(alerts.pump_dump(f.daily), kind="pump"), 6, "volume_change_pct")


# --- sentiment --------------------------------------------------------------------------------

@query
def sentiment_1m(f: Feed) -> DataFrame:
    return rounded(sentiment.sentiment_1m(f.live), 6, "avg_change_24h")


@query
def latest_prices_1m(f: Feed) -> DataFrame:
    return sentiment.latest_prices_1m(f.live)


@query
def sentiment_daily(f: Feed) -> DataFrame:
    return rounded(sentiment.sentiment_daily(f.daily), 6, "avg_return_pct")


# --- market -----------------------------------------------------------------------------------

@query
def market_summary(f: Feed) -> DataFrame:
    return market.market_summary(f.latest)


@query
def cap_distribution(f: Feed) -> DataFrame:
    return market.cap_distribution(f.latest, TIER_BOUNDS)


@query
def cap_distribution_daily(f: Feed) -> DataFrame:
    return market.cap_distribution_daily(f.daily, TIER_BOUNDS)


@query
def dominance(f: Feed) -> DataFrame:
    return market.dominance(f.daily, {"base": BASE, "second": SECOND})


@query
def market_daily(f: Feed) -> DataFrame:
    return rounded(market.market_daily(f.daily, BASE), 6, "avg_change")


@query
def hourly_volume(f: Feed) -> DataFrame:
    return market.hourly_volume(f.clean)


@query
def base_correlation(f: Feed) -> DataFrame:
    return rounded(market.base_correlation(f.daily, BASE), 6, "correlation")


@query
def volume_price_corr(f: Feed) -> DataFrame:
    return rounded(market.volume_price_corr(f.daily), 6, "correlation")


@query
def rank_changes(f: Feed) -> DataFrame:
    return market.rank_changes(f.daily)


@query
def top_movers(f: Feed) -> DataFrame:
    """The test feed spans 30 days, so the long timeframe is taken over 20."""
    return market.top_movers(f.clean, long_days=20)


@query
def orders_movers(f: Feed) -> DataFrame:
    """The same over 30 days, on the feed of seven years."""
    return market.top_movers(tt.order_moves(f.spark, f.folder))


@query
def top_coin_trends(f: Feed) -> DataFrame:
    return rounded(market.top_coin_trends(f.history, f.as_of), 6, "avg_price")


@query
def price_heatmap(f: Feed) -> DataFrame:
    return rounded(market.price_heatmap(f.daily), 6, "return_pct")


@query
def performance_compare(f: Feed) -> DataFrame:
    return market.performance_compare(f.daily)


@query
def most_volatile(f: Feed) -> DataFrame:
    return market.most_volatile(f.daily, F.date_sub(F.to_date(f.as_of), 1))


# --- serving ----------------------------------------------------------------------------------

@query
def price_history(f: Feed) -> DataFrame:
    return serving.price_history(f.history, "c0", f.as_of)


@query
def price_trend(f: Feed) -> DataFrame:
    return rounded(serving.price_trend(f.history, "c0", f.as_of), 6, "avg_price")


@query
def price_trend_long(f: Feed) -> DataFrame:
    """A trend over more than a thousand days of the orders feed."""
    history = serving.history_table(order_days(f))
    newest = f.table("orders").agg(F.max("o_orderdate")).scalar()
    return rounded(serving.price_trend(history, "1-urgent", newest, days=4000), 6, "avg_price")


@query
def history_interval(f: Feed) -> DataFrame:
    hourly = serving.history_interval(f.clean, BASE, f.as_of, days=7, interval="hourly")
    daily = serving.history_interval(f.clean, BASE, f.as_of, days=7, interval="daily")
    both = hourly.withColumn("interval", F.lit("hourly")).unionByName(daily.withColumn("interval", F.lit("daily")))
    return ntz(both, "timestamp")


@query
def top_gainers(f: Feed) -> DataFrame:
    return serving.top_gainers(f.latest)


@query
def top_losers(f: Feed) -> DataFrame:
    return serving.top_losers(f.latest)


@query
def cap_ranking(f: Feed) -> DataFrame:
    return serving.cap_ranking(f.latest)


@query
def filter_coins(f: Feed) -> DataFrame:
    return serving.filter_coins(f.latest, min_market_cap=1_000_000, min_price=1, max_price=200, max_change=0)


@query
def search_coin(f: Feed) -> DataFrame:
    """Fuzzy search over the part names; the brand plays the symbol."""
    found = serving.search_coin(f.table("part"), "gizmp", limit=20, name="p_name", symbol="p_brand",
                                size="p_retailprice", key="p_partkey")
    return found.select("p_partkey", "p_name", "p_brand", "distance")


@query
def fuzzy_keywords(f: Feed) -> DataFrame:
    """Every part's first word, misspelt at some letter, against the words of all parts, and how many parts say them."""
    parts = f.table("part").withColumn("w", F.lower(F.element_at(F.split("p_name", " "), 1)))
    at = (F.col("p_partkey") % F.length("w")).cast("int") + 1
    typed = F.concat(F.substring("w", F.lit(1), at - 1), F.when(F.col("p_partkey") % 2 == 0, "q").otherwise(""),
                     F.substring("w", at + 1, F.length("w")))
    return fuzzy.fuzzy_counts(parts, parts.select(typed.alias("keyword")), "p_partkey", "p_name", "parts")


@query
def rolling_range(f: Feed) -> DataFrame:
    return panels.rolling_range(f.daily, f.as_of, days=7).select("coin_id", "date", "close_price")


@query
def kql_filters(f: Feed) -> DataFrame:
    kept = panels.metric_filter(
        f.daily, cap_above=100_000, volume_above=200_000, volatility_above=15,
        cap_between=(1_000_000, 500_000_000), symbols=["C0", "C1", "C2", "C3", "C4", "C5", "C6"], without=["C2"])
    return kept.select("symbol", "date", "market_cap_close", "volume_sum_day", "volatility_day", "return_pct_day")


KQL_CASES = {
    "cap_above": {"cap_above": 5_000_000}, "volume_above": {"volume_above": 500_000}, "volatility_above": {"volatility_above": 1000},
    "return_above": {"return_above": 10}, "return_below": {"return_below": -10}, "cap_between": {"cap_between": (1_000_000, 50_000_000)},
    "symbols": {"symbols": ["C0", "C3"]}, "without": {"without": ["C0", "C1"]},
}


@query
def kql_filter_cases(f: Feed) -> DataFrame:
    """Each saved filter by itself, over one pass: a row is listed under every filter that keeps it."""
    kept = [F.when(panels.metric_condition(**case), F.lit(name)) for name, case in KQL_CASES.items()]
    return (f.daily.withColumn("filter", F.explode(F.filter(F.array(*kept), lambda k: k.isNotNull())))
            .select("filter", "symbol", "date", "market_cap_close", "volume_sum_day", "volatility_day", "return_pct_day"))


@query
def kql_alert_filters(f: Feed) -> DataFrame:
    return alerts.select_alerts(f.alert_store, ["PUMP_1H", "DUMP_24H"], ["C1", "C5"])


@query
def movers_table(f: Feed) -> DataFrame:
    return serving.movers_table(f.daily.where(F.col("date") == F.date_sub(F.to_date(f.as_of), 1)), show="losers")


@query
def movers_gainers(f: Feed) -> DataFrame:
    return serving.movers_table(f.daily.where(F.col("date") == F.date_sub(F.to_date(f.as_of), 1)), show="gainers")


@query
def summary_cards(f: Feed) -> DataFrame:
    """A row of cards for every week, which is a year and a number."""
    return serving.summary_cards(f.weekly, "weekly", ["year", "week_of_year"])


@query
def summary_cards_daily(f: Feed) -> DataFrame:
    """Cards over all daily rows."""
    return serving.summary_cards(f.daily, "daily")


@query
def chart_top_volume(f: Feed) -> DataFrame:
    return serving.chart_top_volume(f.monthly, "monthly")


# --- panels -----------------------------------------------------------------------------------

PANEL_SYMBOLS = ["C0", "C1", "C2", "C3", "C4"]


@query
def panel_price_trend(f: Feed) -> DataFrame:
    return rounded(panels.panel_price_trend(f.daily, PANEL_SYMBOLS, f.as_of, days=20), 6, "avg_close")


@query
def panel_volume_heatmap(f: Feed) -> DataFrame:
    return panels.panel_volume_heatmap(f.daily, f.as_of, days=20)


@query
def panel_weekly_perf(f: Feed) -> DataFrame:
    return rounded(panels.panel_weekly_perf(f.weekly, f.as_of, days=14), 6, "avg_return")


@query
def panel_monthly_trend(f: Feed) -> DataFrame:
    return rounded(panels.panel_monthly_trend(f.monthly, PANEL_SYMBOLS, f.as_of), 6, "avg_close")


@query
def panel_alert_types(f: Feed) -> DataFrame:
    return panels.panel_alert_types(f.messages)


@query
def panel_alert_coins(f: Feed) -> DataFrame:
    return panels.panel_alert_coins(f.messages)


@query
def panel_sentiment_series(f: Feed) -> DataFrame:
    series = panels.panel_sentiment_series(sentiment.sentiment_1m(f.live), "hour")
    return ntz(rounded(series, 6, "bullish_pct", "bearish_pct"), "time")


@query
def panel_sentiment_now(f: Feed) -> DataFrame:
    """The filter on the newest minute reaches the scan, so no history is aggregated."""
    newest = f.live.where(F.col("crawl_ts") >= F.date_trunc("minute", f.as_of).cast("timestamp_ntz"))
    return rounded(panels.panel_sentiment_now(sentiment.sentiment_1m(newest)), 6, "avg_change_24h")


# --- export and merge -------------------------------------------------------------------------

@query
def export_daily(f: Feed) -> DataFrame:
    return export.documents(f.daily, "daily_metrics")


@query
def export_weekly(f: Feed) -> DataFrame:
    return rounded(export.documents(f.weekly, "weekly_metrics"), 6, "avg_volatility_week", "avg_rank_week")


@query
def export_monthly(f: Feed) -> DataFrame:
    return rounded(export.documents(f.monthly, "monthly_metrics"), 6, "avg_volatility_month", "avg_rank_month")


@query
def export_relational(f: Feed) -> DataFrame:
    return export.relational_rows(f.daily, "daily_metrics")


@query
def realtime_doc_id(f: Feed) -> DataFrame:
    turn, text = F.col("market_cap_rank") % 3, F.date_format("crawl_ts", "yyyy-MM-dd HH:mm:ss")
    docs = f.ticks.select(
        "last_updated", F.when(F.col("total_volume") % 5 != 0, F.col("coin_id")).alias("coin_id"),
        F.when(turn == 0, text).alias("window_start"), F.when(turn == 1, text).alias("alert_time"),
        F.when(F.col("total_volume") % 2 == 0, text).alias("crawl_time"))
    return docs.select("last_updated", merge.realtime_doc_id().alias("doc_id"))


def live_daily(f: Feed) -> DataFrame:
    return rollup.daily_metrics(clean.clean_ticks(f.live))


@query
def upsert_by_id(f: Feed) -> DataFrame:
    def docs(daily: DataFrame, version: int) -> DataFrame:
        return export.documents(daily, "daily_metrics").select(
            "doc_id", "close_price", "volume_sum_day", F.lit(version).alias("version"))

    # The bare time column is compared, so that row groups of older ticks can be skipped.
    since = F.date_sub(F.to_date(f.as_of), 3).cast("timestamp_ntz")
    recent = rollup.daily_metrics(clean.clean_ticks(f.live.where(F.col("crawl_ts") >= since)))
    return merge.upsert_by_id(docs(f.daily, 0), docs(recent, 1))


@query
def lambda_merge(f: Feed) -> DataFrame:
    columns = ["coin_id", "date", "close_price", "record_count"]
    batch = f.daily.where(F.col("date") < F.date_sub(F.to_date(f.as_of), 3)).select(*columns)
    return merge.lambda_merge(batch, live_daily(f).select(*columns))


@query
def forward_fill(f: Feed) -> DataFrame:
    gappy = f.live.select("coin_id", "crawl_ts",
                          F.when(F.col("total_volume") % 3 != 0, F.col("current_price")).alias("current_price"))
    return merge.forward_fill(gappy, "current_price")


@query
def retention_filter(f: Feed) -> DataFrame:
    return merge.retain(f.clean, f.as_of, 7).select("coin_id", "crawl_ts", "date", "current_price")


@query
def unprocessed_dates(f: Feed) -> DataFrame:
    """The ledger holds every day up to a week before the newest tick."""
    arrived = f.ticks.select(F.to_date("crawl_ts").alias("date")).distinct()
    return merge.unprocessed_dates(f.clean, arrived.where(F.col("date") < F.date_sub(F.to_date(f.as_of), 7)))
