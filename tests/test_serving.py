import datetime as dt

import pytest
from frames import rows
from pyspark.sql import functions as F

from tickmart.functions import timeframes
from tickmart.functions.classify import cap_tier, gauge_band, majority, sentiment, severity, traffic_light
from tickmart.functions.formats import human_number
from tickmart.functions.matching import allowed_edits
from tickmart.operators import alerts, clean, export, market, merge, panels, rollup, serving
from tickmart.plans.catalog import Feed
from tickmart.sources import payload

D = dt.date


@pytest.fixture
def coins(spark):
    data = [("BTC", "Bitcoin", 100.0, 50, 10, 1.0, 1), ("ETH", "Ethereum", 10.0, 40, 20, -2.0, 2),
            ("BCH", "Bitcoin Cash", 5.0, 10, 5, 0.0, 3), ("XXX", "Nameless", 1.0, 5, 1, None, 4)]
    return spark.createDataFrame(data, "symbol string, name string, price_usd double, market_cap long, "
                                       "volume_24h long, percent_change_24h double, rank int")


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize("n,text", [(1.5e12, "$1.50T"), (1e9, "$1.00B"), (2_345_678, "$2.35M"), (999.994, "$999.99"),
                                    (1000, "$1.00K"), (0, "$0.00")])
def test_human_number(spark, n, text):
    assert value(spark, human_number(F.lit(n))) == text


def test_human_number_rounds_the_binary_value(spark):
    """998.505 and 999.045 lie below the half as doubles, 999.985 above it; a true half goes to the even digit."""
    numbers = [998_505, 999_045, 999_985, 999_995, 1_000_125, 1_000_375, 1_005_000, 1_015_000, *range(1_005, 1_000_000, 970)]
    df = spark.createDataFrame([(n,) for n in numbers], "n bigint")
    got = {r.n: r.t for r in df.select("n", human_number(F.col("n"), "", "BMK").alias("t")).collect()}
    assert got == {n: "%.2fM" % (n / 1e6) if n >= 1e6 else "%.2fK" % (n / 1e3) for n in numbers}
    assert value(spark, human_number(F.lit(-0.125))) == "$-0.12" and value(spark, human_number(F.lit(1.005))) == "$1.00"


def test_short_number_has_no_trillions(spark):
    assert value(spark, human_number(F.lit(2e12), "", "BMK")) == "2000.00B"


@pytest.mark.parametrize("change,label", [(9.99, "MINOR"), (-10.0, "LOW"), (20.0, "MEDIUM"), (50.0, "MEDIUM"),
                                          (50.01, "HIGH"), (None, None)])
def test_severity(spark, change, label):
    assert value(spark, severity(F.lit(change).cast("double"))) == label


def test_labels(spark):
    lit = F.lit
    assert value(spark, sentiment(lit(60.0), lit(40.0))) == "NEUTRAL"
    assert value(spark, sentiment(lit(60.01), lit(39.99))) == "BULLISH"
    assert value(spark, sentiment(lit(30.0), lit(61.0))) == "BEARISH"
    assert value(spark, majority(lit(3), lit(3))) == "BEARISH"
    assert [value(spark, gauge_band(lit(x))) for x in (29.9, 30.0, 45.0, 55.0, 70.0)] == \
        ["Strong Bearish", "Bearish", "Neutral", "Bullish", "Strong Bullish"]
    assert [value(spark, traffic_light(lit(x))) for x in (39.9, 40.0, 60.0, 60.1)] == ["Red", "Yellow", "Yellow", "Green"]
    assert [value(spark, cap_tier(lit(x))) for x in (10**10, 10**9, 10**9 - 1)] == ["large_cap", "mid_cap", "small_cap"]


def test_timeframe_columns():
    assert timeframes.columns("daily")["open"] == "open_price"
    assert timeframes.columns("weekly") == {
        "return": "return_pct_week", "volatility": "volatility_week", "volume": "volume_sum_week",
        "open": "open_price_week", "close": "close_price_week", "high": "high_price_week", "low": "low_price_week"}
    with pytest.raises(ValueError):
        timeframes.columns("hourly")


def test_market_summary(coins):
    got = market.market_summary(coins).first()
    assert (got.total_market_cap, got.coin_count, got.gainers_count, got.losers_count) == (105, 4, 1, 1)
    assert got.market_sentiment == "BEARISH" and got.avg_change_24h == -0.33


def test_tiers_keep_empty_ones_and_add_up(coins):
    got = {r.tier: (r.coins, r.total_market_cap) for r in market.cap_distribution(coins, (20, 1000)).collect()}
    assert got == {"large_cap": (0, 0), "mid_cap": (2, 90), "small_cap": (2, 15)}


def test_zero_is_a_bound(coins):
    assert rows(serving.filter_coins(coins, max_change=0), "symbol") == [("BCH",), ("ETH",)]
    assert serving.filter_coins(coins, min_price=0).count() == 4


@pytest.mark.parametrize("word,expected", [
    ("bitcoin", ["BTC", "BCH"]), ("btc", ["BTC"]), ("bitcoon", ["BTC", "BCH"]), ("ether", ["ETH"]),
    ("cash", ["BCH"]), ("bxtcxxn", []), ("xx", ["XXX"])])
def test_search(coins, word, expected):
    assert [r.symbol for r in serving.search_coin(coins, word).collect()] == expected


def test_edit_tolerance():
    assert [allowed_edits(w) for w in ("ab", "abc", "abcde", "abcdef")] == [0, 1, 1, 2]


def test_lists(coins):
    assert [r.symbol for r in serving.top_gainers(coins).collect()] == ["BTC"]
    assert [r.symbol for r in serving.top_losers(coins).collect()] == ["ETH"]
    assert [(r.symbol, r.current_rank) for r in serving.cap_ranking(coins, 2).collect()] == [("BTC", 1), ("ETH", 2)]
    assert [r.symbol for r in serving.latest_page(coins, 2, 1).collect()] == ["ETH", "BCH"]
    assert serving.coin_detail(coins, "eth").first().name == "Ethereum"
    assert serving.coin_detail(coins, "none").isEmpty()


def history(spark, *prices, start=D(2024, 1, 1)):
    data = [("A", "Aa", start + dt.timedelta(days=i), p, 1) for i, p in enumerate(prices)]
    return spark.createDataFrame(data, "symbol string, name string, date date, price_usd double, market_cap long")


def test_trend(spark):
    got = serving.price_trend(history(spark, 5.0, 10.0, 0.0), "a", D(2024, 1, 3)).first()
    assert (got.first_price, got.last_price, got.min_price, got.trend, got.price_change_percent) == (5.0, 1.0, 0.0, "DOWN", -80.0)
    short = serving.price_trend(history(spark, 5.0), "a", D(2024, 1, 1)).first()
    assert short.error == "not enough data" and short.first_price is None
    assert serving.price_trend(history(spark, 5.0), "zzz", D(2024, 1, 1)).first().symbol == "ZZZ"


def test_history_range_includes_the_first_day(spark):
    h = history(spark, *map(float, range(10)))
    assert [r.price_usd for r in serving.price_history(h, "a", D(2024, 1, 10), days=2).collect()] == [7.0, 8.0, 9.0]


def test_reports(spark, small):
    feed = Feed(spark, small)
    daily = feed.daily
    newest = daily.agg(F.max("date")).first()[0]
    report = serving.daily_report(daily).collect()
    assert {r.date for r in report} == {newest}
    assert len(report) == daily.where(F.col("date") == newest).count()
    returns = [r.return_pct_day for r in report]
    assert returns == sorted(returns, reverse=True)
    assert {r.date for r in serving.daily_report(daily, date=D(2024, 1, 5)).collect()} == {D(2024, 1, 5)}
    weekly = rollup.weekly_metrics(daily)
    assert {(r.year, r.week_of_year) for r in serving.weekly_report(weekly).collect()} == {(2024, 5)}
    assert {r.week_of_year for r in serving.weekly_report(weekly, week=2).collect()} == {2}
    assert serving.weekly_report(weekly, year=2023).isEmpty()
    assert serving.monthly_report(rollup.monthly_metrics(daily), limit=3, month=1).count() == 3


def test_newest_report_with_more_rows_than_the_limit(spark, small):
    daily = Feed(spark, small).daily
    top = serving.daily_report(daily, limit=2).collect()
    assert [r.coin_id for r in top] == [r.coin_id for r in serving.daily_report(daily).collect()[:2]]


def test_performance_equals_the_joined_tables(spark, small):
    daily = Feed(spark, small).daily
    weekly, monthly = rollup.weekly_metrics(daily), rollup.monthly_metrics(daily)
    newest = daily.groupBy("coin_id").agg(F.max("date").alias("date"))
    want = (daily.join(newest, ["coin_id", "date"]).join(weekly, ["coin_id", "year", "week_of_year"])
            .join(monthly, ["coin_id", "year", "month"]))
    columns = ["coin_id", "return_pct_day", "return_pct_week", "return_pct_month"]
    assert rows(market.performance_compare(daily), *columns) == rows(want, *columns)


def test_overview_page(spark, small):
    feed = Feed(spark, small)
    page = market.overview(feed.latest, feed.history, feed.alert_store, feed.as_of, symbols=("C0", "C1"))
    counts = {name: df.count() for name, df in page.items()}
    assert counts["market_summary"] == counts["trend_c0"] == counts["trend_c1"] == 1
    assert counts["cap_distribution"] == 3 and counts["top_gainers"] > 0
    total = page["alerts_total"].first().total_count
    assert total == page["alerts_by_day"].agg(F.sum("alerts")).first()[0]
    assert total == page["alerts_by_type"].agg(F.sum("alerts")).first()[0]


def alert_rows(spark, *days):
    data = [("A", "Aa", "PUMP_1H", "LOW", 5.0, 1.0, dt.datetime(2024, 1, d, 5)) for d in days]
    return spark.createDataFrame(data, "symbol string, name string, alert_type string, severity string, "
                                       "price_change_percent double, current_price double, detected_at timestamp_ntz")


def test_empty_days_are_filled(spark):
    got = alerts.alerts_by_day(alert_rows(spark, 1, 2, 2, 6), D(2024, 1, 7), days=30)
    assert [(d.day, n) for d, n in rows(got)] == [(1, 1), (2, 2), (3, 0), (4, 0), (5, 0), (6, 1)]
    assert alerts.alerts_by_day(alert_rows(spark, 1), D(2024, 1, 30), days=3).isEmpty()


def test_alert_lists(spark):
    df = alert_rows(spark, *range(1, 29)).unionByName(
        alert_rows(spark, 3).withColumn("alert_type", F.lit("big_volume_move")))
    assert alerts.recent_alerts(df, limit=5).count() == 5
    assert alerts.recent_alerts(df, kind="pump_1h", level="low", limit=1000).count() == 28
    assert alerts.recent_alerts(df, level="high").isEmpty()
    assert alerts.volume_spikes(df).count() == 1


def test_baseline_uses_calendar_days(spark):
    data = [("a", "A", "Aa", D(2024, 1, d), v, 20.0, 1.0) for d, v in ((1, 100), (2, 300), (9, 600), (20, 50))]
    daily = spark.createDataFrame(data, "coin_id string, symbol string, name string, date date, volume_sum_day long, "
                                        "return_pct_day double, close_price double")
    base = {r.date.day: r.normal_volume for r in alerts.with_volume_baseline(daily).collect()}
    assert base == {1: None, 2: 100.0, 9: 300.0, 20: None}
    assert [r.date.day for r in alerts.whale_detection(daily).collect()] == [2]
    hit = alerts.pump_dump(daily).first()
    assert (hit.type, hit.severity, hit.volume_change_pct) == ("PUMP", "MEDIUM", 300.0)


def test_forward_fill_equals_one_window(spark, small):
    gappy = Feed(spark, small).live.select(
        "coin_id", "crawl_ts", F.when(F.col("total_volume") % 5 == 0, F.col("current_price")).alias("p"))
    from pyspark.sql import Window
    whole = Window.partitionBy("coin_id").orderBy("crawl_ts").rowsBetween(Window.unboundedPreceding, 0)
    want = gappy.withColumn("p", F.last("p", True).over(whole))
    for chunk in ("minute", "hour", "day", "month"):
        assert rows(merge.forward_fill(gappy, "p", chunk=chunk)) == rows(want)


def test_lambda_merge_keeps_every_batch_row(spark):
    batch = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("b", 1, "z")], "coin_id string, date int, v string")
    live = spark.createDataFrame([("a", 1, "no"), ("a", 2, "yes"), ("c", 1, "yes")], batch.schema)
    assert rows(merge.lambda_merge(batch, live), "coin_id", "date", "v", "layer") == [
        ("a", 1, "x", "batch"), ("a", 1, "y", "batch"), ("a", 2, "yes", "realtime"), ("b", 1, "z", "batch"),
        ("c", 1, "yes", "realtime")]


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([("a", 1, 0), ("b", 1, 0)], "doc_id string, v int, version int")
    new = spark.createDataFrame([("b", 2, 1), ("c", 2, 1)], old.schema)
    once = merge.upsert_by_id(old, new)
    assert rows(once) == rows(merge.upsert_by_id(once, new)) == [("a", 1, 0), ("b", 2, 1), ("c", 2, 1)]


def test_week_ids(spark, small):
    weekly = rollup.weekly_metrics(Feed(spark, small).daily)
    ids = {r.doc_id for r in export.documents(weekly, "weekly_metrics").collect()}
    legacy = {r.doc_id for r in export.documents(weekly, "weekly_metrics", legacy_week_id=True).collect()}
    assert "coin-0_2024_1" in ids and "coin-0_1" in legacy


def test_payload_with_missing_and_odd_fields(spark):
    body = ('[{"id": "btc", "symbol": "btc", "current_price": 1, "market_cap": 2.5, "max_supply": null,'
            ' "price_change_percentage_7d_in_currency": -1.5, "image": "u"}, {"id": "x"}]')
    got = payload.normalize_payload(spark.createDataFrame([(body,), ("oops",)], "b string"), "b", F.lit("t"))
    typed = clean.coerce_measures(got)
    assert rows(typed, "coin_id", "symbol", "current_price", "market_cap", "price_change_percentage_7d", "image_url") == \
        [("btc", "BTC", 1.0, 2, -1.5, "u"), ("x", "", None, None, None, None)]
    assert got.first().source == "coingecko"


def test_heatmap_pivot(spark, small):
    daily = Feed(spark, small).daily
    days = [D(2024, 1, 2), D(2024, 1, 3)]
    wide = market.price_heatmap(daily, days)
    assert wide.columns == ["symbol", "2024-01-02", "2024-01-03"]
    back = wide.selectExpr("symbol", "stack(2, '2024-01-02', `2024-01-02`, '2024-01-03', `2024-01-03`) AS (date, r)")
    long = market.price_heatmap(daily).where(F.col("date").isin(days))
    assert rows(back.where("r IS NOT NULL")) == rows(long.select("symbol", F.col("date").cast("string"), "return_pct"))


def test_filters(spark, small):
    daily = Feed(spark, small).daily
    assert panels.metric_filter(daily).count() == daily.count()
    up, down = panels.metric_filter(daily, return_above=0), panels.metric_filter(daily, return_below=0)
    flat = daily.where("return_pct_day = 0").count()
    assert up.count() + down.count() + flat == daily.count()
    assert panels.metric_filter(daily, without=panels.STABLECOINS).count() == daily.count()
