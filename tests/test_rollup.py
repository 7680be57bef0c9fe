import datetime as dt

from frames import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickmart.operators import clean, rollup
from tickmart.sources import tick_tables as tt


def daily_of(ticks):
    return rollup.daily_metrics(clean.clean_ticks(ticks))


def test_open_and_close_follow_time_not_file_order(tick_frame):
    df = tick_frame([("a", "2024-01-01T12:00:00", 5.0, 7), ("a", "2024-01-01T01:00:00", 2.0, 9),
                     ("a", "2024-01-01T06:00:00", 9.0, 8)])
    got = daily_of(df).first()
    assert (got.open_price, got.close_price, got.high_price, got.low_price) == (2.0, 5.0, 9.0, 2.0)
    assert got.volume_sum_day == 7 and got.record_count == 3
    assert got.return_pct_day == 150.0 and got.volatility_day == 350.0 and got.price_range_day == 7.0


def test_null_prices_do_not_open_or_close(spark):
    df = spark.createDataFrame(
        [("a", "A", "A", dt.date(2024, 1, 1), 1, None, 1, 1, 1), ("a", "A", "A", dt.date(2024, 1, 1), 2, 3.0, 1, 1, 1),
         ("a", "A", "A", dt.date(2024, 1, 1), 3, None, 1, 1, None)],
        "coin_id string, symbol string, name string, date date, crawl_ts int, current_price double, "
        "total_volume long, market_cap long, market_cap_rank int")
    got = rollup.daily_ohlc(df).first()
    assert (got.open_price, got.close_price, got.market_cap_rank_close) == (3.0, 3.0, 1)


def test_zero_open_gives_null_ratios(spark):
    df = spark.createDataFrame([(0.0, 1.0, 1.0, 0.0)], "open_price double, close_price double, high_price double, low_price double")
    got = rollup.with_ratios(df, "day").first()
    assert got.return_pct_day is None and got.volatility_day is None


def test_price_ranks_break_ties_by_id(tick_frame):
    df = tick_frame([(c, "2024-01-01T00:00:00", p, 1) for c, p in (("b", 2.0), ("a", 2.0), ("c", 3.0))])
    assert rows(daily_of(df), "coin_id", "rank_open", "rank_change") == [("a", 2, 0), ("b", 3, 0), ("c", 1, 0)]


def test_new_year_week(tick_frame):
    """29 December 2025 belongs to ISO week 1 of 2026."""
    daily = daily_of(tick_frame([("a", "2025-01-02T00:00:00", 1.0, 1), ("a", "2025-12-29T00:00:00", 2.0, 1),
                                 ("a", "2026-01-01T00:00:00", 3.0, 1)]))
    assert rows(rollup.weekly_metrics(daily), "year", "week_of_year", "days_in_week") == [(2025, 1, 2), (2026, 1, 1)]
    assert rows(rollup.weekly_metrics(daily, iso_year=True), "year", "week_of_year", "days_in_week") == \
        [(2025, 1, 1), (2026, 1, 2)]


def test_rename_splits_the_period(tick_frame):
    df = tick_frame([("a", "2024-01-01T00:00:00", 1.0, 1), ("a", "2024-01-01T01:00:00", 1.0, 1)])
    renamed = df.withColumn("name", F.when(F.col("crawl_time") > "2024-01-01T00:30", "New").otherwise(F.col("name")))
    assert daily_of(renamed).count() == 2


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 71), st.floats(0.01, 1e6)), min_size=1, max_size=40))
def test_price_bounds_and_counts(tick_frame, data):
    start = dt.datetime(2024, 1, 30)
    df = tick_frame([(c, (start + dt.timedelta(hours=h)).isoformat(), p, 1) for c, h, p in data])
    ticks = clean.clean_ticks(df)
    daily = rollup.daily_metrics(ticks)
    bad = daily.where("low_price > least(open_price, close_price) OR high_price < greatest(open_price, close_price)")
    assert bad.isEmpty()
    assert daily.agg(F.sum("record_count")).first()[0] == ticks.count()
    assert rollup.monthly_metrics(daily).agg(F.sum("days_in_month")).first()[0] == daily.count()


def test_hierarchy_equals_direct_rollup(spark, small):
    """Open and close of a month from daily rows equal those from the ticks themselves."""
    ticks = clean.clean_ticks(tt.ticks(spark, small))
    monthly = rollup.monthly_metrics(rollup.daily_metrics(ticks)).select("coin_id", "open_price_month", "close_price_month")
    direct = ticks.groupBy("coin_id").agg(F.min_by("current_price", "crawl_ts"), F.max_by("current_price", "crawl_ts"))
    assert rows(monthly) == rows(direct)
