"""Shape of the physical plans that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

from tickmart.operators import clean, rollup
from tickmart.plans.catalog import QUERIES, Feed


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text: str) -> int:
    return len(re.findall(r"(?<!Broadcast)Exchange (hash|range|Single|Round)", text))


@pytest.fixture
def feed(spark, small):
    return Feed(spark, small)


def test_dedup_collapses_copies_before_the_shuffle(feed):
    text = plan(clean.dedup_latest(feed.ticks))
    assert "partial_max(struct(" in text and exchanges(text) == 1
    assert "Window" not in text


def test_ohlc_is_a_hash_aggregate_with_map_side_step(feed):
    text = plan(rollup.daily_ohlc(feed.clean))
    assert "partial_min_by" in text and "partial_max_by" in text
    assert text.count("SortAggregate") == 2  # deduplication only


def test_ranks_share_one_shuffle(feed):
    assert exchanges(plan(feed.daily)) == 3  # dedup, coin-day, date


def test_weekly_drops_the_unused_rank(feed):
    text = plan(rollup.weekly_metrics(feed.daily).select("coin_id", "open_price_week"))
    assert "row_number" not in text


@pytest.mark.parametrize("name", ["top_gainers", "recent_alerts", "latest_daily", "cap_ranking", "movers_table",
                                  "panel_volume_heatmap", "panel_alert_coins", "search_coin"])
def test_top_k_does_not_sort_everything(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    assert "TakeOrderedAndProject" in text
    assert "rangepartitioning" not in text


@pytest.mark.parametrize("name", ["latest_daily", "latest_weekly", "top_movers", "panel_volume_heatmap",
                                  "panel_alert_coins", "performance_compare", "alerts_by_day", "top_coin_trends"])
def test_ticks_are_scanned_once_per_layer(spark, small, name):
    """One scan for the batch layer, one for the live layer where used; the newest-time lookup apart."""
    text = re.sub(r"ReadSchema: struct<ts:timestamp_ntz>", "", plan(QUERIES[name](spark, small)))
    limit = 2 if name.startswith("alerts_by_day") else 1
    assert len(re.findall(r"ReadSchema: struct", text)) <= limit


def test_no_forced_broadcast():
    """Sizes are Spark's to measure; the corpus operators have checks of their own."""
    import pathlib

    import tickmart
    root = pathlib.Path(tickmart.__file__).parent
    files = [p for p in root.rglob("*.py") if "llm" not in p.relative_to(root).parts]
    assert not [p for p in files if "F.broadcast(" in p.read_text()]
    assert not [p for p in files if "tempfile" in p.read_text()]


@pytest.mark.parametrize("name", ["affected_weeks", "affected_months", "base_correlation"])
def test_single_pass(spark, small, name):
    text = re.sub(r"ReadSchema: struct<ts:timestamp_ntz>", "", plan(QUERIES[name](spark, small)))
    assert len(re.findall(r"ReadSchema: struct", text)) == 1 and "Join" not in text


def test_alert_range_reaches_the_scan(spark, small):
    text = plan(QUERIES["alerts_total"](spark, small))
    # A bare column on one side: the scan can compare it with its row group statistics.
    assert re.search(r"\(ts#\d+ >= cast\(date_sub", text)


def test_date_filter_prunes_the_clean_table(feed, tmp_path, spark):
    from tickmart.sinks.tables import overwrite_partitions
    path = str(tmp_path / "clean")
    overwrite_partitions(feed.clean, path, ["date", "hour"])
    text = plan(spark.read.parquet(path).where(F.col("date") >= "2024-01-20").groupBy("coin_id").count())
    assert re.search(r"PartitionFilters: \[isnotnull\(date#\d+\), \(date#\d+ >= ", text)
    assert "ReadSchema: struct<coin_id:string>" in text


def test_one_dominant_coin(spark):
    """A coin with most of the rows and a key with thousands of copies come out exact."""
    hot = spark.range(200_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("c"), F.col("id") % 500)).alias("coin_id"),
        F.lit("S").alias("symbol"), F.lit("N").alias("name"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 1000 * 60).cast("timestamp_ntz").alias("crawl_ts"),
        F.col("id").alias("last_updated"), (F.col("id") + 1).cast("double").alias("current_price"),
        F.lit(1).cast("bigint").alias("market_cap"), F.lit(1).alias("market_cap_rank"),
        F.lit(1).cast("bigint").alias("total_volume"))
    kept = clean.clean_ticks(hot)
    expected = hot.groupBy("coin_id", "crawl_ts").agg(F.max("current_price").alias("p"))
    assert kept.count() == expected.count()
    assert kept.agg(F.sum("current_price")).first()[0] == expected.agg(F.sum("p")).first()[0]
    day = rollup.daily_ohlc(kept).where("coin_id = 'hot'").agg(F.sum("record_count")).first()[0]
    assert day == expected.where("coin_id = 'hot'").count()
