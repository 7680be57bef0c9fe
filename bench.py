"""Timing of the headline queries and of the batch chain; prints one JSON line.

BENCH_SF_DIR picks the tables, BENCH_CPUS the cores, BENCH_QUERIES (comma separated, or "all") the queries.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import functions as F

from tickmart.operators import alerts, market, panels, serving
from tickmart.plans import jobs
from tickmart.plans.catalog import QUERIES
from tickmart.session import builder
from tickmart.sources import metric_tables
from tickmart.sources import tick_tables as tt

HEADLINE = [
    "clean_ticks", "quality_report", "daily_metrics", "weekly_metrics", "monthly_metrics", "orders_weekly",
    "affected_weeks", "latest_daily", "latest_snapshot", "price_alerts", "alerts_by_type", "alerts_by_day",
    "whale_detection", "pump_dump_batch", "sentiment_1m", "latest_prices_1m", "market_summary", "cap_distribution",
    "market_daily", "base_correlation", "rank_changes", "top_movers", "performance_compare", "price_trend",
    "search_coin", "panel_volume_heatmap", "export_daily", "upsert_by_id", "lambda_merge", "forward_fill",
]
REPEATS = 3
#: At sf0.1 this makes 2,000,000 raw messages, the size of the published data set.
CHAIN_COPIES = 20


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn) -> float:
    start = time.perf_counter()
    fn()
    return time.perf_counter() - start


def raw_lines(spark, folder: str, copies: int):
    """The live feed as raw messages with their landing folder, every coin ``copies`` times."""
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    ticks = tt.live_ticks(spark, folder).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    message = ticks.withColumns({
        "coin_id": F.concat_ws("-", "coin_id", "copy"), "symbol": F.concat("symbol", "copy"),
        "crawl_time": F.date_format("crawl_ts", iso), "last_updated": F.date_format("last_updated", iso),
    }).drop("crawl_ts", "copy")
    return message.select(F.to_json(F.struct("*")).alias("value"), F.substring("crawl_time", 1, 10).alias("dt"),
                          F.substring("crawl_time", 12, 2).alias("hr"))


def size_mb(path: str) -> float:
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(path) for f in files) / 1e6


def median_of(fn) -> float:
    fn()
    return round(statistics.median(timed(fn) for _ in range(REPEATS)), 4)


def dashboard(spark, layout: jobs.Layout) -> dict[str, float]:
    """Report queries on the stored metric tables, as a dashboard sends them."""
    daily = metric_tables.from_files(spark, layout.aggregated, "daily_metrics")
    newest = {t: lambda t=t: metric_tables.newest_period(spark, layout.aggregated, f"{t}_metrics") for t in ("daily", "weekly", "monthly")}
    latest, history, stored_alerts = (jobs.serving_table(spark, layout, t) for t in ("latest", "history", "alerts"))
    as_of = dt.date(2024, 1, 30)
    pages = {
        "stored_daily_report": lambda: serving.daily_report(newest["daily"]()),
        "stored_weekly_report": lambda: serving.weekly_report(newest["weekly"]()),
        "stored_monthly_report": lambda: serving.monthly_report(newest["monthly"]()),
        "stored_price_history": lambda: serving.price_history(history, "C01", as_of),
        "stored_price_trend": lambda: serving.price_trend(history, "C01", as_of),
        "stored_market_daily": lambda: market.market_daily(daily, "coin-0-1"),
        "stored_movers_table": lambda: serving.movers_table(daily.where("date = DATE'2024-01-29'")),
        "stored_market_summary": lambda: market.market_summary(latest),
        "stored_alerts_by_type": lambda: alerts.alerts_by(stored_alerts, "alert_type", as_of),
        "stored_alerts_by_day": lambda: alerts.alerts_by_day(stored_alerts, as_of),
        "stored_panel_volume_heatmap": lambda: panels.panel_volume_heatmap(daily, as_of, days=20),
        "stored_top_movers": lambda: market.movers_of(latest, daily, long_days=20),
    }
    return {name: median_of(lambda page=page: page().collect()) for name, page in pages.items()}


def batch_chain(spark, folder: str, copies: int) -> tuple[dict[str, float], float]:
    """Raw JSON to clean, daily, weekly and monthly tables, then the serving tables and the dashboard on them.

    Returns seconds per step and the megabytes of raw input.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        os.makedirs(shared, exist_ok=True)
    with tempfile.TemporaryDirectory(prefix="bench-", dir=shared) as root:
        layout = jobs.Layout(root)
        raw_lines(spark, folder, copies).repartition(32, "dt", "hr").write.partitionBy("dt", "hr").text(layout.raw)

        def run():
            jobs.clean_job(spark, layout)
            jobs.aggregate_job(spark, layout)

        seconds = {"batch_chain": round(timed(run), 3)}
        # The next run finds nothing new.
        seconds["batch_no_op"] = round(timed(run), 3)
        seconds["batch_serve"] = round(timed(lambda: jobs.serve_job(spark, layout)), 3)
        late = spark.read.text(f"{layout.raw}/dt=2024-01-15/hr=12").limit(100)
        late.coalesce(1).write.mode("append").text(f"{layout.raw}/dt=2024-01-15/hr=12")
        seconds["batch_increment"] = round(timed(run), 3)
        return {**seconds, **dashboard(spark, layout)}, size_mb(layout.raw)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if wanted == "all" else wanted.split(",") if wanted else HEADLINE
    spark = builder("bench", f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8,
                    **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"}).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    for name in names:  # warm up
        drain(QUERIES[name](spark, folder))
    seconds = {}
    for name in names:
        runs = [timed(lambda: drain(QUERIES[name](spark, folder))) for _ in range(REPEATS)]
        seconds[name] = round(statistics.median(runs), 4)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    line = {"metric": "total_median_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
            "queries": seconds, "sf": folder.rstrip("/").rsplit("sf", 1)[-1]}
    if not wanted:
        steps, mb = batch_chain(spark, folder, CHAIN_COPIES)
        seconds.update(steps)
        line["value"] = round(sum(seconds.values()), 3)
        line["batch_chain_mb_per_sec"] = round(mb / steps["batch_chain"], 2)
    print(json.dumps(line), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
