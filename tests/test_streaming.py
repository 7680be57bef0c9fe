import datetime as dt
import json
import os
import subprocess
import sys
from pathlib import Path

import pytest
from frames import rows
from oracle_check import database
from pyspark.sql import functions as F

from tickmart.operators import alerts, clean, rollup
from tickmart.operators.sentiment import latest_prices_1m, sentiment_1m
from tickmart.plans import oracle
from tickmart.sinks.stores import DocumentStore
from tickmart.sources import tick_tables as tt
from tickmart.sources.raw import raw_ticks
from tickmart.streaming import app, feeds, stages

ONCE = {"availableNow": True}


def message(coin="btc", when="2024-01-01T00:00:10", price=100.0, h1=0.0, h24=0.0, **extra):
    return {"crawl_time": when, "coin_id": coin, "symbol": coin.upper(), "name": coin.title(), "current_price": price,
            "price_change_percentage_1h": h1, "price_change_percentage_24h": h24, "market_cap": 1000.5,
            "market_cap_rank": 1, "total_volume": 3.0, **extra}


def publish(folder, name, messages):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(m if isinstance(m, str) else json.dumps(m) for m in messages) + "\n")


def memory_sink():
    """Output held in the driver, for tests only."""
    def run(df, name, mode, checkpoint, trigger):
        return feeds.start(df, name, mode, checkpoint, trigger, lambda w: w.format("memory"))

    return run


def finish(queries):
    for q in queries:
        q.processAllAvailable() if q.isActive else None
        q.awaitTermination(60)
        assert q.exception() is None


def run(spark, folder, tmp_path, sinks, **kw):
    finish(app.run_outputs(feeds.file_feed(spark, str(folder), 1), sinks, str(tmp_path / "cp"), ONCE, **kw))


def test_parse_keeps_float_formatted_integers(spark):
    df = spark.createDataFrame([(json.dumps(message(circulating_supply="19.0")),), ("no json",)], "value string")
    got = {r.coin_id: r for r in stages.parse_ticks(df).collect()}
    assert (got["btc"].market_cap, got["btc"].total_volume, got["btc"].circulating_supply) == (1000, 3, 19)
    assert got[None].crawl_ts is None


@pytest.mark.parametrize("h1,h24,kind", [
    (5.0, -50, "PUMP_1H"), (4.99, 10.0, "PUMP_24H"), (-5.0, 50, "DUMP_1H"), (0, -10.0, "DUMP_24H"),
    (0, 9.99, None), (None, 12, "PUMP_24H"), (None, None, None)])
def test_alert_rules(spark, h1, h24, kind):
    df = spark.createDataFrame([(json.dumps(message(h1=h1, h24=h24)),)], "value string")
    got = [r.alert_type for r in stages.alert_stream(stages.parse_ticks(df)).collect()]
    assert got == ([kind] if kind else [])


def test_clean_rejects_and_alerts_streams(spark, tmp_path):
    feed = tmp_path / "in"
    publish(feed, "a.txt", [message(h1=7.0), message("eth", price=-1), "not json", message("ada")])
    out = {n: str(tmp_path / n) for n in ("clean", "rejects", "alerts")}
    run(spark, feed, tmp_path, {n: feeds.json_sink(p) for n, p in out.items()}, as_json=("alerts",))
    clean = spark.read.json(out["clean"])
    assert rows(clean, "key") == [("ada",), ("btc",)]
    assert spark.read.json(out["rejects"]).count() == 2
    alert = json.loads(spark.read.json(out["alerts"]).first().value)
    assert alert["alert_category"] == "price_alert" and alert["change_1h"] == 7.0 and "alert_time" in alert


def test_update_mode_sentiment_equals_batch(spark, small, tmp_path):
    """Time-ordered files through the upsert sink end in the batch result, open window included."""
    ticks = tt.live_ticks(spark, small).withColumn("crawl_ts", F.col("crawl_ts").cast("timestamp"))
    src = str(tmp_path / "ticks")
    for week in range(5):  # the feed takes files by age, so each is written after the one before
        ticks.where(F.floor((F.dayofmonth("crawl_ts") - 1) / 7) == week).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(spark.read.parquet(src).schema).option("maxFilesPerTrigger", 1).parquet(src)
    store = str(tmp_path / "store")
    q = feeds.upsert_sink(store)(stages.sentiment_stream(stream), "s", "update", str(tmp_path / "cp"), ONCE)
    finish([q])
    got = DocumentStore(spark, store).read().drop("doc_id")
    want = sentiment_1m(spark.read.parquet(src))
    columns = [c for c in want.columns if c != "avg_change_24h"]
    assert rows(got, *columns) == rows(want, *columns)
    assert want.count() == 988


def test_append_mode_withholds_the_open_window(spark, small, tmp_path):
    src = str(tmp_path / "ticks")
    (tt.live_ticks(spark, small).withColumn("crawl_ts", F.col("crawl_ts").cast("timestamp"))
     .repartitionByRange(4, "crawl_ts").write.parquet(src))
    stream = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    q = memory_sink()(stages.sentiment_stream(stream), "appended", "append", str(tmp_path / "cp"), ONCE)
    finish([q])
    assert spark.table("appended").count() == 987


def test_late_rows_are_dropped_and_repeats_change_nothing(spark, tmp_path):
    feed, store = tmp_path / "in", str(tmp_path / "store")
    sinks = {"sentiment": feeds.upsert_sink(store)}
    publish(feed, "a.txt", [message(h24=1.0)])
    run(spark, feed, tmp_path, sinks)
    publish(feed, "b.txt", [message(when="2024-01-01T00:10:00", h24=-1.0)])
    run(spark, feed, tmp_path, sinks)
    publish(feed, "c.txt", [message("late", when="2024-01-01T00:00:20", h24=1.0)])
    run(spark, feed, tmp_path, sinks)
    run(spark, feed, tmp_path, sinks)
    got = rows(DocumentStore(spark, store).read(), "window_start", "total_coins", "sentiment")
    assert [(str(w), n, s) for w, n, s in got] == [("2024-01-01 00:00:00", 1, "BULLISH"), ("2024-01-01 00:10:00", 1, "BEARISH")]


def test_latest_prices_stream_equals_batch(spark, tmp_path):
    feed = tmp_path / "in"
    messages = [message(when=f"2024-01-01T00:0{m}:{s:02d}", price=float(m * 60 + s)) for m in range(3) for s in (5, 50)]
    publish(feed, "a.txt", messages)
    out = str(tmp_path / "out")
    run(spark, feed, tmp_path, {"latest_prices": feeds.upsert_sink(out)})
    batch = spark.createDataFrame([(json.dumps(m),) for m in messages], "value string")
    want = latest_prices_1m(stages.parse_ticks(batch))
    assert want.count() == 3
    newest = want.agg(F.max("latest_price")).first()[0]
    assert newest == 170.0
    got = rows(DocumentStore(spark, out).read(), "coin_id", "latest_price", "last_update")  # one document a coin, its newest
    assert got == rows(want.where(F.col("latest_price") == newest), "coin_id", "latest_price", "last_update")


def test_landing_folders_and_raw_scan(spark, tmp_path):
    feed, raw = tmp_path / "in", str(tmp_path / "raw")
    publish(feed, "a.txt", [
        message("a", when="2024-01-01T05:00:00Z"), message("b", when="2024-01-01T23:00:00+07:00"),
        message("c", when="junk"), message("d", when="junk", fake_date="2023-12-31"),
        message("e", when="2024-01-02T07:00:00", fake_date="2023-12-30"), message("f", when=None, fake_date="2023-12-29"),
        message("g", when=None), "no json"])
    finish([app.land_raw(feeds.file_feed(spark, str(feed)), raw, str(tmp_path / "cp"), ONCE)])
    landed = spark.read.option("basePath", raw).json(raw)
    got = {r.coin_id: (str(r.dt), r.hr) for r in landed.collect()}
    assert got == {"a": ("2024-01-01", 5), "b": ("2024-01-01", 23), "d": ("2023-12-31", 0), "e": ("2023-12-30", 7),
                   "f": ("2023-12-29", 0)}
    assert raw_ticks(spark, raw).count() == 5


def test_bounded_consumer_resumes(spark, tmp_path):
    feed, raw, cp = tmp_path / "in", str(tmp_path / "raw"), str(tmp_path / "cp")
    for n in range(2):
        publish(feed, f"{n}.txt", [message(f"c{n}")])
        finish([app.land_raw(feeds.file_feed(spark, str(feed), 1), raw, cp, ONCE)])
    assert rows(raw_ticks(spark, raw), "coin_id") == [("c0",), ("c1",)]


def test_messages_into_stores(spark, tmp_path):
    """Alert and sentiment messages end in their stores; incomplete ones are skipped."""
    alert = {"alert_type": "PUMP_1H", "coin_id": "btc", "alert_time": "2024-01-01T00:00:00.000Z", "change_1h": 6.0}
    publish(tmp_path / "alerts", "a.txt", [alert, {**alert, "change_1h": 7.0, "alert_time": "2024-01-01T00:01:00.000Z"},
                                           {**alert, "coin_id": ""}, {"coin_id": "x"}])
    publish(tmp_path / "mood", "a.txt", [{"window_start": "2024-01-01T00:00:00.000Z", "sentiment": "BULLISH"},
                                         {"sentiment": "BEARISH"}])
    sinks = {n: feeds.upsert_sink(str(tmp_path / f"{n}_store")) for n in ("alerts", "sentiment")}
    finish(app.serve_messages(feeds.file_feed(spark, str(tmp_path / "alerts")), feeds.file_feed(spark, str(tmp_path / "mood")),
                              sinks, str(tmp_path / "cp"), ONCE))
    assert rows(DocumentStore(spark, str(tmp_path / "alerts_store")).read(), "doc_id") == \
        [("btc_2024-01-01 00:00:00",), ("btc_2024-01-01 00:01:00",)]
    assert rows(DocumentStore(spark, str(tmp_path / "sentiment_store")).read(), "doc_id", "sentiment") == \
        [("2024-01-01 00:00:00", "BULLISH")]


def test_console_monitor_and_kafka_sink_definitions(spark, tmp_path):
    feed = tmp_path / "in"
    publish(feed, "a.txt", [message(h1=7.0)])
    run(spark, feed, tmp_path, {"monitor": feeds.console_sink()})
    with pytest.raises(Exception, match="(?i)kafka"):
        feeds.kafka_feed(spark, "localhost:1").isStreaming


def test_whale_stream_join(spark, tmp_path):
    feed = tmp_path / "in"
    publish(feed, "a.txt", [message("a", total_volume=201), message("b", total_volume=200), message("c", total_volume=999)])
    baseline = spark.createDataFrame([("a", 100.0), ("b", 100.0)], "coin_id string, normal_volume double")
    stream = stages.whale_stream(stages.parse_ticks(feeds.file_feed(spark, str(feed))), baseline)
    finish([memory_sink()(stream, "whales", "append", str(tmp_path / "cp"), ONCE)])
    assert [(r.coin_id, round(r.volume_spike_pct, 6)) for r in spark.table("whales").collect()] == [("a", 201.0)]


def test_fresh_checkpoint_keeps_earlier_documents(spark, tmp_path):
    """Batch numbers start at 0 again; nothing that an earlier run stored is lost."""
    feed, store = tmp_path / "in", str(tmp_path / "store")
    publish(feed, "a.txt", [message("a", h1=7.0)])
    finish(app.run_outputs(feeds.file_feed(spark, str(feed)), {"alerts": feeds.upsert_sink(store)}, str(tmp_path / "cp1"), ONCE))
    (feed / "a.txt").unlink()
    publish(feed, "b.txt", [message("b", h1=7.0)])
    finish(app.run_outputs(feeds.file_feed(spark, str(feed)), {"alerts": feeds.upsert_sink(store)}, str(tmp_path / "cp2"), ONCE))
    assert rows(DocumentStore(spark, store).read(), "coin_id") == [("a",), ("b",)]


def test_whale_output_needs_a_baseline(spark, tmp_path):
    publish(tmp_path / "in", "a.txt", [message("a", total_volume=500)])
    sinks = {"whale": feeds.upsert_sink(str(tmp_path / "store"))}
    with pytest.raises(ValueError):
        run(spark, tmp_path / "in", tmp_path, sinks)
    run(spark, tmp_path / "in", tmp_path, sinks, baseline=spark.createDataFrame([("a", 100.0)], "coin_id string, normal_volume double"))
    assert rows(DocumentStore(spark, str(tmp_path / "store")).read(), "coin_id", "current_volume") == [("a", 500)]


WHALE_COLUMNS = ["coin_id", "date", "current_volume", "normal_volume", "volume_spike_pct", "return_pct_day", "close_price"]


def batch_whales(spark, messages):
    batch = spark.createDataFrame([(json.dumps(m),) for m in messages], "value string")
    ticks = clean.validate(stages.parse_ticks(batch)).withColumn("date", F.to_date("crawl_ts"))
    return alerts.whale_detection(rollup.daily_metrics(ticks))


def volumes(coin, days, **extra):
    """One coin's ticks: (day of January, volume) pairs, two ticks a day of which the later one counts."""
    for day, volume in days:
        date = dt.date(2024, 1, 1) + dt.timedelta(days=day - 1)
        yield message(coin, when=f"{date}T08:00:00", total_volume=7, **extra)
        yield message(coin, when=f"{date}T20:00:00", total_volume=volume, **extra)


def state_rows(spark, checkpoint, operator):
    return spark.read.format("statestore").option("operatorId", operator).option("stateVarName", "volumes").load(checkpoint)


def test_volume_state_over_restarts_equals_the_batch(spark, tmp_path):
    """The feed comes in three runs of one checkpoint; days are judged as they close, from state of earlier runs."""
    feed, out = tmp_path / "in", str(tmp_path / "out")
    plan = [(d, 100 + d) for d in range(1, 10)] + [(10, 900), (11, 100), (14, 5000), (15, 3), (20, 90), (29, 1000), (30, 4000), (31, 1)]
    messages = sorted([*volumes("a", plan), *volumes("b", [(d, 50 * (1 + (d % 9 == 0) * 8)) for d in range(1, 32)]),
                       *volumes("c", [(3, 1), (4, 3), (30, 10), (31, 100)])], key=lambda m: m["crawl_time"])
    for n, part in enumerate((messages[:50], messages[50:75], messages[75:])):
        publish(feed, f"{n}.txt", part)
        run(spark, feed, tmp_path, {"whale_days": feeds.json_sink(out)})
    got = spark.read.schema("coin_id string, date date, current_volume bigint, normal_volume double, volume_spike_pct double, "
                            "return_pct_day double, close_price double").json(out)
    want = batch_whales(spark, messages).where("date < DATE'2024-01-31'")
    assert want.count() > 5 and {r.coin_id for r in want.collect()} == {"a", "b", "c"}
    assert rows(got, *WHALE_COLUMNS) == rows(want, *WHALE_COLUMNS)


def test_idle_coins_leave_the_state(spark, tmp_path):
    feed = tmp_path / "in"
    publish(feed, "0.txt", [*volumes("idle", [(1, 5), (2, 5)]), *volumes("busy", [(d, 5) for d in range(1, 4)])])
    sinks = {"whale_days": feeds.json_sink(str(tmp_path / "out"))}
    run(spark, feed, tmp_path, sinks)
    states = lambda: state_rows(spark, str(tmp_path / "cp" / "whale_days"), 0)
    assert {r[0].coin_id for r in states().select("key").collect()} == {"idle", "busy"}
    publish(feed, "1.txt", list(volumes("busy", [(d, 5) for d in range(4, 25)])))
    run(spark, feed, tmp_path, sinks)
    assert {r[0].coin_id for r in states().select("key").collect()} == {"busy"}
    assert states().count() <= 8


def test_repeated_messages_change_nothing(spark, tmp_path):
    """The same file again under another name, in the same run and after a restart."""
    feed, out = tmp_path / "in", str(tmp_path / "clean")
    first = [message(when=f"2024-01-01T00:{m:02d}:00", h1=7.0) for m in range(10)]
    sinks = {"clean": feeds.json_sink(out), "alerts": feeds.json_sink(str(tmp_path / "alerts"))}
    publish(feed, "0.txt", first)
    publish(feed, "1.txt", first)
    run(spark, feed, tmp_path, sinks)
    assert spark.read.json(out).count() == 10 and spark.read.json(str(tmp_path / "alerts")).count() == 10
    publish(feed, "2.txt", [*first, message("eth"), message("noon", when=None), message("noon", when=None)])
    run(spark, feed, tmp_path, sinks)
    assert spark.read.json(out).count() == 13


def test_repeats_state_stays_bounded(spark, tmp_path):
    """Keys leave the state once the feed is past them; the progress report says how many are held."""
    feed = tmp_path / "in"
    for day in range(1, 9):
        publish(feed, f"{day}.txt", [message(when=f"2024-01-{day:02d}T{h:02d}:00:00") for h in range(24)])
    stream = stages.unique_ticks(stages.parse_ticks(feeds.file_feed(spark, str(feed), 1)), "2 hours")
    query = memory_sink()(stream, "bounded", "append", str(tmp_path / "cp"), ONCE)
    finish([query])
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert len(held) >= 8 and max(held) <= 48 and held[-1] <= 27
    assert spark.table("bounded").count() == 8 * 24


def test_unique_ticks_on_a_batch(spark):
    data = [(json.dumps(m),) for m in (message(), message(price=2.0), message("eth"), message("x", when=None), message("x", when=None))]
    assert stages.unique_ticks(stages.parse_ticks(spark.createDataFrame(data, "value string"))).count() == 4


PLAIN_SESSION = """
import sys
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", 2) \\
    .config("spark.sql.warehouse.dir", sys.argv[1]).getOrCreate()
sys.path.insert(0, sys.argv[2])
import __spark_entry__ as entry
print("rows", entry.queries()["stream_whale_days"](spark, sys.argv[3]).count())
"""


def test_whale_days_where_workers_lack_the_package(tmp_path, small):
    """A session that somebody else built, with Spark's default state store, in a folder without the package."""
    script = tmp_path / "plain.py"
    script.write_text(PLAIN_SESSION)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH" and not k.startswith("PYSPARK_GATEWAY")}
    done = subprocess.run([sys.executable, str(script), str(tmp_path / "warehouse"), str(Path(__file__).resolve().parents[1]), small],
                          cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    want = database(small).execute(f"SELECT count(*) FROM ({oracle.statements()['stream_whale_days']})").fetchone()[0]
    assert want > 0 and f"rows {want}" in done.stdout
