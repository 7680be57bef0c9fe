import datetime as dt
import json

import pytest
from frames import rows
from pyspark.sql import functions as F

from tickmart import cli
from tickmart.operators import clean, rollup, serving
from tickmart.plans import jobs
from tickmart.sinks import state
from tickmart.sinks.state import load_mark, save_mark
from tickmart.sinks.stores import DocumentStore, document_sink, parquet_sink
from tickmart.sources import metric_tables
from tickmart.sources.raw import raw_ticks, snapshot_file, write_snapshot

UTC = dt.timezone.utc


def tick(coin, when, price, updated=None, **extra):
    return {"crawl_time": when, "coin_id": coin, "symbol": coin.upper(), "name": coin.title(), "current_price": price,
            "market_cap": 1000.0, "market_cap_rank": 1, "total_volume": 5, "last_updated": updated or when, **extra}


def land(layout, ticks, part):
    for t in ticks:
        folder = layout_path(layout.raw) / f"dt={t['crawl_time'][:10]}" / f"hr={t['crawl_time'][11:13]}"
        folder.mkdir(parents=True, exist_ok=True)
        with open(folder / f"{part}.jsonl", "a") as f:
            f.write(json.dumps(t) + "\n")


def layout_path(p):
    from pathlib import Path
    return Path(p)


@pytest.fixture
def layout(tmp_path):
    return jobs.Layout(str(tmp_path))


def at(text):
    return dt.datetime.fromisoformat(text)


def clean_rows(spark, layout):
    return rows(spark.read.parquet(layout.clean), "coin_id", "crawl_ts", "current_price")


def test_marks(spark, tmp_path):
    path = str(tmp_path / "m")
    assert load_mark(spark, path) is None
    for v in ("a", "b", "", dt.date(2024, 1, 2)):
        save_mark(spark, path, v)
    assert load_mark(spark, path) == "2024-01-02"
    assert len([f for f in (tmp_path / "m").iterdir() if not f.name.startswith(".")]) == 2
    (tmp_path / "m" / "_unfinished").write_text("half")
    assert load_mark(spark, path) == "2024-01-02"


def test_small_state_tables_are_folded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(state, "FOLD_AT", 4)
    path, ddl = str(tmp_path / "t"), "run bigint, day date, hour int"
    assert state.read_rows(spark, path, ddl).count() == 0
    for n in range(11):
        state.append_rows(spark, path, [(n, dt.date(2024, 1, 1), None), (0, dt.date(2024, 1, 2), 3)], ddl)
    names = sorted(f.name for f in (tmp_path / "t").iterdir() if f.name[0].isdigit())
    assert len(names) <= 4 and names[0].endswith(".all")
    want = [(0, dt.date(2024, 1, 2), 3), *((n, dt.date(2024, 1, 1), None) for n in range(11))]
    assert sorted((tuple(r) for r in state.read_rows(spark, path, ddl).collect()), key=str) == sorted(want, key=str)
    (tmp_path / "t" / "000000000000").write_text(json.dumps({"run": 99}))  # left by a fold that died before removing
    assert state.read_rows(spark, path, ddl).where("run = 99").isEmpty()


def test_half_written_hour_is_completed(spark, layout):
    """Rows of an hour that arrive after a run do not displace the rows of that hour already there."""
    land(layout, [tick("a", "2024-01-01T10:00:00", 1.0), tick("a", "2024-01-01T10:04:00", 2.0)], "one")
    assert jobs.clean_job(spark, layout, at("2024-01-01T10:05:00"))["clean"] == 2
    land(layout, [tick("a", "2024-01-01T10:30:00", 3.0), tick("a", "2024-01-01T11:00:00", 4.0)], "two")
    jobs.clean_job(spark, layout, at("2024-01-01T11:05:00"))
    assert [r[2] for r in sorted(clean_rows(spark, layout), key=lambda r: r[1])] == [1.0, 2.0, 3.0, 4.0]


def test_late_day_reaches_every_table(spark, layout):
    """A tick that comes days late is cleaned, and the days, weeks and months behind it follow."""
    land(layout, days_of_ticks(dt.datetime(2024, 1, 1), 3), "one")
    jobs.clean_job(spark, layout)
    jobs.aggregate_job(spark, layout)
    land(layout, [tick("a", "2024-01-01T23:55:00", 77.0)], "late")
    assert jobs.clean_job(spark, layout)["raw"] == 1
    assert jobs.aggregate_job(spark, layout) == (dt.date(2024, 1, 1), dt.date(2024, 1, 1))
    day = spark.read.parquet(layout.metrics("daily_metrics")).where("coin_id = 'a' AND date = DATE'2024-01-01'").first()
    assert (day.close_price, day.record_count) == (77.0, 4)
    assert spark.read.parquet(layout.metrics("monthly_metrics")).where("coin_id = 'a'").first().high_price_month == 77.0


def test_fake_date_folder_is_read(spark, layout):
    """A folder is named after the fake date, far from the event time; its hour also has rows elsewhere."""
    land(layout, [tick("a", "2024-01-02T10:00:00", 1.0)], "one")
    jobs.clean_job(spark, layout)
    folder = layout_path(layout.raw) / "dt=2023-12-25" / "hr=10"
    folder.mkdir(parents=True)
    (folder / "x.jsonl").write_text(json.dumps(tick("b", "2024-01-02T10:30:00", 2.0, fake_date="2023-12-25")) + "\n")
    assert jobs.clean_job(spark, layout)["raw"] == 2
    assert [r[0] for r in clean_rows(spark, layout)] == ["a", "b"]
    land(layout, [tick("c", "2024-01-02T10:45:00", 3.0)], "three")
    assert jobs.clean_job(spark, layout)["raw"] == 3


def test_emptied_hour_goes(spark, layout):
    """A newer invalid copy of an hour's only tick removes the hour, and the day behind it."""
    land(layout, [tick("a", "2024-01-01T10:00:00", 1.0), tick("a", "2024-01-02T10:00:00", 1.0)], "one")
    jobs.clean_job(spark, layout)
    jobs.aggregate_job(spark, layout)
    land(layout, [tick("a", "2024-01-01T10:00:00", -1.0, "2024-01-03T00:00:00"), tick("a", "2024-01-02T11:00:00", 2.0)], "two")
    got = jobs.clean_job(spark, layout)
    assert (got["invalid"], got["clean"], got["partitions"]) == (1, 1, 1)
    assert [str(r[1]) for r in clean_rows(spark, layout)] == ["2024-01-02 10:00:00", "2024-01-02 11:00:00"]
    jobs.aggregate_job(spark, layout)
    assert rows(spark.read.parquet(layout.metrics("daily_metrics")), "date") == [(dt.date(2024, 1, 2),)]


def test_all_rows_invalid(spark, layout):
    land(layout, [tick("a", "2024-01-01T10:00:00", 1.0)], "one")
    jobs.clean_job(spark, layout)
    land(layout, [tick("a", "2024-01-01T10:00:00", -1.0, "2024-01-02T00:00:00")], "two")
    assert jobs.clean_job(spark, layout) == {"raw": 2, "duplicates": 1, "invalid": 1, "clean": 0, "quality_pct": 0.0, "partitions": 0}
    land(layout, [tick("a", "2024-01-01T12:00:00", 3.0), {"crawl_time": "junk"}], "three")
    assert jobs.clean_job(spark, layout)["clean"] == 1


def test_clean_job_counters_mark_and_no_op(spark, layout):
    assert jobs.clean_job(spark, layout) is None
    land(layout, [tick("a", "2024-01-01T10:00:00", 1.0), tick("a", "2024-01-01T10:00:00", 2.0, "2024-01-01T10:00:01"),
                  tick("b", "2024-01-01T10:00:00", -1.0)], "one")
    got = jobs.clean_job(spark, layout)
    assert got == {"raw": 3, "duplicates": 1, "invalid": 1, "clean": 1, "quality_pct": 33.33, "partitions": 1}
    assert load_mark(spark, layout.mark("clean")) == "2024-01-01T10:00:00+00:00"
    before = clean_rows(spark, layout)
    assert jobs.clean_job(spark, layout) is None
    assert clean_rows(spark, layout) == before


def test_first_run_takes_everything(spark, layout):
    land(layout, [tick("a", "2023-01-01T10:00:00", 1.0), tick("a", "2024-01-20T10:00:00", 2.0)], "one")
    assert jobs.clean_job(spark, layout, at("2024-01-20T12:00:00"))["clean"] == 2


def test_rows_after_now_wait(spark, layout):
    land(layout, [tick("a", "2024-01-01T10:00:00", 1.0), tick("a", "2024-01-01T11:30:00", 1.5), tick("a", "2024-01-01T12:00:00", 1.0)], "one")
    assert jobs.clean_job(spark, layout, at("2024-01-01T11:00:00"))["raw"] == 1
    assert jobs.clean_job(spark, layout, at("2024-01-01T11:45:00"))["raw"] == 1
    assert jobs.clean_job(spark, layout, at("2024-01-01T11:50:00")) is None
    assert jobs.clean_job(spark, layout)["raw"] == 1
    assert len(clean_rows(spark, layout)) == 3


def days_of_ticks(first, count, price=1.0):
    out = []
    for d in range(count):
        for h in (1, 9, 20):
            when = (first + dt.timedelta(days=d, hours=h)).isoformat()
            out += [tick("a", when, price + d + h), tick("b", when, 50.0 + (d * 7 + h) % 11)]
    return out


def tables(spark, layout):
    return {t: rows(spark.read.parquet(layout.metrics(t)).drop("day"),
                    *sorted(c for c in spark.read.parquet(layout.metrics(t)).columns if c != "day"))
            for t in ("daily_metrics", "weekly_metrics", "monthly_metrics")}


def serving_rows(spark, layout):
    return {t: rows(jobs.serving_table(spark, layout, t), *sorted(jobs.serving_table(spark, layout, t).columns))
            for t in ("latest", "history", "alerts", "volume_baseline")}


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1)])
def test_any_arrival_order_equals_one_full_run(spark, tmp_path, order):
    """Over a month and year boundary, in three steps and at once; and running again changes nothing."""
    ticks = days_of_ticks(dt.datetime(2024, 12, 29), 5)
    for i, t in enumerate(ticks):
        t["price_change_percentage_1h"], t["total_volume"] = (i % 5) * 3, 5 + 400 * (i % 17 == 0)
    split, whole = jobs.Layout(str(tmp_path / "split")), jobs.Layout(str(tmp_path / "whole"))
    cuts = [(0, 9), (9, 20), (20, 30)]
    for i in order:
        land(split, ticks[slice(*cuts[i])], f"p{i}")
        jobs.clean_job(spark, split)
        jobs.aggregate_job(spark, split)
        jobs.serve_job(spark, split)
    land(whole, ticks, "all")
    jobs.clean_job(spark, whole)
    assert jobs.aggregate_job(spark, whole) == (dt.date(2024, 12, 29), dt.date(2025, 1, 2))
    assert jobs.serve_job(spark, whole) == (dt.date(2024, 12, 29), dt.date(2025, 1, 2))
    assert tables(spark, split) == tables(spark, whole)
    assert serving_rows(spark, split) == serving_rows(spark, whole)
    direct = rollup.daily_metrics(spark.read.parquet(whole.clean))
    assert tables(spark, whole)["daily_metrics"] == rows(direct, *sorted(direct.columns))
    snapshot = serving.latest_snapshot(spark.read.parquet(whole.clean))
    assert serving_rows(spark, whole)["latest"] == rows(snapshot, *sorted(snapshot.columns))
    assert {a[3] for a in serving_rows(spark, whole)["alerts"]} or serving_rows(spark, whole)["alerts"]
    assert jobs.aggregate_job(spark, whole) is None and jobs.serve_job(spark, whole) is None
    assert tables(spark, whole) == tables(spark, split)


def test_a_late_tick_reads_its_hour_only(spark, layout, monkeypatch):
    """Of the clean table just the late tick's hour is opened; the day follows from the states of its hours."""
    land(layout, days_of_ticks(dt.datetime(2024, 1, 1), 3), "one")
    jobs.clean_job(spark, layout)
    jobs.aggregate_job(spark, layout)
    land(layout, [tick("a", "2024-01-02T09:30:00", 99.0)], "late")
    jobs.clean_job(spark, layout)
    opened = []

    def spy(spark, path, folders, schema, fmt, real=jobs.read_folders):
        opened.append((path, list(folders)))
        return real(spark, path, folders, schema, fmt)

    monkeypatch.setattr(jobs, "read_folders", spy)
    jobs.aggregate_job(spark, layout)
    day = [f"date=2024-01-02/hour={h}" for h in (1, 9, 20)]
    assert opened == [(layout.clean, day[1:2]), (layout.metrics("hour_states"), day)]
    direct = rollup.daily_metrics(spark.read.parquet(layout.clean))
    assert tables(spark, layout)["daily_metrics"] == rows(direct, *sorted(direct.columns))


def test_states_are_made_up_for_days_without_any(spark, layout):
    """An installation from before there were states: the first touched hour brings those of its day."""
    land(layout, days_of_ticks(dt.datetime(2024, 1, 1), 2), "one")
    jobs.clean_job(spark, layout)
    jobs.aggregate_job(spark, layout)
    jobs.remove_folder(spark, layout.metrics("hour_states"))
    land(layout, [tick("a", "2024-01-01T09:30:00", 99.0)], "late")
    jobs.clean_job(spark, layout)
    jobs.aggregate_job(spark, layout)
    direct = rollup.daily_metrics(spark.read.parquet(layout.clean))
    assert tables(spark, layout)["daily_metrics"] == rows(direct, *sorted(direct.columns))


def test_counters_come_with_the_one_write(spark, layout, monkeypatch):
    """The increment is neither kept nor computed twice for its counters."""
    land(layout, days_of_ticks(dt.datetime(2024, 1, 1), 2), "one")
    collapsed, actions = [], []
    monkeypatch.setattr(jobs.clean, "collapsed", lambda df, real=clean.collapsed: collapsed.append(1) or real(df))
    monkeypatch.setattr(type(spark.range(1)), "persist", lambda *a, **k: actions.append("persist"))
    got = jobs.clean_job(spark, layout, at("2024-01-02T12:00:00"))
    assert got == {"raw": 10, "duplicates": 0, "invalid": 0, "clean": 10, "quality_pct": 100.0, "partitions": 5}
    assert collapsed == [1] and actions == []


def test_newest_period_reads_one_folder(spark, layout):
    land(layout, days_of_ticks(dt.datetime(2024, 9, 28), 14), "one")
    jobs.clean_job(spark, layout)
    jobs.aggregate_job(spark, layout)
    for table, date in (("daily_metrics", "day=11"), ("weekly_metrics", "week_of_year=41"), ("monthly_metrics", "month=10")):
        newest = metric_tables.newest_period(spark, layout.aggregated, table)
        assert newest.count() == 2 and all(date in f for f in newest.inputFiles())
    whole, newest = (serving.daily_report(f(spark, layout.aggregated, "daily_metrics")) for f in (metric_tables.from_files, metric_tables.newest_period))
    assert rows(whole) == rows(newest)
    assert metric_tables.newest_period(spark, str(layout.root) + "/none", "daily_metrics").isEmpty()


def test_aggregate_without_data(spark, layout):
    assert jobs.aggregate_job(spark, layout) is None and jobs.serve_job(spark, layout) is None


def test_reset_starts_over(spark, layout):
    land(layout, days_of_ticks(dt.datetime(2024, 5, 1), 3), "one")
    jobs.clean_job(spark, layout)
    jobs.aggregate_job(spark, layout)
    jobs.reset_job(spark, layout, dt.date(2024, 5, 2))
    assert jobs.clean_job(spark, layout)["raw"] == 12
    assert jobs.aggregate_job(spark, layout) == (dt.date(2024, 5, 2), dt.date(2024, 5, 3))
    assert jobs.clean_job(spark, layout) is None


def test_raw_scan_prunes_folders(spark, layout):
    land(layout, days_of_ticks(dt.datetime(2024, 5, 1), 6), "one")
    df = raw_ticks(spark, layout.raw, since=dt.date(2024, 5, 5))
    assert rows(df.select(F.substring("crawl_time", 1, 10).alias("d")).distinct()) == \
        [("2024-05-04",), ("2024-05-05",), ("2024-05-06",)]
    assert len(df.inputFiles()) == 9
    assert raw_ticks(spark, layout.raw, since=dt.date(2025, 1, 1)).isEmpty()


def test_snapshot_file(spark, tmp_path):
    (tmp_path / "snap.json").write_text(json.dumps([tick("a", "2024-01-01T00:00:00", 1.5, ath_date="x"),
                                                    tick("b", "2024-01-01T00:00:00", 2)], indent=2))
    df = snapshot_file(spark, str(tmp_path / "snap.json"))
    assert rows(clean.coerce_measures(df), "coin_id", "current_price") == [("a", 1.5), ("b", 2.0)]
    write_snapshot(df, str(tmp_path / "lines"))
    assert rows(spark.read.schema(df.schema).json(str(tmp_path / "lines")), "coin_id") == [("a",), ("b",)]


def test_export_to_both_stores(spark, layout, tmp_path):
    land(layout, days_of_ticks(dt.datetime(2024, 5, 1), 3), "one")
    jobs.clean_job(spark, layout)
    jobs.aggregate_job(spark, layout)
    sql, docs = parquet_sink(str(tmp_path / "sql")), document_sink(spark, str(tmp_path / "docs"))
    for _ in range(2):
        jobs.export_job(spark, layout, sql, docs)
    daily = spark.read.parquet(str(tmp_path / "sql" / "daily_metrics"))
    assert daily.count() == 6 and dict(daily.dtypes)["date"] == "string" and "day" not in daily.columns
    stored = DocumentStore(spark, str(tmp_path / "docs" / "daily_metrics")).read()
    assert stored.count() == 6
    assert "a_2024-05-01T00:00:00.000Z" in {r.doc_id for r in stored.collect()}
    weekly = DocumentStore(spark, str(tmp_path / "docs" / "weekly_metrics")).read()
    assert rows(weekly, "doc_id") == [("a_2024_18",), ("b_2024_18",)]


def batch(spark, store, n, *docs, writer="direct"):
    return store.upsert(spark.createDataFrame(docs, "doc_id string, v int"), n, writer)


def test_document_store_versions(spark, tmp_path):
    store = DocumentStore(spark, str(tmp_path / "d"))
    with pytest.raises(ValueError):
        store.read()
    batch(spark, store, 0, ("a", 1), ("b", 1))
    assert batch(spark, store, 1, ("b", 2), ("c", 2)) == {"accepted": 2, "rejected": 0}
    assert batch(spark, store, 1, ("b", 9), ("z", 2)) == {"accepted": 0, "rejected": 0}  # a repeat
    assert rows(store.read()) == [("a", 1), ("b", 2), ("c", 2)]
    held = store.read()
    batch(spark, store, 2, ("a", 3))
    assert rows(held) == [("a", 1), ("b", 2), ("c", 2)]  # a reader of the version before
    assert rows(store.read()) == [("a", 3), ("b", 2), ("c", 2)]
    assert sorted(p.name for p in (tmp_path / "d").glob("version=*")) == ["version=1", "version=2"]


def test_a_killed_write_leaves_the_old_version(spark, tmp_path, monkeypatch):
    store = DocumentStore(spark, str(tmp_path / "d"))
    batch(spark, store, 0, ("a", 1))

    def die(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr("tickmart.sinks.stores.save_mark", die)
        with pytest.raises(RuntimeError):
            batch(spark, store, 1, ("a", 2), ("b", 2))
    assert rows(store.read()) == [("a", 1)]
    batch(spark, store, 1, ("a", 2), ("b", 2))
    assert rows(store.read()) == [("a", 2), ("b", 2)]


def test_document_store_keeps_batches_of_other_writers(spark, tmp_path):
    """A restart with a fresh checkpoint counts from 0 again; so does a second stream or an export."""
    store = DocumentStore(spark, str(tmp_path / "d"))
    batch(spark, store, 0, ("a", 1), writer="first")
    batch(spark, store, 1, ("b", 1), writer="first")
    batch(spark, store, 0, ("c", 1), ("b", 2), writer="second")
    batch(spark, store, 1, ("b", 1), writer="first")  # repeated after a newer writer
    assert rows(store.read()) == [("a", 1), ("b", 2), ("c", 1)]
    store.upsert(spark.createDataFrame([("d", "new column")], "doc_id string, w string"), 0, "third")
    assert {r.doc_id: (r.v, r.w) for r in store.read().collect()}["d"] == (None, "new column")


def test_document_store_counts_rejects(spark, tmp_path):
    store = DocumentStore(spark, str(tmp_path / "d"))
    assert batch(spark, store, 0, ("a", 1), (None, 2), ("", 3)) == {"accepted": 1, "rejected": 2}
    assert rows(store.counts()) == [("direct-0", 1, 2)]
    assert rows(store.read()) == [("a", 1)]


def test_retention_removes_folders(spark, layout):
    land(layout, days_of_ticks(dt.datetime(2024, 5, 1), 5), "one")
    jobs.clean_job(spark, layout)
    gone = [dt.date(2024, 5, 1), dt.date(2024, 5, 2)]
    assert jobs.retain_job(spark, layout.clean, dt.date(2024, 5, 5), days=2) == gone
    assert spark.read.parquet(layout.clean).agg(F.min("date")).first()[0] == gone[0]
    assert jobs.retain_job(spark, layout.clean, dt.date(2024, 5, 5), days=2, dry_run=False) == gone
    assert spark.read.parquet(layout.clean).agg(F.min("date")).first()[0] == dt.date(2024, 5, 3)
    assert jobs.retain_job(spark, layout.clean, dt.date(2024, 5, 5), days=2) == []


def test_commands(spark, layout, tmp_path):
    """Every command on a small folder, streams with --once."""
    messages = tmp_path / "messages"
    messages.mkdir()
    ticks = days_of_ticks(dt.datetime(2024, 5, 1), 3)
    (messages / "a.txt").write_text("\n".join(json.dumps(t) for t in ticks) + "\n")
    go = lambda *argv: cli.run(spark, ["--root", layout.root, *argv])
    go("land", "--files", str(messages), "--once")
    assert go("clean")["clean"] == 18 and go("clean") is None
    assert go("aggregate") == go("serve") == (dt.date(2024, 5, 1), dt.date(2024, 5, 3))
    go("export", "--documents", str(tmp_path / "docs"), "--tables", str(tmp_path / "tables"))
    assert DocumentStore(spark, str(tmp_path / "docs/latest")).read().count() == 2
    assert spark.read.parquet(str(tmp_path / "tables/daily_metrics")).count() == 6
    (messages / "b.txt").write_text(json.dumps(tick("a", "2024-05-04T00:00:00", 5.0, total_volume=10**6)) + "\n")
    go("stream", "--files", str(messages), "--once", "--output", "whale=store", "--output", "clean=json")
    whales = DocumentStore(spark, str(tmp_path / "outputs/whale")).read()
    assert rows(whales, "coin_id") == [("a",)]
    assert spark.read.json(str(tmp_path / "outputs/clean")).count() == 19
    assert go("retain", "--as-of", "2024-05-03", "--days", "1") == [dt.date(2024, 5, 1)]
    go("reset", "--date", "2024-05-02")
    assert go("clean")["raw"] == 12
    with pytest.raises(SystemExit):
        go("stream", "--files", str(messages), "--once", "--output", "nonsense=json")
