import datetime as dt

from frames import rows
from pyspark.sql import functions as F

from tickmart.functions.calendar import instant, iso_week_year
from tickmart.operators import clean
from tickmart.schemas import CLEAN_COLUMNS, raw_schema


def raw(spark, *records):
    names = [f.name for f in raw_schema().fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in records], raw_schema())


BASE = {"crawl_time": "2024-03-01T10:00:00", "coin_id": "btc", "symbol": "BTC", "name": "Bitcoin",
        "current_price": "100.5", "market_cap": "1000", "market_cap_rank": "1", "total_volume": "10",
        "last_updated": "2024-03-01T09:59:00Z"}


def test_latest_copy_stays_and_nulls_lose(spark):
    df = raw(spark, BASE, {**BASE, "last_updated": "2024-03-01T09:59:30Z", "current_price": "101"},
             {**BASE, "last_updated": None, "current_price": "99"})
    assert rows(clean.dedup_latest(df), "current_price") == [("101",)]


def test_ties_are_broken_the_same_way_every_time(spark):
    copies = [{**BASE, "current_price": str(p)} for p in (100, 300, 200)]
    got = {rows(clean.dedup_latest(raw(spark, *order)), "current_price")[0]
           for order in (copies, copies[::-1], copies[1:] + copies[:1])}
    assert got == {("300",)}


def test_duplicates_are_removed_before_validation(spark):
    """A newer invalid copy shadows an older valid one."""
    df = raw(spark, BASE, {**BASE, "last_updated": "2024-03-01T09:59:59Z", "current_price": "0"})
    assert clean.clean_ticks(df).count() == 0


def test_coercion(spark):
    df = raw(spark, {**BASE, "market_cap": "1.9", "market_cap_rank": "3.0", "total_volume": "9007199254740993",
                     "circulating_supply": "1E3", "max_supply": "n/a", "high_24h": ""})
    got = clean.coerce_measures(df).first()
    assert (got.market_cap, got.market_cap_rank, got.total_volume) == (1, 3, 9007199254740993)
    assert (got.circulating_supply, got.max_supply, got.high_24h) == (1000.0, None, None)


def test_validation_edges(spark):
    bad = [{"current_price": "0"}, {"current_price": None}, {"market_cap": "0"}, {"market_cap": None},
           {"total_volume": "-1"}, {"total_volume": None}, {"coin_id": None}, {"symbol": None}]
    df = raw(spark, {**BASE, "total_volume": "0"}, *[{**BASE, "crawl_time": f"2024-03-01T1{i}:30:00", **b}
                                                    for i, b in enumerate(bad)])
    typed = clean.coerce_measures(df)
    assert clean.validate(typed).count() == 1
    assert clean.rejects(typed).count() == len(bad)


def test_clean_schema_and_calendar(spark):
    df = clean.clean_ticks(raw(spark, {**BASE, "crawl_time": "2025-12-29T23:15:00"}))
    assert df.columns == list(CLEAN_COLUMNS)
    row = df.first()
    assert (row.date, row.hour, row.day_of_week, row.week_of_year, row.year) == (dt.date(2025, 12, 29), 23, 2, 1, 2025)


def test_iso_year(spark):
    df = spark.createDataFrame([(dt.date(2025, 12, 29),), (dt.date(2021, 1, 1),)], "d date")
    assert [r[0] for r in df.select(iso_week_year("d")).collect()] == [2026, 2020]


def test_offsets_become_utc(spark):
    df = spark.createDataFrame([("2024-01-01T02:00:00+07:00",), ("2024-01-01T02:00:00Z",), ("junk",)], "t string")
    got = [r[0] for r in df.select(instant("t").cast("string")).collect()]
    assert got == ["2023-12-31 19:00:00", "2024-01-01 02:00:00", None]


def test_window_is_half_open(spark, tick_frame):
    df = clean.with_event_time(tick_frame([("a", f"2024-01-01T0{h}:00:00", 1.0, 1) for h in range(4)]))
    ts = [F.lit(f"2024-01-01 0{h}:00:00").cast("timestamp") for h in range(4)]
    got = clean.incremental_window(df, ts[0], ts[2])
    assert rows(got, "crawl_time") == [("2024-01-01T01:00:00",), ("2024-01-01T02:00:00",)]


def test_quality_report(spark):
    df = raw(spark, BASE, {**BASE, "last_updated": "2024-03-01T09:00:00Z"},
             {**BASE, "coin_id": "eth", "current_price": "-1"}, {**BASE, "crawl_time": "2024-03-01T11:00:00"})
    got = clean.quality_report(df).first().asDict()
    assert got == {"raw_records": 4, "duplicates_removed": 1, "invalid_removed": 1, "clean_records": 2,
                   "quality_pct": 50.0, "partitions": 2}
