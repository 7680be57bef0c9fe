"""The batch jobs: clean, aggregate, serve, export, retention and reset."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickmart.operators import alerts, clean, export, rollup, serving
from tickmart.plans import ranges
from tickmart.schemas import HOUR_STATE_DDL, clean_schema
from tickmart.sinks.state import append_rows, load_mark, read_rows, save_mark
from tickmart.sinks.stores import TableSink
from tickmart.sinks.tables import overwrite_partitions
from tickmart.sources import metric_tables
from tickmart.sources.partitions import exists, partition_values, read_folders, remove_folder, remove_partition
from tickmart.sources.raw import arriving_ticks, ticks_in_folders

RESET_DATE = dt.date(2025, 10, 1)


@dataclass(frozen=True)
class Layout:
    """Folders of one installation. Marks live beside the data, on storage all executors share."""

    root: str

    @property
    def raw(self) -> str:
        return f"{self.root}/raw"

    @property
    def clean(self) -> str:
        return f"{self.root}/clean"

    @property
    def aggregated(self) -> str:
        return f"{self.root}/aggregated"

    @property
    def serving(self) -> str:
        return f"{self.root}/serving"

    def metrics(self, table: str) -> str:
        return f"{self.aggregated}/{table}"

    def mark(self, job: str) -> str:
        return f"{self.root}/checkpoints/{job}"


def utc(moment: dt.datetime) -> dt.datetime:
    """Zone-less times mean UTC, whatever the zone of the driver's machine."""
    return moment.astimezone(dt.timezone.utc) if moment.tzinfo else moment.replace(tzinfo=dt.timezone.utc)


def from_micros(micros: int) -> dt.datetime:
    return dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(microseconds=micros)


# --- cleaning ---------------------------------------------------------------------------------

#: Which hours of event time each landing folder holds; at most one row per folder, hour and run.
_LEDGER = "dt string, hour timestamp"
#: Hours whose clean ticks changed, by cleaning run; without an hour the whole day did.
_TOUCHED = "run bigint, day date, hour int"


def _folders(hour: dt.datetime) -> list[str]:
    return [f"date={hour.date()}", f"hour={hour.hour}"]


def _as_text(hours) -> str:
    return ",".join(h.isoformat() for h in sorted(hours))


def _as_hours(text: str | None) -> set[dt.datetime]:
    return {dt.datetime.fromisoformat(h) for h in (text or "").split(",") if h}


def clean_job(spark: SparkSession, layout: Layout, now: dt.datetime | None = None) -> dict | None:
    """Clean what arrived since the last run; ``None`` when there is nothing new.

    New means new files: a bounded stream over the landing area remembers the files it has seen, so a tick is
    picked up however late it comes and in whatever folder. Work is done in whole hours: every ``date, hour``
    partition that a new file touches is rebuilt from all raw rows that belong to it; a ledger says which folders
    hold them. Hours that end up without valid ticks are removed. Rows after ``now``, if given, wait for a later
    run. The mark keeps the newest event time seen. A run that dies is simply repeated.
    """
    if not exists(spark, layout.raw):
        return None

    def note(batch: DataFrame, _: int) -> None:
        """Hours of the new files, noted before the stream forgets the files; both lists are bounded by the calendar."""
        here = batch.sparkSession
        rows = clean.with_event_time(batch).where("crawl_ts IS NOT NULL")
        found = rows.select("dt", F.date_trunc("hour", "crawl_ts").alias("hour")).distinct().collect()
        append_rows(here, layout.mark("ledger"), [tuple(r) for r in found], _LEDGER)
        save_mark(here, layout.mark("open_hours"), _as_text(_as_hours(load_mark(here, layout.mark("open_hours"))) | {r.hour for r in found}))

    (arriving_ticks(spark, layout.raw).writeStream.foreachBatch(note).option("checkpointLocation", layout.mark("seen_files"))
     .trigger(availableNow=True).start().awaitTermination())
    hours, redo = _as_hours(load_mark(spark, layout.mark("open_hours"))), load_mark(spark, layout.mark("redo"))
    ledger = read_rows(spark, layout.mark("ledger"), _LEDGER).distinct()
    if redo:
        hours |= {r.hour for r in ledger.where(F.col("hour") >= F.lit(redo).cast("timestamp")).select("hour").distinct().collect()}
    limit = None if now is None else utc(now).astimezone(dt.timezone.utc).replace(tzinfo=None)
    due = {h for h in hours if limit is None or h <= limit}
    if not due:
        return None
    report, newest = _rebuild_hours(spark, layout, sorted(due), ledger, limit)
    # An hour that has not ended by the limit may hold rows that still wait.
    waiting = {h for h in hours if limit is not None and h + dt.timedelta(hours=1) > limit and (h not in due or newest[1])}
    save_mark(spark, layout.mark("open_hours"), _as_text(waiting))
    if redo:
        save_mark(spark, layout.mark("redo"), "")
    if newest[0] is not None:
        before = load_mark(spark, layout.mark("clean"))
        moment = from_micros(newest[0])
        save_mark(spark, layout.mark("clean"), max(moment, utc(dt.datetime.fromisoformat(before))) if before else moment)
    return report


def _rebuild_hours(spark: SparkSession, layout: Layout, hours: list[dt.datetime], ledger: DataFrame,
                   limit: dt.datetime | None) -> tuple[dict, tuple]:
    """Rebuild the clean partitions of the hours; counters, and (newest event time, whether rows wait)."""
    wanted = spark.createDataFrame([(h,) for h in hours], "hour timestamp")
    folders = sorted({r.dt for r in ledger.join(wanted, "hour", "left_semi").select("dt").distinct().collect()})
    raw = clean.with_event_time(ticks_in_folders(spark, layout.raw, folders)).where("crawl_ts IS NOT NULL")
    raw = raw.withColumn("_hour", F.date_trunc("hour", "crawl_ts")).join(wanted, F.col("_hour") == F.col("hour"), "left_semi").drop("_hour")
    beyond = Observation()
    if limit is not None:
        raw = raw.observe(beyond, F.max("crawl_ts").alias("newest"))
    held = raw if limit is None else raw.where(F.col("crawl_ts") <= F.lit(limit).cast("timestamp"))
    # One pass: the counters are observed on the rows on their way to the files. They are taken behind the last shuffle, where a task
    # counts once even if an executor is lost; the newest raw time is a maximum, which a repeated task can't spoil.
    unique, counted = clean.with_calendar(clean.collapsed(held)), Observation()
    valid = F.coalesce(clean.is_valid(), F.lit(False))
    dealt = unique.hint("rebalance", "date", "hour").observe(
        counted, F.sum("copies").alias("raw"), F.count(F.lit(1)).alias("unique"), F.count_if(valid).alias("clean"),
        F.max(F.unix_micros("crawl_ts")).alias("newest"),
        F.collect_set(F.when(valid, F.date_trunc("hour", "crawl_ts"))).alias("hours"))
    overwrite_partitions(clean.clean_unique(dealt.drop("copies")), layout.clean, ["date", "hour"], dealt=True)
    counts = counted.get
    for hour in set(hours) - set(counts["hours"]):
        remove_partition(spark, layout.clean, _folders(hour))
    append_touched(spark, layout, [(h.date(), h.hour) for h in hours])
    raw_rows, clean_rows = counts["raw"] or 0, counts["clean"]
    waits = limit is not None and beyond.get["newest"] is not None and beyond.get["newest"].replace(tzinfo=None) > limit
    return {"raw": raw_rows, "duplicates": raw_rows - counts["unique"], "invalid": counts["unique"] - clean_rows, "clean": clean_rows,
            "quality_pct": round(clean_rows / raw_rows * 100, 2) if raw_rows else None,
            "partitions": len(counts["hours"])}, (counts["newest"], waits)


# --- touched days -----------------------------------------------------------------------------

def append_touched(spark: SparkSession, layout: Layout, hours: list[tuple[dt.date, int | None]]) -> None:
    """Note hours for the jobs behind the clean table, each of which keeps its own mark."""
    last = read_rows(spark, layout.mark("touched"), _TOUCHED).agg(F.max("run")).first()[0]
    run = 0 if last is None else last + 1
    append_rows(spark, layout.mark("touched"), [(run, d, h) for d, h in sorted(set(hours), key=str)], _TOUCHED)


def touched_hours(spark: SparkSession, layout: Layout, job: str) -> tuple[dict[dt.date, set[int | None]], int | None]:
    """Days and hours touched since the job's last run, and the run to mark when they are done; bounded by the calendar."""
    mark = load_mark(spark, layout.mark(job))
    rows = read_rows(spark, layout.mark("touched"), _TOUCHED).where(F.col("run") > (int(mark) if mark else -1))
    found = rows.groupBy("day", "hour").agg(F.max("run").alias("run")).collect()
    days: dict[dt.date, set[int | None]] = {}
    for r in found:
        days.setdefault(r.day, set()).add(r.hour)
    return days, max((r.run for r in found), default=None)


def touched_days(spark: SparkSession, layout: Layout, job: str) -> tuple[list[dt.date], int | None]:
    hours, run = touched_hours(spark, layout, job)
    return sorted(hours), run


# --- aggregation ------------------------------------------------------------------------------

def clean_days(spark: SparkSession, layout: Layout, days) -> DataFrame:
    """Clean ticks of the given days."""
    there = set(partition_values(spark, layout.clean, "date"))
    return read_folders(spark, layout.clean, [f"date={d}" for d in sorted(days) if str(d) in there], clean_schema(), "parquet")


def metric_table(spark: SparkSession, layout: Layout, table: str) -> DataFrame | None:
    return metric_tables.from_files(spark, layout.aggregated, table) if exists(spark, layout.metrics(table)) else None


def _rewrite(spark: SparkSession, df: DataFrame, path: str, keys: list[str], emptied: list[tuple]) -> None:
    """Replace the partitions in ``df`` and remove those that have nothing left."""
    overwrite_partitions(df, path, keys)
    for values in emptied:
        remove_partition(spark, path, [f"{k}={v}" for k, v in zip(keys, values)])


def _refresh_states(spark: SparkSession, layout: Layout, touched: dict[dt.date, set[int | None]]) -> DataFrame:
    """Hour states of the touched days, of which the touched hours are made anew from their clean ticks; other hours of a day
    are read from the ticks only if they have no state yet."""
    path, todo, gone, held = layout.metrics("hour_states"), [], [], []
    for day, hours in sorted(touched.items()):
        there = {int(h) for h in partition_values(spark, f"{layout.clean}/date={day}", "hour")}
        known = {int(h) for h in partition_values(spark, f"{path}/date={day}", "hour")}
        stale = there if None in hours else (there & hours) | (there - known)
        todo += [f"date={day}/hour={h}" for h in sorted(stale)]
        gone += [(day, h) for h in sorted(known - there)]
        held += [f"date={day}/hour={h}" for h in sorted(there)]
    ticks = read_folders(spark, layout.clean, todo, clean_schema(), "parquet")
    _rewrite(spark, rollup.tick_states(ticks, ["date", "hour"]), path, ["date", "hour"], gone)
    return read_folders(spark, path, held, T.StructType.fromDDL(HOUR_STATE_DDL), "parquet")


def aggregate_job(spark: SparkSession, layout: Layout) -> tuple[dt.date, dt.date] | None:
    """Bring the daily, weekly and monthly rows up to the hours touched since the last run; ``None`` without any.

    Every hour has a stored state per coin. Only touched hours are read again from the clean table; days are
    merged from the states of their hours, weeks and months from their daily rows. Returns the first and last day.
    """
    hours, run = touched_hours(spark, layout, "aggregate")
    if not hours:
        return None
    touched = sorted(hours)
    existing = {dt.date.fromisoformat(d) for d in partition_values(spark, layout.clean, "date")}
    states = rollup.merged_states(_refresh_states(spark, layout, hours), ["date"])
    daily = rollup.day_metrics(rollup.ohlc_of_states(states)).withColumn("day", F.dayofmonth("date"))
    _rewrite(spark, daily, layout.metrics("daily_metrics"), ["year", "month", "day"],
             [(d.year, d.month, d.day) for d in touched if d not in existing])

    weeks, months = sorted({ranges.week_key(d) for d in touched}), sorted({(d.year, d.month) for d in touched})
    days = metric_table(spark, layout, "daily_metrics")
    if days is not None:
        of_weeks = days.where(ranges.in_pairs("year", "month", ranges.months_of_weeks(weeks))
                              & ranges.in_pairs("year", "week_of_year", weeks))
        _rewrite(spark, rollup.weekly_metrics(of_weeks), layout.metrics("weekly_metrics"), ["year", "week_of_year"],
                 sorted(set(weeks) - {ranges.week_key(d) for d in existing}))
        of_months = days.where(ranges.in_pairs("year", "month", months))
        _rewrite(spark, rollup.monthly_metrics(of_months), layout.metrics("monthly_metrics"), ["year", "month"],
                 sorted(set(months) - {(d.year, d.month) for d in existing}))
    save_mark(spark, layout.mark("aggregate"), run)
    return touched[0], touched[-1]


# --- serving tables ---------------------------------------------------------------------------

def _current(spark: SparkSession, layout: Layout, table: str) -> DataFrame | None:
    """The table's current version; versions are whole, so a reader never sees half of one."""
    version = load_mark(spark, layout.mark(f"version_{table}"))
    return None if version is None else spark.read.parquet(f"{layout.serving}/{table}/version={version}")


def _replace(spark: SparkSession, layout: Layout, table: str, df: DataFrame) -> None:
    """Write a new version and make it known; the one before the last is removed."""
    before = load_mark(spark, layout.mark(f"version_{table}"))
    version = int(before) + 1 if before else 0
    df.write.mode("overwrite").parquet(f"{layout.serving}/{table}/version={version}")
    save_mark(spark, layout.mark(f"version_{table}"), version)
    remove_folder(spark, f"{layout.serving}/{table}/version={version - 2}")


def serving_table(spark: SparkSession, layout: Layout, table: str) -> DataFrame | None:
    """A stored serving table: ``latest``, ``volume_baseline``, ``history`` or ``alerts``."""
    if table in ("latest", "volume_baseline"):
        return _current(spark, layout, table)
    path = f"{layout.serving}/{table}"
    return spark.read.parquet(path).drop("day") if partition_values(spark, path, "day") else None


def serve_job(spark: SparkSession, layout: Layout) -> tuple[dt.date, dt.date] | None:
    """Bring the serving tables up to the days touched since the last run; ``None`` without any.

    ``history`` and ``alerts`` are replaced by day. A day's volumes are the baseline of the seven days after it, so
    whale alerts of these are done again too. ``latest`` folds one row per coin and day, and ``volume_baseline`` reads
    the last days only; both are small and written whole. Run it after the aggregation.
    """
    touched, run = touched_days(spark, layout, "serve")
    daily = metric_table(spark, layout, "daily_metrics")
    if not touched or daily is None:
        return None
    existing = {dt.date.fromisoformat(d) for d in partition_values(spark, layout.clean, "date")}
    days = sorted({d + n * ranges.DAY for d in touched for n in range(8)} & (existing | set(touched)))
    of = lambda chosen: ranges.in_pairs("year", "month", sorted({(d.year, d.month) for d in chosen})) & F.col("date").isin(chosen)

    history = serving.history_table(daily.where(of(touched))).withColumn("day", F.col("date"))
    _rewrite(spark, history, f"{layout.serving}/history", ["day"], [(d,) for d in touched if d not in existing])

    around = sorted({d - n * ranges.DAY for d in days for n in range(8)})
    whales = alerts.whale_alert_records(daily.where(of(around))).where(F.to_date("detected_at").isin(days))
    ticks = clean_days(spark, layout, days).withColumn("crawl_ts", F.col("crawl_ts").cast("timestamp_ntz"))
    records = alerts.price_alert_records(ticks).unionByName(whales).withColumn("day", F.to_date("detected_at"))
    had = set(partition_values(spark, f"{layout.serving}/alerts", "day"))
    _rewrite(spark, records, f"{layout.serving}/alerts", ["day"], [(d,) for d in days if str(d) in had and d not in existing])

    last_ticks = serving.latest_per_coin(clean_days(spark, layout, touched), "date")
    _rewrite(spark, last_ticks, f"{layout.serving}/last_ticks", ["date"], [(d,) for d in touched if d not in existing])
    if existing:
        _replace(spark, layout, "latest", serving.latest_snapshot(spark.read.parquet(f"{layout.serving}/last_ticks")))
        recent = [max(existing) - n * ranges.DAY for n in range(31)]
        _replace(spark, layout, "volume_baseline", alerts.usual_volume(daily.where(of(recent))))
    save_mark(spark, layout.mark("serve"), run)
    return touched[0], touched[-1]


# --- export, retention, reset -----------------------------------------------------------------

def export_job(spark: SparkSession, layout: Layout, relational: TableSink | None = None,
               document: TableSink | None = None) -> None:
    """Send the metric tables, and to the document store also the stored serving tables."""
    for table in export.DATE_COLUMNS:
        metrics = metric_table(spark, layout, table)
        if metrics is None:
            continue
        if relational:
            relational(export.relational_rows(metrics, table), table)
        if document:
            document(export.documents(metrics, table), table)
    for table, key in export.SERVING_KEYS.items():
        rows = serving_table(spark, layout, table) if document else None
        if rows is not None:
            document(export.serving_documents(rows, key), table)


def expired_dates(spark: SparkSession, table: str, as_of: dt.date, days: int = 30) -> list[dt.date]:
    """Dates of a ``date``-partitioned table that are older than the retention, read off the folder names."""
    names = (dt.date.fromisoformat(d) for d in partition_values(spark, table, "date"))
    return [d for d in names if d < as_of - days * ranges.DAY]


def retain_job(spark: SparkSession, table: str, as_of: dt.date, days: int = 30, dry_run: bool = True) -> list[dt.date]:
    """Remove the folders of expired dates below ``table``, or only list them."""
    gone = expired_dates(spark, table, as_of, days)
    if not dry_run:
        for date in gone:
            remove_folder(spark, f"{table}/date={date}")
    return gone


def reset_job(spark: SparkSession, layout: Layout, date: dt.date = RESET_DATE) -> None:
    """Make the jobs do everything from the given day again: cleaning by its ledger, the others by the clean table."""
    save_mark(spark, layout.mark("redo"), date)
    days = {dt.date.fromisoformat(d) for d in partition_values(spark, layout.clean, "date")}
    append_touched(spark, layout, [(d, None) for d in days if d >= date])
