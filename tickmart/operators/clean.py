"""Raw ticks to clean ticks: deduplicate, coerce, validate, add calendar columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickmart.functions.calendar import as_column, calendar_parts, instant
from tickmart.schemas import CLEAN_COLUMNS, MEASURES, typed_or_null


def with_event_time(df: DataFrame) -> DataFrame:
    """Add ``crawl_ts`` parsed from the ``crawl_time`` text where it is not there yet."""
    return df if "crawl_ts" in df.columns else df.withColumn("crawl_ts", instant("crawl_time"))


def tick_key(df: DataFrame) -> list[str]:
    return ["coin_id", "crawl_time" if "crawl_time" in df.columns else "crawl_ts"]


def collapse(df: DataFrame, keys: Sequence[str | Column], latest_by: str, *extra: Column) -> DataFrame:
    """One row per key, the most recently updated one, with ``extra`` aggregates over the copies.

    The greatest struct wins: null update times lose, and all other columns break ties, so a retried
    task picks the same row. It is an aggregate with a map-side step: of a key with billions of
    copies only one row per map task is shuffled, and no task has to hold a key's copies.
    """
    grouped = [k for k in keys if isinstance(k, str)]
    payload = [latest_by, *[c for c in df.columns if c not in grouped and c != latest_by]]
    picked = df.groupBy(*keys).agg(F.max(F.struct(*payload)).alias("_row"), *extra)
    return picked.select(*grouped, "_row.*", *[c for c in picked.columns if c not in df.columns and c != "_row"])


def dedup_latest(df: DataFrame, keys: Sequence[str | Column] | None = None,
                 latest_by: str = "last_updated") -> DataFrame:
    """Keep the most recently updated row of each key."""
    return collapse(df, list(keys or tick_key(df)), latest_by).select(*df.columns)


def dedup_hourly(df: DataFrame) -> DataFrame:
    """Coarser rule: the last tick of each coin and hour."""
    return dedup_latest(df, ["coin_id", F.date_trunc("hour", "crawl_ts").alias("_hour")], latest_by="crawl_ts")


def coerce(column: str, source: T.DataType, target: str) -> Column:
    """Cast one measure; what does not parse becomes null.

    Integers go through a wide decimal, which truncates ``1.9`` and keeps every digit of large values.
    """
    value = F.col(column)
    if source.simpleString() == target:
        return value
    if target in ("bigint", "int") and not isinstance(source, T.IntegralType):
        value = value.try_cast("decimal(38,9)")
    return value.try_cast(target)


def coerce_measures(df: DataFrame) -> DataFrame:
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({c: coerce(c, types[c], t) for c, t in MEASURES.items() if c in types})


def with_calendar(df: DataFrame) -> DataFrame:
    return df.withColumns(calendar_parts("crawl_ts"))


def is_valid() -> Column:
    """A usable tick: positive price and capitalisation, non-negative volume, identified coin."""
    return ((F.col("current_price") > 0) & (F.col("market_cap") > 0) & (F.col("total_volume") >= 0)
            & F.col("coin_id").isNotNull() & F.col("symbol").isNotNull())


def validate(df: DataFrame) -> DataFrame:
    return df.where(is_valid())


def rejects(df: DataFrame) -> DataFrame:
    return df.where(~F.coalesce(is_valid(), F.lit(False)))


def slim(df: DataFrame) -> DataFrame:
    """Typed measures and only the columns that cleaning uses: what the deduplication has to shuffle.

    Typing first does not change which copy wins, only its width on the wire.
    """
    typed = coerce_measures(with_event_time(df))
    return typed.select(*[c for c in typed.columns if c in CLEAN_COLUMNS or c == "crawl_time"])


def collapsed(df: DataFrame) -> DataFrame:
    """Ticks without copies, as ``slim`` makes them, with the number of ``copies`` that each stands for."""
    df = slim(df)
    return collapse(df, tick_key(df), "last_updated", F.count("*").alias("copies"))


def clean_unique(unique: DataFrame) -> DataFrame:
    """Validate and complete ticks that have no copies left, in the column order of the clean table."""
    clean = with_calendar(validate(unique))
    return clean.select(*typed_or_null(clean, CLEAN_COLUMNS))


def clean_ticks(df: DataFrame) -> DataFrame:
    """The whole cleaning chain. Duplicates go before validation: a newer invalid copy hides an older one."""
    return clean_unique(dedup_latest(slim(df)))


def incremental_window(df: DataFrame, after, until, column: str = "crawl_ts") -> DataFrame:
    """Rows of the half-open event-time interval ``(after, until]``."""
    ts = F.col(column)
    return df.where((ts > as_column(after)) & (ts <= as_column(until)))


def quality_report(df: DataFrame) -> DataFrame:
    """One row of cleaning counters from a single pass over the raw ticks.

    Copies are counted while they are collapsed: the per-key row carries how many there were, so
    neither the scan nor the shuffle is repeated per counter.
    """
    typed = collapsed(df).withColumn("valid", F.coalesce(is_valid(), F.lit(False)))
    per_partition = (
        typed.groupBy(F.to_date("crawl_ts").alias("date"), F.hour("crawl_ts").alias("hour"))
        .agg(F.sum("copies").alias("raw"), F.count("*").alias("unique"),
             F.count_if("valid").alias("clean"))
    )
    return (
        per_partition.agg(F.sum("raw").alias("raw_records"), F.sum("unique").alias("unique_records"),
                          F.sum("clean").alias("clean_records"),
                          F.count_if(F.col("clean") > 0).alias("partitions"))
        .select(
            "raw_records",
            (F.col("raw_records") - F.col("unique_records")).alias("duplicates_removed"),
            (F.col("unique_records") - F.col("clean_records")).alias("invalid_removed"),
            "clean_records",
            F.round(F.try_divide("clean_records", "raw_records") * 100, 2).alias("quality_pct"),
            "partitions",
        )
    )


def affected_partitions(df: DataFrame, keys: Sequence[str] = ("date", "hour")) -> DataFrame:
    return df.select(*keys).distinct()
