"""Combining tables: keyed upsert, batch and speed layer, gap filling, retention, ledger."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tickmart.functions.calendar import days_before


def upsert_by_id(current: DataFrame, updates: DataFrame, key: str = "doc_id",
                 version: str = "version") -> DataFrame:
    """Current documents with the updates applied: per id the row of the highest version stays."""
    return newest_by_id(current.unionByName(updates, allowMissingColumns=True), key, version)


def newest_by_id(rows: DataFrame, key: str, version: str) -> DataFrame:
    """One row per id. Copies of an id collapse before the shuffle."""
    payload = [c for c in rows.columns if c not in (key, version)]
    picked = rows.groupBy(key).agg(F.max(F.struct(version, *payload)).alias("_row"))
    return picked.select(key, "_row.*").select(*rows.columns)


def realtime_doc_id() -> Column:
    """Id of a streamed document: its window, else coin and alert time, else coin and crawl time."""
    coin = F.coalesce("coin_id", F.lit("unknown"))

    def text(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(""))

    return (F.when(F.col("window_start").isNotNull(), text("window_start"))
            .when(F.col("alert_time").isNotNull(), F.concat_ws("_", coin, text("alert_time")))
            .otherwise(F.concat_ws("_", coin, text("crawl_time"))))


def lambda_merge(batch: DataFrame, realtime: DataFrame, keys: Sequence[str] = ("coin_id", "date")) -> DataFrame:
    """Serving view of both layers: the batch rows are the truth, the speed layer fills what they lack.

    Both layers meet in one shuffle by key; neither is read twice.
    """
    both = (batch.withColumn("layer", F.lit("batch"))
            .unionByName(realtime.withColumn("layer", F.lit("realtime"))))
    is_batch = F.col("layer") == "batch"
    covered = F.max(is_batch).over(Window.partitionBy(*keys))
    return both.withColumn("_covered", covered).where(is_batch | ~F.col("_covered")).drop("_covered")


def forward_fill(ticks: DataFrame, column: str, key: str = "coin_id", ts: str = "crawl_ts",
                 chunk: str = "hour") -> DataFrame:
    """Replace nulls by the key's previous value in time order; of rows with one time the nulls come last.

    Done per chunk of time, so a key that dominates the table is spread over many tasks: the last
    value of each chunk is an aggregate, the value carried into a chunk comes from that small
    summary, and only the rows of one chunk are ordered together.
    """
    marked = ticks.withColumn("_chunk", F.date_trunc(chunk, ts))
    ends = marked.groupBy(key, "_chunk").agg(
        F.expr(f"max_by({column}, struct({ts}, {column})) FILTER (WHERE {column} IS NOT NULL)").alias("_end"))
    earlier = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(key, "_chunk", F.last("_end", ignorenulls=True).over(earlier).alias("_carried"))
    so_far = Window.partitionBy(key, "_chunk").orderBy(ts, F.asc_nulls_last(column)).rowsBetween(Window.unboundedPreceding, 0)
    filled = F.coalesce(F.last(column, ignorenulls=True).over(so_far), F.col("_carried"))
    return (marked.join(carried, [key, "_chunk"], "left").withColumn(column, filled)
            .select(*ticks.columns))


def retain(df: DataFrame, as_of, days: int, column: str = "date") -> DataFrame:
    """Rows young enough to keep; on a table partitioned by the column this prunes partitions."""
    return df.where(F.col(column) >= days_before(as_of, days))


def unprocessed_dates(dates: DataFrame, ledger: DataFrame) -> DataFrame:
    """Dates without an entry in the ledger."""
    return dates.select("date").distinct().join(ledger.select("date"), "date", "left_anti")
