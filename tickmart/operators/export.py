"""Projections of the metric tables for the relational and the document store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickmart.functions.calendar import iso_text

#: Per table: its date columns, first the one that stamps the row.
DATE_COLUMNS = {
    "daily_metrics": ["date"],
    "weekly_metrics": ["week_start_date", "week_end_date"],
    "monthly_metrics": ["month_start_date", "month_end_date"],
}

#: Per stored serving table: the columns that make a document's id.
SERVING_KEYS = {"latest": ["symbol"], "history": ["symbol", "date"], "alerts": ["symbol", "alert_type", "detected_at"]}


def serving_documents(rows: DataFrame, key: list[str]) -> DataFrame:
    """Serving rows with a document id; times and dates as ISO text."""
    text = {c: F.col(c).cast("string") for c, kind in rows.dtypes if kind.startswith(("date", "timestamp"))}
    return rows.withColumns(text).withColumn("doc_id", F.concat_ws("_", *[F.col(k).cast("string") for k in key]))


def relational_rows(metrics: DataFrame, table: str) -> DataFrame:
    """Dates as text; the partition helper ``day`` is left out."""
    dates = {c: F.col(c).cast("string") for c in DATE_COLUMNS[table]}
    return metrics.drop("day").withColumns(dates)


def documents(metrics: DataFrame, table: str, legacy_week_id: bool = False) -> DataFrame:
    """Rows with an ISO ``@timestamp`` and a document id.

    Weekly ids carry the year; ``legacy_week_id`` leaves it out, which lets years overwrite each other.
    """
    dates = DATE_COLUMNS[table]
    out = metrics.drop("day").withColumns({"@timestamp": iso_text(dates[0]), **{c: iso_text(c) for c in dates}})
    if table == "weekly_metrics":
        parts = ["week_of_year"] if legacy_week_id else ["year", "week_of_year"]
    else:
        parts = dates[:1]
    return out.withColumn("doc_id", F.concat_ws("_", "coin_id", *[F.col(p).cast("string") for p in parts]))
