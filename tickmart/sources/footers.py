"""Questions that Parquet footers and folder names answer, without reading a column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Parquet by the reader that hands aggregates down to the footers; set in a session of its own, the caller's stays as it is.
_PUSHED = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def records_per_date(spark: SparkSession, path: str, column: str = "date") -> DataFrame:
    """``date, records`` of a table partitioned by it, from the row counts in the footers. Folders without rows have no row."""
    session = spark.newSession()
    for key, value in _PUSHED.items():
        session.conf.set(key, value)
    counts = session.read.parquet(path).groupBy(column).agg(F.count("*").alias("records"))
    return counts.where("records > 0")


def date_bounds(spark: SparkSession, path: str, column: str = "date") -> tuple:
    """First and last date that has rows; a row a date comes to the driver at most as two values."""
    return tuple(records_per_date(spark, path, column).agg(F.min(column), F.max(column)).first())
