"""Bounds and counts of a partitioned table come from its footers."""

import datetime as dt

from frames import rows
from pyspark.sql import functions as F

from tickmart.operators import rollup
from tickmart.sources import footers


def test_bounds_without_reading_a_column(spark, tmp_path):
    path = str(tmp_path / "clean")
    days = spark.range(60).select(F.expr("date_add(DATE'2024-01-03', cast(id % 5 as int))").alias("date"), F.col("id").alias("price"))
    days.write.partitionBy("date").parquet(path)
    for empty in ("2023-12-01", "2024-02-01"):  # files without rows
        days.limit(0).drop("date").coalesce(1).write.parquet(f"{path}/date={empty}")
    found = footers.records_per_date(spark, path)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in text and "PushedGroupBy: [date]" in text and "price" not in text
    stored = spark.read.parquet(path)
    assert rows(found) == rows(rollup.records_per_date(stored))
    assert footers.date_bounds(spark, path) == tuple(rollup.date_bounds(stored).first()) == (dt.date(2024, 1, 3), dt.date(2024, 1, 7))
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""
