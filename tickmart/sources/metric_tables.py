"""Metric tables as input of the report queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickmart.schemas import METRIC_DDL
from tickmart.sources.partitions import partition_values


def from_files(spark: SparkSession, root: str, table: str) -> DataFrame:
    return spark.read.schema(METRIC_DDL[table]).parquet(f"{root.rstrip('/')}/{table}")


#: Partition folders of each table, outermost first.
PERIODS = {"daily_metrics": ["year", "month", "day"], "weekly_metrics": ["year", "week_of_year"], "monthly_metrics": ["year", "month"]}


def newest_period(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The newest day, week or month of a stored table. Folder names say which it is, so only its files are read."""
    path, folders = f"{root.rstrip('/')}/{table}", []
    for column in PERIODS[table]:
        values = partition_values(spark, "/".join([path, *folders]), column)
        if not values:
            return spark.createDataFrame([], METRIC_DDL[table])
        folders.append(f"{column}={max(values, key=int)}")
    return spark.read.schema(METRIC_DDL[table]).option("basePath", path).parquet("/".join([path, *folders]))


def from_jdbc(spark: SparkSession, url: str, table: str, properties: dict[str, str], predicates: list[str]) -> DataFrame:
    """The exported relational table, one connection per predicate (for example one per year or month).
    The predicates have to cover the table without overlap; filters and columns are pushed to the database."""
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties)
