"""Running a stored table through a streaming query to its end, and reading what came out."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tickmart.session import shared_dir


def _scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder all executors reach, below the cluster's shared folder or, where none is set, below the warehouse."""
    return shared_dir(spark, f"replay/{name}-{uuid.uuid4().hex}", spark.conf.get("spark.sql.warehouse.dir"))


def table_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The files of a table as a stream. The first letter is a pattern: a stream takes patterns and folders, not one file."""
    path = f"{folder.rstrip('/')}/{name}.parquet"
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{folder.rstrip('/')}/[{name[0]}]{name[1:]}.parquet")


def replayed(stream: DataFrame, name: str) -> DataFrame:
    """What an append-mode query yields by the time it has taken everything that is there."""
    spark = stream.sparkSession
    root = _scratch(spark, name)
    query = (stream.writeStream.format("parquet").outputMode("append").option("path", f"{root}/out")
             .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/out")
