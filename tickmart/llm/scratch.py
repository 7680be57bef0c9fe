"""Derived tables in the cluster's shared folder: work done once, lineage cut, safe against lost executors."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: list[str] = []


def scratch_root(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only on a local master without that setting."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return f"{root.rstrip('/')}/llm"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _local:
        _local.append(tempfile.mkdtemp(prefix="llm-"))
        atexit.register(shutil.rmtree, _local[0], ignore_errors=True)
    return _local[0]


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write a table that is read more than once and read it back."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
