"""Writing partitioned Parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def overwrite_partitions(df: DataFrame, path: str, keys: Sequence[str], dealt: bool = False) -> None:
    """Replace exactly the partitions that occur in ``df``; the others stay as they are.

    The rebalance step gathers each partition's rows into few files, and splits a partition that is
    much larger than the rest over several tasks. A frame that is ``dealt`` has had that step.
    """
    ((df if dealt else df.hint("rebalance", *keys)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*keys).parquet(path))


def save_bucketed(df: DataFrame, table: str, key: str, order: Sequence[str], buckets: int) -> None:
    """A catalog table in buckets of ``key``, one sorted file each: work per key on it needs no shuffle.

    Windows and aggregates partitioned by the key, and joins with tables bucketed alike, read the buckets as they lie. Choose
    ``buckets`` for the size of the table; one key is one bucket's rows, so it is meant for tables with a row per key and day.
    """
    (df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key, *order).format("parquet")
     .saveAsTable(table))
