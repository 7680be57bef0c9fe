"""Numbering rows that are alike, without gathering them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickmart.llm.scratch import stored


def numbered(rows: DataFrame, key: str) -> DataFrame:
    """Rows with ``copy``, which counts those of one key from 0. Keys are not null.

    Only rows whose key comes again are numbered at all. They are counted within the partitions they lie in and
    each partition starts where the one before ends, so the numbers of a key are 0 to n - 1 however its rows are spread, and a key
    with a third of all rows is never in one task.
    """
    again = stored(rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").select(key), "repeated")
    if again.isEmpty():
        return rows.withColumn("copy", F.lit(0).cast("long"))
    repeats = stored(rows.join(again, key, "left_semi").withColumn("_part", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id()), "copies")
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = repeats.groupBy(key, "_part").agg(F.count("*").alias("_n")).select(key, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy(key, "_part").orderBy("_row")) - 1
    counted = repeats.withColumn("_inside", inside).join(offsets, [key, "_part"]).withColumn("copy", F.col("_before") + F.col("_inside"))
    return rows.join(again, key, "left_anti").withColumn("copy", F.lit(0).cast("long")).unionByName(counted.select(*rows.columns, "copy"))
