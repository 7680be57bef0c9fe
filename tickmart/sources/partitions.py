"""Opening only the needed folders of a partitioned path.

A path that grows by one folder per hour is never listed as a whole: folder names answer which days
exist, and a read names the folders it wants.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def file_system(spark: SparkSession, path: str):
    """Hadoop file system of a path, and the path as that takes it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    fs, folder = file_system(spark, path)
    return fs.exists(folder)


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of the outermost partition column, read off the folder names."""
    fs, folder = file_system(spark, path)
    if not fs.exists(folder):
        return []
    names = (status.getPath().getName() for status in fs.listStatus(folder))
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{column}="))


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Remove one folder with its files; false where there is none."""
    fs, folder = file_system(spark, path)
    return fs.delete(folder, True)


def remove_partition(spark: SparkSession, root: str, parts: list[str]) -> None:
    """Remove a partition folder below ``root``, and the folders above it that have no partition left."""
    remove_folder(spark, "/".join([root, *parts]))
    for depth in range(len(parts) - 1, 0, -1):
        above = "/".join([root, *parts[:depth]])
        if partition_values(spark, above, parts[depth].split("=", 1)[0]):
            break
        remove_folder(spark, above)


def read_folders(spark: SparkSession, path: str, folders: Iterable[str], schema: T.StructType, fmt: str) -> DataFrame:
    """Read some folders below ``path``; their partition columns are kept. No folders give an empty frame."""
    paths = [f"{path}/{f}" for f in folders]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.format(fmt).schema(schema).option("basePath", path).load(paths)
