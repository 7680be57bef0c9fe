"""Reading the raw landing area and single snapshots."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickmart.functions.calendar import instant
from tickmart.schemas import raw_schema
from tickmart.sources.partitions import partition_values, read_folders


def raw_ticks(spark: SparkSession, path: str, since: dt.date | None = None,
              until: dt.date | None = None) -> DataFrame:
    """Line-delimited JSON below ``dt=/hr=`` folders, with a fixed schema.

    ``since``/``until`` choose the ``dt`` folders to open. They are widened by a day, because a
    folder is named after the date as written in the message while event time is UTC.
    """
    day = dt.timedelta(days=1)
    low = str(since - day) if since else ""
    high = str(until + day) if until else "~"
    days = [f"dt={d}" for d in partition_values(spark, path, "dt") if low <= d <= high]
    return read_folders(spark, path, days, raw_schema(), "json").drop("dt", "hr")


def ticks_in_folders(spark: SparkSession, path: str, days: list[str]) -> DataFrame:
    """Raw ticks of the named ``dt`` folders; names without a folder are skipped."""
    there = set(partition_values(spark, path, "dt"))
    return read_folders(spark, path, [f"dt={d}" for d in days if d in there], raw_schema(), "json").drop("dt", "hr")


def arriving_ticks(spark: SparkSession, path: str, max_age: str = "365d") -> DataFrame:
    """Raw ticks as a stream of files with ``dt``, the folder that a row was landed in.

    The stream's checkpoint remembers the files; one that arrives late is new however old its folder is. Only a file
    whose own time of writing lies more than ``max_age`` behind the newest file's is passed over, which bounds what
    has to be remembered.
    """
    rows = (spark.readStream.schema(raw_schema()).option("recursiveFileLookup", "true").option("maxFileAge", max_age)
            .json(path))
    return rows.select("*", F.regexp_extract(F.col("_metadata.file_path"), "/dt=([^/]+)/", 1).alias("dt"))


def write_snapshot(ticks: DataFrame, path: str) -> None:
    """One snapshot as JSON lines, the form of the landing folders; ``snapshot_file`` reads arrays of other writers."""
    ticks.write.mode("overwrite").json(path)


def snapshot_file(spark: SparkSession, path: str) -> DataFrame:
    """Pretty-printed JSON arrays of ticks, one array per file; each file is read by one task."""
    return spark.read.schema(raw_schema()).option("multiLine", True).json(path)


def landing_folder(crawl_time: str = "crawl_time", fake_date: str = "fake_date") -> dict[str, Column]:
    """Folder columns ``dt`` and ``hr`` of a message; both null when it cannot be placed.

    A given ``fake_date`` names the day; otherwise date and hour are those written in the crawl
    time. With a fake date an unreadable crawl time means hour 00.
    """
    stamp, fake = F.col(crawl_time), F.col(fake_date)
    readable = instant(stamp).isNotNull() & stamp.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}.*)?$")
    has_fake = F.length(fake) > 0
    hour = F.when(readable, F.rpad(F.substring(stamp, 12, 2), 2, "0"))
    return {"dt": F.when(has_fake, fake).when(readable, F.substring(stamp, 1, 10)),
            "hr": F.when(has_fake, F.coalesce(hour, F.lit("00"))).otherwise(hour)}


def routed(messages: DataFrame) -> DataFrame:
    """Messages with their folder columns; those that cannot be placed are dropped."""
    return messages.withColumns(landing_folder()).where("dt IS NOT NULL AND hr IS NOT NULL")
