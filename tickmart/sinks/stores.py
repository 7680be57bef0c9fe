"""Serving stores: relational tables and documents with upsert by id."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickmart.operators.merge import newest_by_id
from tickmart.sinks.state import append_rows, load_mark, read_rows, save_mark
from tickmart.sources.partitions import remove_folder

TableSink = Callable[[DataFrame, str], None]


def jdbc_sink(url: str, properties: dict[str, str], connections: int = 16) -> TableSink:
    """Replace the rows of a relational table. ``truncate`` keeps its keys and indexes; ``connections``
    bounds the parallel writers, whatever the size of the frame."""
    def write(df: DataFrame, table: str) -> None:
        (df.write.mode("overwrite").option("truncate", True).option("numPartitions", connections)
         .option("batchsize", 10_000).jdbc(url, table, properties=properties))

    return write


def parquet_sink(root: str) -> TableSink:
    """The same contract on files."""
    def write(df: DataFrame, table: str) -> None:
        df.write.mode("overwrite").parquet(f"{root}/{table}")

    return write


class DocumentStore:
    """Documents keyed by id, as one Parquet table in whole versions.

    A batch is one Spark job: the current version and the batch go into the next one, of each id the row written last. A mark then
    names the new version and the last batch of every writer, so a reader never sees half a version, a write that dies leaves
    the old one readable, and a batch that is repeated changes nothing. The version before the current one stays for readers
    that have it open. Every batch rewrites the store: it is for tables of serving size, with a trigger that is not too short.
    """

    def __init__(self, spark: SparkSession, root: str, key: str = "doc_id"):
        self.spark, self.root, self.key = spark, root.rstrip("/"), key

    def _state(self) -> dict:
        mark = load_mark(self.spark, f"{self.root}/state")
        return json.loads(mark) if mark else {"version": None, "done": {}}

    def _version(self, number: int) -> str:
        return f"{self.root}/version={number}"

    def upsert(self, df: DataFrame, batch_id: int, writer: str = "direct") -> dict[str, int]:
        """Write one batch; counts of accepted and rejected rows. Rows without an id go to ``rejected``."""
        state, name = self._state(), f"{writer}-{int(batch_id)}"
        if int(batch_id) <= state["done"].get(writer, -1):
            return {"accepted": 0, "rejected": 0}
        usable = F.coalesce(F.length(F.col(self.key).cast("string")) > 0, F.lit(False))
        counts = df.agg(F.count_if(usable).alias("accepted"), F.count_if(~usable).alias("rejected")).first().asDict()
        if counts["rejected"]:
            df.where(~usable).write.mode("overwrite").parquet(f"{self.root}/rejected/batch={name}")
        before = state["version"]
        number = 0 if before is None else before + 1
        rows = df.where(usable).withColumn("_order", F.lit(number).cast("bigint"))
        if before is not None:
            rows = self.spark.read.parquet(self._version(before)).unionByName(rows, allowMissingColumns=True)
        newest_by_id(rows, self.key, "_order").hint("rebalance").write.mode("overwrite").parquet(self._version(number))
        append_rows(self.spark, f"{self.root}/counts", [(name, counts["accepted"], counts["rejected"])], _COUNTS)
        save_mark(self.spark, f"{self.root}/state", json.dumps({"version": number, "done": {**state["done"], writer: int(batch_id)}}))
        remove_folder(self.spark, self._version(number - 2))
        return counts

    def counts(self) -> DataFrame:
        """Accepted and rejected rows of every written batch."""
        return read_rows(self.spark, f"{self.root}/counts", _COUNTS)

    def read(self) -> DataFrame:
        version = self._state()["version"]
        if version is None:
            raise ValueError(f"nothing was written to {self.root} yet")
        return self.spark.read.parquet(self._version(version)).drop("_order")


_COUNTS = "batch string, accepted bigint, rejected bigint"


def document_sink(spark: SparkSession, root: str) -> TableSink:
    """Upsert into one document store per table; every call is a writer of its own."""
    def write(df: DataFrame, table: str) -> None:
        DocumentStore(spark, f"{root.rstrip('/')}/{table}").upsert(df, 0, uuid.uuid4().hex)

    return write
