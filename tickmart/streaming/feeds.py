"""Message sources and sinks of the streaming queries."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickmart.operators.merge import realtime_doc_id
from tickmart.sinks.state import load_mark, save_mark
from tickmart.sinks.stores import DocumentStore

# Default topics.
RAW_TOPIC, CLEAN_TOPIC, ALERT_TOPIC, SENTIMENT_TOPIC = "crypto-raw", "clean_crypto", "alerts", "market_sentiment"

#: (frame, name, output mode, checkpoint folder, trigger arguments) -> running query
StreamSink = Callable[[DataFrame, str, str, str, dict], StreamingQuery]


def kafka_feed(spark: SparkSession, servers: str, topic: str = RAW_TOPIC, starting: str = "latest",
               max_offsets: int | None = None, fail_on_data_loss: bool = True) -> DataFrame:
    """Messages of a topic. The connector package must be on the session's class path. Offsets that expired unread
    end the query unless ``fail_on_data_loss`` is off."""
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic).option("startingOffsets", starting).option("failOnDataLoss", str(fail_on_data_loss).lower()))
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load()


def file_feed(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Messages from text files, one per line; stands in for a topic."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def start(df: DataFrame, name: str, mode: str, checkpoint: str, trigger: dict, configure) -> StreamingQuery:
    writer = df.writeStream.queryName(name).outputMode(mode).option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return configure(writer).start()


def kafka_sink(servers: str, topic: str) -> StreamSink:
    """Key and value columns to a topic."""
    def run(df, name, mode, checkpoint, trigger):
        return start(df, name, mode, checkpoint, trigger, lambda w: w.format("kafka")
                     .option("kafka.bootstrap.servers", servers).option("topic", topic))

    return run


def console_sink(rows: int = 20) -> StreamSink:
    def run(df, name, mode, checkpoint, trigger):
        return start(df, name, mode, checkpoint, trigger,
                     lambda w: w.format("console").option("truncate", False).option("numRows", rows))

    return run


def json_sink(path: str) -> StreamSink:
    """Append-only files with exactly-once delivery."""
    def run(df, name, mode, checkpoint, trigger):
        return start(df, name, mode, checkpoint, trigger, lambda w: w.format("json").option("path", path))

    return run


def writer_of(spark: SparkSession, checkpoint: str) -> str:
    """A name for the query behind a checkpoint, kept inside it: a fresh checkpoint is another writer."""
    mark = f"{checkpoint.rstrip('/')}/writer"
    name = load_mark(spark, mark)
    if name is None:
        name = uuid.uuid4().hex
        save_mark(spark, mark, name)
    return name


def upsert_sink(root: str) -> StreamSink:
    """Upsert every micro-batch into a document store; a repeated batch changes nothing."""
    def run(df, name, mode, checkpoint, trigger):
        writer = writer_of(df.sparkSession, checkpoint)

        def write(batch: DataFrame, batch_id: int) -> None:
            have = set(batch.columns)
            ids = batch.withColumns({c: F.lit(None).cast("string")
                                     for c in ("coin_id", "window_start", "alert_time", "crawl_time") if c not in have})
            DocumentStore(batch.sparkSession, root).upsert(ids.withColumn("doc_id", realtime_doc_id()).select("doc_id", *batch.columns), batch_id, writer)

        return start(df, name, mode, checkpoint, trigger, lambda w: w.foreachBatch(write))

    return run
