"""Starting the streaming queries over one message feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tickmart.operators.alerts import as_keyed_json
from tickmart.streaming import stages
from tickmart.streaming.feeds import StreamSink, start

#: Output name -> (transformation of the messages, output mode, key of the JSON form).
OUTPUTS = {
    "clean": (lambda m: stages.clean_messages(stages.unique_ticks(stages.parse_ticks(m))), "append", None),
    "rejects": (stages.rejected_messages, "append", None),
    "alerts": (lambda m: stages.alert_stream(stages.unique_ticks(stages.parse_ticks(m))), "append", "coin_id"),
    "sentiment": (lambda m: stages.sentiment_stream(stages.parse_ticks(m)), "update", "window_start"),
    "latest_prices": (lambda m: stages.latest_price_stream(stages.parse_ticks(m)), "update", "coin_id"),
    "monitor": (lambda m: stages.monitor_rows(stages.parse_ticks(m)), "append", None),
    "whale_days": (lambda m: stages.whale_day_stream(stages.parse_ticks(m)), "append", "coin_id"),
    "whale": (None, "append", "coin_id"),  # needs the stored baseline, see run_outputs
}
LANDING_TRIGGER = {"processingTime": "1 minute"}


def run_outputs(messages: DataFrame, sinks: dict[str, StreamSink], checkpoint_root: str,
                trigger: dict | None = None, as_json: tuple[str, ...] = (),
                baseline: DataFrame | None = None) -> list[StreamingQuery]:
    """Start one query per given sink, each with its own checkpoint.

    Outputs named in ``as_json`` are sent as key and JSON value, the form a topic needs. ``whale`` compares with
    ``baseline``, the stored usual volume per coin.
    """
    queries = []
    for name, sink in sinks.items():
        transform, mode, key = OUTPUTS[name]
        if name == "whale":
            if baseline is None:
                raise ValueError("the whale output needs the stored volume baseline")
            df = stages.whale_stream(stages.parse_ticks(messages), baseline)
        else:
            df = transform(messages)
        if name in as_json and key:
            df = as_keyed_json(df, key)
        queries.append(sink(df, name, mode, f"{checkpoint_root.rstrip('/')}/{name}", trigger or {}))
    return queries


def serve_messages(alert_messages: DataFrame, sentiment_messages: DataFrame, sinks: dict[str, StreamSink],
                   checkpoint_root: str, trigger: dict | None = None) -> list[StreamingQuery]:
    """Take alerts and sentiment off their topics into the document stores, by default every 5 seconds."""
    frames = {"alerts": stages.read_alerts(alert_messages), "sentiment": stages.read_sentiment(sentiment_messages)}
    trigger = trigger or {"processingTime": "5 seconds"}
    return [sinks[n](df, f"serve_{n}", "append", f"{checkpoint_root.rstrip('/')}/serve_{n}", trigger)
            for n, df in frames.items()]


def land_raw(messages: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Write messages as lines below ``dt=/hr=`` folders, by default once a minute, which bounds the number of files.
    ``availableNow`` gives the bounded form."""
    return start(stages.landing_rows(messages), "land_raw", "append", checkpoint, trigger or LANDING_TRIGGER,
                 lambda w: w.format("text").partitionBy("dt", "hr").option("path", path))


def await_any(queries: list[StreamingQuery]) -> None:
    """Block until one query ends, then stop the others."""
    SparkSession.active().streams.awaitAnyTermination()
    for q in queries:
        q.stop()
