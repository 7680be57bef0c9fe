"""Session settings shared by the jobs, the tests and the benchmark."""

from __future__ import annotations

from pyspark.sql import SparkSession

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"

# Timestamps in the raw feed carry no zone and mean UTC; every calendar column depends on this.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    STATE_STORE: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def builder(app_name: str, master: str | None = None, shuffle_partitions: int | None = None,
            **conf: str) -> SparkSession.Builder:
    """A session builder. Master and shuffle width stay with spark-submit unless given."""
    out = SparkSession.builder.appName(app_name)
    if master:
        out = out.master(master)
    settings = {**SESSION_DEFAULTS, **conf}
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in settings.items():
        out = out.config(key, value)
    return out


def pin_utc(spark: SparkSession) -> SparkSession:
    """Force UTC on a session that somebody else built."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def pin_state_store(spark: SparkSession) -> SparkSession:
    """The same for the state store: ``transformWithState`` runs on RocksDB only. Queries that resume keep the store of their checkpoint."""
    if not spark.conf.get(STATE_STORE).endswith("RocksDBStateStoreProvider"):
        spark.conf.set(STATE_STORE, SESSION_DEFAULTS[STATE_STORE])
    return spark


def shared_dir(spark: SparkSession, name: str, fallback: str | None = None) -> str:
    """A folder every executor can reach, below the cluster's ``spark.checkpoint.dir``.

    ``fallback`` is used only where the setting is absent (single-machine runs and tests).
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or fallback
    if not root:
        raise ValueError("spark.checkpoint.dir is not set and no folder was given")
    return f"{root.rstrip('/')}/{name}"
