"""Session factory: the settings that every batch and streaming job here assumes."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: State of streams lies in RocksDB, beyond an executor's memory, and checkpoints hold what has changed.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
SETTINGS = STATE | {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.multipleWatermarkPolicy": "min",
    "spark.ui.showConsoleProgress": "false",
}


@contextmanager
def state_beyond_memory(spark: SparkSession) -> Iterator[None]:
    """Queries that start in here keep their state as STATE says, whatever the session was built with; a checkpoint remembers it."""
    before = {k: spark.conf.get(k, None) for k in STATE}
    for k, v in STATE.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def build_session(app: str = "eventloom", master: str | None = None, **extra: str) -> SparkSession:
    """A session with UTC time and adaptive execution; extra settings use __ for dots."""
    builder = SparkSession.builder.appName(app).config(map=SETTINGS)
    if master:
        builder = builder.master(master)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
