"""Session set-up helpers; a caller may as well bring its own session."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Settings the jobs are designed for. None is needed for right results. A cluster must also
#: name a folder that all executors share in ``spark.checkpoint.dir``; jobs refuse without.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
    # Streams: state on local disk instead of the heap, uploaded as changes.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Session windows of a busy aircraft are merged before they are shuffled.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def build_session(
    app_name: str,
    shuffle_partitions: int | None = None,
    timezone: str = "UTC",
    **extra: str,
) -> SparkSession:
    """A session with the recommended settings.

    ``shuffle_partitions`` is the starting width that AQE shrinks in batch jobs;
    for a stateful stream it is fixed by the first run of its checkpoint.
    """
    builder = SparkSession.builder.appName(app_name)
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.session.timeZone", timezone)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in extra.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def session_zone(spark: SparkSession, timezone: str) -> Iterator[None]:
    """Run a job in a time zone and give the session its own zone back."""
    key = "spark.sql.session.timeZone"
    before = spark.conf.get(key)
    spark.conf.set(key, timezone)
    try:
        yield
    finally:
        spark.conf.set(key, before)
