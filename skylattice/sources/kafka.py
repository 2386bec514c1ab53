"""Kafka source and sink of JSON envelopes.

The connector is a deployment setting (``spark-sql-kafka`` on the class path);
without it Spark reports that the data source is missing.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

# Topic and broker variable of the message stream.
TOPIC = "plane_data"
SERVERS_VARIABLE = "KAFKA_BOOTSTRAP_SERVERS"
DEFAULT_SERVERS = "kafka:29092"

#: Messages of one batch for each core; a message is up to about a million bytes.
OFFSETS_PER_CORE = 10_000


def kafka_options(
    servers: str | None = None,
    topic: str = TOPIC,
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    """Reader options. An offset limit keeps the first batch of a backlog bounded."""
    options = {
        "kafka.bootstrap.servers": servers or os.getenv(SERVERS_VARIABLE, DEFAULT_SERVERS),
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def kafka_envelopes(spark: SparkSession, **options) -> DataFrame:
    """Stream of messages; feed it to ``decode_envelopes``.

    Unless ``max_offsets_per_trigger`` is given, a batch takes as many messages as the
    cores the session started with work off, so the limit rises with the cluster.
    """
    options.setdefault(
        "max_offsets_per_trigger", OFFSETS_PER_CORE * spark.sparkContext.defaultParallelism
    )
    return spark.readStream.format("kafka").options(**kafka_options(**options)).load()


def send_envelopes(messages: DataFrame, servers: str | None = None, topic: str = TOPIC) -> None:
    """Write encoded envelopes (column ``value``) to the topic in one batch."""
    (
        messages.select("value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers or os.getenv(SERVERS_VARIABLE, DEFAULT_SERVERS))
        .option("topic", topic)
        .save()
    )
