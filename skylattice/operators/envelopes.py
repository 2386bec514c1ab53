"""Wire format: one JSON envelope ``{time, states: [...]}`` per poll."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from skylattice.schemas import ENVELOPE, STATE_COLUMNS

_ALL_FIELDS = {"ignoreNullFields": "false"}


def decode_envelopes(messages: DataFrame, value_column: str = "value") -> DataFrame:
    """Envelopes (text or bytes) to one flat row per aircraft. Batch or stream.

    Parsing is permissive: a wrongly typed field becomes NULL and unknown fields
    are ignored. Malformed messages and polls without states give no rows. No
    shuffle.
    """
    parsed = F.from_json(F.col(value_column).cast("string"), ENVELOPE)
    return states_of(messages.select(parsed.alias("envelope")))


def rejected_messages(messages: DataFrame, value_column: str = "value") -> DataFrame:
    """Messages that the decoder takes no rows from: ``value`` and ``reason``. Batch or stream.

    The reasons are ``no value``, ``no envelope`` (malformed, or neither a time nor
    states in it) and ``no states``. No shuffle.
    """
    return rejects_of(parse_messages(messages, value_column))


def parse_messages(messages: DataFrame, value_column: str = "value") -> DataFrame:
    """``value`` as text and ``envelope``, for :func:`states_of` and :func:`rejects_of`."""
    text = F.col(value_column).cast("string")
    return messages.select(text.alias("value"), F.from_json(text, ENVELOPE).alias("envelope"))


def states_of(parsed: DataFrame) -> DataFrame:
    """One flat row for each state in the parsed envelopes."""
    # Exploding the bare column would let the optimizer add a filter on it, which
    # is pushed below and parses every message a second time.
    states = F.expr("explode(coalesce(states, array())) as state")
    return (
        parsed.select("envelope")
        .selectExpr("envelope.*")
        .select("time", states)
        .select("time", "state.*")
    )


def rejects_of(parsed: DataFrame) -> DataFrame:
    """The parsed messages without states, and why."""
    return parsed.selectExpr(
        "value",
        "case when value is null then 'no value'"
        " when envelope.time is null and envelope.states is null then 'no envelope'"
        " when coalesce(size(envelope.states), 0) < 1 then 'no states' end as reason",
    ).filter("reason is not null")


def encode_envelopes(
    snapshots: DataFrame, max_states: int = 5000, max_bytes: int = 900_000
) -> DataFrame:
    """Flat rows to JSON messages in column ``value``; inverse of the decoder.

    A poll becomes one message. One that is spread over several input
    partitions, or that holds more than ``max_states`` aircraft or ``max_bytes`` of
    states, becomes several messages of the same ``time``: no row is left out, decoding
    gives back the same rows, and no task ever gathers more than one message's worth of
    a poll. A message is longer than ``max_bytes`` by one state and its frame at most;
    the default stays below the usual limit of a topic, a million bytes.
    Rows are numbered inside (poll, input partition), so even a poll holding a
    large part of the data stays as spread as the input was, and the numbering
    and the gathering share one shuffle.
    """
    if max_states < 1:
        raise ValueError("max_states must be at least 1")
    if max_bytes < 1:
        raise ValueError("max_bytes must be at least 1")
    poll, message = ("time", "_part"), ("_by_count", "_by_bytes")
    within = f"partition by {', '.join(poll)} order by state.icao24, state.last_contact"
    number = f"row_number() over ({within})"
    # A message takes the states that start in the same stretch of max_bytes.
    start = f"sum(_bytes) over ({within} rows unbounded preceding) - _bytes"
    numbered = (
        snapshots.select(
            "time", F.struct(*STATE_COLUMNS).alias("state"), F.spark_partition_id().alias("_part")
        )
        .withColumn("_bytes", F.octet_length(F.to_json("state", _ALL_FIELDS)) + 1)
        .withColumns(
            {
                message[0]: F.expr(f"floor(({number} - 1) / {max_states})"),
                message[1]: F.expr(f"({start}) div {max_bytes}"),
            }
        )
    )
    return (
        numbered.groupBy(*poll, *message)
        .agg(F.collect_list("state").alias("states"))
        .select(F.to_json(F.struct("time", "states"), _ALL_FIELDS).alias("value"))
    )
