"""Readers and writers."""

from skylattice.sources.areas import read_area, write_by_area
from skylattice.sources.files import (
    envelope_files,
    read_airlines,
    read_silver,
    read_streamed,
    snapshot_files,
    stored_schema,
)
from skylattice.sources.kafka import kafka_envelopes, kafka_options, send_envelopes
from skylattice.sources.sinks import WriteResult, append_stream, write_table

__all__ = [
    "WriteResult",
    "append_stream",
    "envelope_files",
    "kafka_envelopes",
    "kafka_options",
    "read_airlines",
    "read_area",
    "read_silver",
    "read_streamed",
    "send_envelopes",
    "snapshot_files",
    "stored_schema",
    "write_by_area",
    "write_table",
]
