"""Structured Streaming jobs. Each starter returns its query; the caller awaits it."""

from skylattice.sources.files import read_streamed
from skylattice.streaming.jobs import compact_silver, start_bronze, start_silver
from skylattice.streaming.sessions import compact_sessions, read_sessions, start_sessions
from skylattice.streaming.versions import VersionStore
from skylattice.streaming.watermarked import (
    catch_up_sessions,
    finish,
    late_rows,
    read_closed_sessions,
    start_watermarked_sessions,
    stream_sessions,
)

__all__ = [
    "VersionStore",
    "catch_up_sessions",
    "compact_sessions",
    "compact_silver",
    "finish",
    "late_rows",
    "read_closed_sessions",
    "read_sessions",
    "read_streamed",
    "start_bronze",
    "start_sessions",
    "start_silver",
    "start_watermarked_sessions",
    "stream_sessions",
]
