"""Closed sessions by Spark's session window, which needs a bound on lateness."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from skylattice.functions import seconds_between
from skylattice.operators.filters import identified
from skylattice.operators.sessions import (
    DEFAULT_GAP_SECONDS,
    latest_time,
    presence_cells,
    sessions_from_cells,
    with_duration_and_day,
)
from skylattice.schemas import DAY_PARTITION, SILVER
from skylattice.scratch import list_files, list_folders
from skylattice.sources.files import snapshot_files
from skylattice.sources.sinks import DEFAULT_TRIGGER, append_stream, write_table

_CLOSED = (
    T.StructType()
    .add("icao24", T.StringType())
    .add("entry_ts", T.TimestampType())
    .add("exit_ts", T.TimestampType())
    .add("airline_name", T.StringType())
    .add("airline_icao", T.StringType())
    .add("has_exit", T.IntegerType())
    .add("duration_seconds", T.LongType())
    .add("date", T.DateType())
    .add("year", T.IntegerType())
    .add("month", T.IntegerType())
    .add("day", T.IntegerType())
)
#: Table, inside the stream's, of the sessions of the snapshots stored before it began.
_BACKLOG = "_backlog"
#: 1 for a session of the backlog that the stream may still extend, and so gives itself.
_WAITING = "waiting"


def stream_sessions(
    silver: DataFrame,
    gap_seconds: int = DEFAULT_GAP_SECONDS,
    *,
    lateness_seconds: int,
) -> DataFrame:
    """Closed sessions of a silver stream, by the gap rule of the batch report.

    Spark's own session window, for consumers that want an append-only stream and can say
    how late snapshots may be; ``start_sessions`` needs no such bound and loses nothing.

    A session comes out once the stream is more than the gap past its last
    snapshot, which is when the batch rule calls it closed. Times are whole
    seconds and the watermark trails by at least one, so that a gap of exactly
    ``gap_seconds`` still continues a session. ``lateness_seconds`` is how far
    snapshots may arrive out of order: a larger value closes sessions later.
    Snapshots later than that are not in any session; :func:`finish` counts
    them and raises. A stored table's files come in no order of time, so most of a
    backlog would be late: take it in by :func:`catch_up_sessions` first.
    """
    _check(gap_seconds, lateness_seconds)
    return _windows(_timed(silver, lateness_seconds), gap_seconds)


def _check(gap_seconds: int, lateness_seconds: int) -> None:
    if lateness_seconds < 1:
        raise ValueError("lateness_seconds must be at least 1")
    if gap_seconds < 1:
        raise ValueError("a session window needs a gap of at least one second")


def _whole_seconds(silver: DataFrame) -> DataFrame:
    return identified(silver).withColumn("time", F.expr("date_trunc('second', time)"))


def _timed(silver: DataFrame, lateness_seconds: int) -> DataFrame:
    return _whole_seconds(silver).withWatermark("time", f"{lateness_seconds} seconds")


def _windows(timed: DataFrame, gap_seconds: int) -> DataFrame:
    def earliest(name: str) -> str:
        return f"min(case when {name} is not null then struct(time, {name}) end).{name}"

    folded = (
        timed.groupBy(F.session_window("time", f"{gap_seconds} seconds"), "icao24")
        .agg(
            F.min("time").alias("entry_ts"),
            F.max("time").alias("exit_ts"),
            F.expr(f"{earliest('Nome')} as airline_name"),
            F.expr(f"{earliest('ICAO')} as airline_icao"),
        )
        .drop("session_window")
        .withColumn("has_exit", F.lit(1))
    )
    return with_duration_and_day(folded)


def start_watermarked_sessions(
    silver: DataFrame,
    path: str,
    checkpoint: str,
    gap_seconds: int = DEFAULT_GAP_SECONDS,
    *,
    lateness_seconds: int,
    processing_time: str | None = DEFAULT_TRIGGER,
) -> StreamingQuery:
    _check(gap_seconds, lateness_seconds)
    timed = _timed(silver, lateness_seconds)
    return _started(timed, path, checkpoint, gap_seconds, processing_time)


def _started(
    timed: DataFrame, path: str, checkpoint: str, gap_seconds: int, processing_time: str | None
) -> StreamingQuery:
    return append_stream(
        _windows(timed, gap_seconds),
        path,
        checkpoint,
        partition_columns=DAY_PARTITION,
        processing_time=processing_time,
    )


def catch_up_sessions(
    spark: SparkSession,
    source: str,
    path: str,
    checkpoint: str,
    schema: T.StructType = SILVER,
    gap_seconds: int = DEFAULT_GAP_SECONDS,
    *,
    lateness_seconds: int,
) -> StreamingQuery:
    """Take the table stored at ``source`` into the session stream, its files in any order.

    An ordinary job finds the sessions of all that is stored. Those that no snapshot within
    the lateness of the last one can touch are done and go into a table of their own, so the
    stream's state does not grow with the backlog; :func:`read_closed_sessions` gives them
    with the stream's. The stream then takes in all files, in one batch, and keeps the
    snapshots of the other sessions only. They come out when
    :func:`start_watermarked_sessions` goes on with the same checkpoint and source.

    Files that are added meanwhile are taken in like later ones, as far as they are within the
    lateness; older ones must wait for the stream. If this is stopped it may run again; once
    the stream has taken in a batch, it goes on as :func:`start_watermarked_sessions` does.
    """
    _check(gap_seconds, lateness_seconds)
    timed = _timed(snapshot_files(spark, source, schema, None), lateness_seconds)
    if not any(name.isdigit() for name in list_files(spark, f"{checkpoint}/commits")):
        stored = _whole_seconds(spark.read.schema(schema).parquet(source))
        backlog = f"{path}/{_BACKLOG}"
        _store_backlog(stored, backlog, gap_seconds, lateness_seconds)
        waiting = _read_backlog(spark, backlog, 1)
        timed = _still_waiting(timed, waiting, gap_seconds, lateness_seconds)
    return _started(timed, path, checkpoint, gap_seconds, None)


def _store_backlog(
    stored: DataFrame, backlog: str, gap_seconds: int, lateness_seconds: int
) -> None:
    end = latest_time(stored)
    cells = presence_cells(stored, gap_seconds)
    sessions = sessions_from_cells(cells, end, gap_seconds).withColumn("_end", end)
    # The stream's watermark ends so far behind the last snapshot, its windows a gap after theirs.
    waits = f"{seconds_between('exit_ts', '_end')} < {gap_seconds + lateness_seconds}"
    rows = sessions.withColumn(_WAITING, F.expr(f"cast({waits} as int)"))
    write_table(rows.select(*_CLOSED.names, _WAITING), backlog, (_WAITING, *DAY_PARTITION))


def _read_backlog(spark: SparkSession, backlog: str, waiting: int) -> DataFrame:
    # By folder, so that a join knows its size.
    folder = f"{_WAITING}={waiting}"
    if folder not in list_folders(spark, backlog, folder):
        return spark.createDataFrame([], _CLOSED)
    return spark.read.schema(_CLOSED).parquet(f"{backlog}/{folder}")


def _still_waiting(
    timed: DataFrame, waiting: DataFrame, gap_seconds: int, lateness_seconds: int
) -> DataFrame:
    """Snapshots of the waiting sessions, and others that the watermark will let pass."""
    end = waiting.agg(F.expr("max(unix_timestamp(exit_ts))")).first()[0]
    if end is None:
        return timed
    since = waiting.groupBy("icao24").agg(F.min("entry_ts").alias("_since"))
    passes = f"unix_timestamp(time) > {end - gap_seconds - lateness_seconds}"
    return timed.join(since, "icao24", "left").filter(f"time >= _since or {passes}").drop("_since")


def read_closed_sessions(spark: SparkSession, path: str) -> DataFrame:
    """Sessions the watermarked stream has closed, those of its backlog as well."""
    rows = spark.read.schema(_CLOSED).parquet(path)
    if _BACKLOG not in list_folders(spark, path, _BACKLOG):
        return rows
    return rows.unionByName(_read_backlog(spark, f"{path}/{_BACKLOG}", 0))


def late_rows(progress: Iterable) -> int:
    """Snapshots left out for being late in these batches."""
    return sum(
        operator.get("numRowsDroppedByWatermark", 0)
        for batch in progress
        for operator in batch["stateOperators"]
    )


def finish(query: StreamingQuery) -> None:
    """Wait for a stream that works off what is there; raise if it left rows out.

    Spark keeps the progress of the last batches only, so it is looked up while they run.
    """
    seen = {}
    while True:
        ended = query.awaitTermination(_LOOK_UP_SECONDS)
        seen.update({batch["batchId"]: batch for batch in query.recentProgress})
        if ended:
            break
    if late := late_rows(seen.values()):
        raise RuntimeError(f"{late} late snapshots are in no session; see catch_up_sessions")


#: Spark keeps the progress of 100 batches by default; this many are not done in a second.
_LOOK_UP_SECONDS = 1
