"""Sessions of a silver stream, whatever order its snapshots arrive in.

Each batch folds its snapshots to presence intervals and merges these into the sessions
known so far: a late snapshot extends a session or joins two, and only the sessions it
touches are written again. Sessions are versioned rows by the day they begin
(:class:`VersionStore`), so nothing waits for a watermark, no snapshot is ever too late, and
the table holds at any time the sessions of all snapshots that have arrived.

A second, small store has for each of these days how far its sessions reach. A batch reads
the days its intervals, widened by the gap, fall on, and earlier days only if one of their
sessions reaches into those. By it the end of the data is known as well, and with it which
sessions are closed: an aircraft's next session begins more than the gap after the last,
and no later than the end of the data, so a session is closed if and only if the data go on
for more than the gap after it.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from skylattice.operators.filters import identified
from skylattice.operators.intervals import joined_intervals, presence_intervals
from skylattice.operators.sessions import DEFAULT_GAP_SECONDS, cell_width, with_duration_and_day
from skylattice.sources.sinks import DEFAULT_TRIGGER, WriteResult, batch_stream, write_table
from skylattice.streaming.versions import NO_DAY, VersionStore

_LABEL = T.StructType().add("time", T.TimestampType()).add("label", T.StringType())
_SESSION = (
    T.StructType()
    .add("icao24", T.StringType())
    .add("entry_ts", T.TimestampType())
    .add("exit_ts", T.TimestampType())
    .add("named", _LABEL)
    .add("coded", _LABEL)
    .add("gone", T.BooleanType())
)
#: ``last`` is in whole epoch seconds, the unit of the gap.
_REACH = (
    T.StructType()
    .add("of", T.DateType())
    .add("last", T.LongType())
    .add("gap_seconds", T.LongType())
)


def _stores(spark: SparkSession, path: str) -> tuple[VersionStore, VersionStore]:
    path = path.rstrip("/")
    return (
        VersionStore(spark, path, _SESSION, ("icao24", "entry_ts")),
        VersionStore(spark, f"{path}/_reach", _REACH, ("of",)),
    )


def start_sessions(
    silver: DataFrame,
    path: str,
    checkpoint: str,
    gap_seconds: int = DEFAULT_GAP_SECONDS,
    processing_time: str | None = DEFAULT_TRIGGER,
) -> StreamingQuery:
    """Keep the sessions of a silver stream at ``path``; read them by :func:`read_sessions`.

    Snapshots may arrive in any order and any batches. The gap and the session's time zone,
    which decides on days, must stay the same for a path.
    """
    cell_width(gap_seconds)

    def write(batch: DataFrame, number: int) -> None:
        sessions, reach = _stores(batch.sparkSession, path)
        known = _known(reach, number, gap_seconds)
        found = presence_intervals(identified(batch), gap_seconds).persist()
        merged = None
        try:
            near = _near(_touched(found, gap_seconds), known)
            sessions.fold(near, number)
            stored = sessions.rows(near, number).filter("not gone")
            merged = _merged(found, stored, gap_seconds).persist()
            sessions.append(_versions(merged), number)
            _note_reach(reach, merged, known, gap_seconds, number)
        finally:
            found.unpersist()
            if merged is not None:
                merged.unpersist()

    return batch_stream(silver, write, checkpoint, processing_time)


def _touched(found: DataFrame, gap_seconds: int) -> list:
    """Dates that the intervals, widened by the gap, fall on."""
    widened = (
        f"to_date(timestamp_seconds(cast(entry_ts as long) - {gap_seconds}))",
        f"to_date(timestamp_seconds(cast(exit_ts as long) + {gap_seconds} + 1))",
    )
    days = found.selectExpr(f"explode(sequence({', '.join(widened)})) as day").distinct()
    return sorted(row.day for row in days.collect())


def _known(reach: VersionStore, number: int, gap_seconds: int) -> dict:
    """How far the sessions of each day reach: date to (epoch seconds, their date)."""
    reach.fold([NO_DAY], number)
    rows = reach.rows([NO_DAY], number).selectExpr("*", "to_date(timestamp_seconds(last)) as last_day").collect()
    if any(row.gap_seconds != gap_seconds for row in rows):
        raise ValueError(f"these sessions were begun with a gap of {rows[0].gap_seconds} seconds")
    return {row.of: (row.last, row.last_day) for row in rows}


def _near(touched: list, known: dict) -> list[str]:
    """Days that can hold a session which one of the touched days concerns."""
    near = set(touched)
    for day, (_, last_day) in known.items():
        at = bisect_right(touched, day)
        if at < len(touched) and touched[at] <= last_day:
            near.add(day)
    return sorted(map(str, near))


def _merged(found: DataFrame, stored: DataFrame, gap_seconds: int) -> DataFrame:
    """Intervals and stored sessions of their aircraft in runs that hold an interval."""
    columns = ("icao24", "entry_ts", "exit_ts", "named", "coded")
    # Aircraft of the batch only; sorting out the others needs no shuffle of the store's rows
    # if the batch is small enough to be sent around.
    concerned = stored.join(found.select("icao24").distinct(), "icao24", "left_semi")
    both = found.select(*columns, F.lit(True).alias("fresh")).unionByName(
        concerned.select(*columns, F.lit(False).alias("fresh"))
    )
    runs = joined_intervals(both, gap_seconds)
    return runs.withColumn(
        "touched", F.expr("max(fresh) over (partition by icao24, chain)")
    ).filter("touched")


def _versions(merged: DataFrame) -> DataFrame:
    """New versions of the sessions, and notes that those they swallowed are gone."""
    sessions = merged.select("icao24", "entry_ts", "exit_ts", "named", "coded").distinct()
    live = sessions.withColumn("gone", F.lit(False))
    empty = F.lit(None).cast(_LABEL)
    gone = merged.filter("not fresh and own <> entry_ts").select(
        "icao24", F.col("own").alias("entry_ts"), F.col("own").alias("exit_ts"),
        empty.alias("named"), empty.alias("coded"), F.lit(True).alias("gone"),
    )
    return live.unionByName(gone).withColumn("day", F.to_date("entry_ts"))


def _note_reach(
    reach: VersionStore, merged: DataFrame, known: dict, gap_seconds: int, number: int
) -> None:
    spark = merged.sparkSession
    last = F.expr("max(cast(exit_ts as long)) as last")
    days = merged.groupBy(F.to_date("entry_ts").alias("of")).agg(last)
    rows = [
        (row.of, max(row.last, known[row.of][0]) if row.of in known else row.last, gap_seconds, None)
        for row in days.collect()
    ]
    schema = T.StructType([*_REACH.fields, T.StructField("day", T.DateType())])
    if rows:
        reach.append(spark.createDataFrame(rows, schema).coalesce(1), number)


def read_sessions(
    spark: SparkSession, path: str, days: Iterable[str] | None = None, closed: bool = True
) -> DataFrame:
    """The sessions of all snapshots that have arrived, by default the closed ones.

    ``days`` are entry dates; only their folders are read. ``has_exit`` is 1 for a closed
    session: the data go on for more than the gap after it.
    """
    sessions, reach = _stores(spark, path)
    known = reach.rows([NO_DAY])
    end, gap = known.agg(F.max("last")).scalar(), known.agg(F.max("gap_seconds")).scalar()
    wanted = sessions.days() if days is None else list(days)
    rows = sessions.rows(wanted).filter("not gone").withColumns({"_end": end, "_gap": gap})
    folded = rows.select(
        "icao24",
        "entry_ts",
        "exit_ts",
        F.expr("named.label as airline_name"),
        F.expr("coded.label as airline_icao"),
        F.expr("case when _end - cast(exit_ts as long) > _gap then 1 else 0 end as has_exit"),
    )
    return with_duration_and_day(folded.filter("has_exit = 1") if closed else folded)


def compact_sessions(spark: SparkSession, path: str, compacted: str, day: str) -> WriteResult:
    """Write the closed sessions of one entry date into a table by day, replacing it there."""
    return write_table(read_sessions(spark, path, [day]), compacted, replace="dynamic")
