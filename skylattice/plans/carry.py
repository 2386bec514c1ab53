"""Sessions that begin on given dates, day by day, with a carry from each day to the next.

A day's snapshots are folded to presence intervals and joined with the carry: the intervals
the days before have left open, because their aircraft was seen within the gap before
midnight and may go on. What the day leaves open is the next carry. So every day is read
once, and a session keeps its beginning however many days it runs on.

Behind the last date only sessions of the dates are still carried, and of each further day
only the snapshots of their aircraft are taken; it ends when none is open or the data end.
Before the first date one gap is read, enough to tell whether a sighting begins a session.

The intervals of each day are stored, a folder for each step, so that nothing is computed
twice and no plan grows with the number of days.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from skylattice.operators.filters import ZONE_SLACK_DAYS
from skylattice.operators.intervals import joined_intervals, presence_intervals
from skylattice.operators.sessions import with_duration_and_day

#: Day of a partition folder, a predicate that is settled at planning.
_FOLDER = "make_date(year, month, day)"
_INTERVAL = ("icao24", "entry_ts", "exit_ts", "named", "coded")


def entered_between(
    silver: DataFrame, first: str, last: str, gap_seconds: int, path: str
) -> DataFrame:
    """Sessions with an entry date from ``first`` to ``last``, as from the whole history.

    ``path`` is a folder for the intervals of each step; the result is read from it. Dates are
    local ones, ``yyyy-MM-dd``.
    """
    spark = silver.sparkSession
    days = (date.fromisoformat(last) - date.fromisoformat(first)).days + 1
    wanted = f"entry_ts >= {midnight(first, 0)} and entry_ts < {midnight(first, days)}"
    at, carry = 0, None
    while True:
        seen = snapshots_between(silver, first, at, at + 1, 0 if at else gap_seconds)
        if at >= days:
            seen = seen.join(carry.select("icao24").distinct(), "icao24", "left_semi")
        found = presence_intervals(seen, gap_seconds)
        if carry is not None:
            found = joined_intervals(carry.unionByName(found), gap_seconds)
            found = found.select(*_INTERVAL).distinct()
        if at >= days:
            found = found.filter(wanted)
        at += 1
        folder = f"{path}/step={at}"
        # Seen within the gap before midnight: a later sighting may prolong it.
        end = f"cast({midnight(first, at)} as bigint)"
        goes_on = F.expr(f"{end} - cast(exit_ts as bigint) <= {gap_seconds}")
        found.withColumn("goes_on", goes_on).write.parquet(folder)
        carry = spark.read.parquet(folder).filter("goes_on").select(*_INTERVAL)
        if at >= days:
            carry = carry.filter(wanted)
        more = not snapshots_after(silver, first, at).isEmpty()
        if not more or at >= days and carry.isEmpty():
            break
    if not more:
        # One column of the days read. If there are later snapshots, the day's end will do:
        # all that is not carried any more ended over a gap before it.
        seen = snapshots_between(silver, first, 0, at, gap_seconds)
        end = seen.agg(F.expr("max(cast(time as bigint))")).scalar()
    else:
        end = F.expr(end)
    ended = spark.read.parquet(path).filter(wanted).filter(f"not goes_on or step = {at}")
    sessions = ended.withColumn("_end", end).select(
        "icao24",
        "entry_ts",
        "exit_ts",
        F.expr(f"if(_end - cast(exit_ts as bigint) > {gap_seconds}, 1, 0) as has_exit"),
        F.expr("named.label as airline_name"),
        F.expr("coded.label as airline_icao"),
    )
    return with_duration_and_day(sessions)


def snapshots_between(
    silver: DataFrame, day: str, start: int, end: int, lead_seconds: int = 0
) -> DataFrame:
    """Rows from one local midnight, or so many seconds before, to another.

    The midnights are counted in days from a date. Only folders that can hold such rows are read.
    """
    first = F.expr(f"timestamp_seconds(cast({midnight(day, start)} as bigint) - {lead_seconds})")
    near = silver.filter((F.col("time") >= first) & F.expr(f"time < {midnight(day, end)}"))
    before = ZONE_SLACK_DAYS + (lead_seconds // 86_400 + 1 if lead_seconds else 0)
    return near.filter(
        f"{_FOLDER} between date_add(date'{day}', {start - before})"
        f" and date_add(date'{day}', {end + ZONE_SLACK_DAYS})"
    )


def snapshots_after(silver: DataFrame, day: str, end: int) -> DataFrame:
    return silver.filter(f"time >= {midnight(day, end)}").filter(
        f"{_FOLDER} >= date_add(date'{day}', {end - ZONE_SLACK_DAYS})"
    )


def midnight(day: str, days: int) -> str:
    """SQL text: local midnight so many days after a date."""
    return f"cast(date_add(date'{day}', {days}) as timestamp)"
