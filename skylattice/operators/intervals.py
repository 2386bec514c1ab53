"""Presence intervals: sessions of a part of the data, which can be merged with others.

An interval is a maximal run of one aircraft's snapshots in the rows at hand, with the
time of each label beside it. Intervals of two parts, joined where they are at most the gap
apart, are the intervals of both parts together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from skylattice.functions import seconds_between
from skylattice.operators.sessions import presence_cells


def presence_intervals(df: DataFrame, gap_seconds: int) -> DataFrame:
    """Maximal runs of an aircraft's snapshots: ``icao24, entry_ts, exit_ts, named, coded``.

    Snapshots are folded to cells before anything is shuffled, see ``presence_cells``.
    """
    cells = presence_cells(df, gap_seconds)
    folded = cells.groupBy("icao24", "cell").agg(
        F.expr("min(first_seen) as entry_ts"),
        F.expr("max(last_seen) as exit_ts"),
        _first_label("first_seen", "Nome", "named"),
        _first_label("first_seen", "ICAO", "coded"),
    )
    return joined_intervals(folded, gap_seconds).select(
        "icao24", "entry_ts", "exit_ts", "named", "coded"
    ).distinct()


def _first_label(time: str, value: str, name: str):
    pair = f"named_struct('time', {time}, 'label', {value})"
    return F.expr(f"min(case when {value} is not null then {pair} end) as {name}")


def joined_intervals(intervals: DataFrame, gap_seconds: int) -> DataFrame:
    """Give each interval the borders and labels of the run it is in.

    Adds ``chain``, the number of the run, and keeps the interval's own start as ``own``.
    """
    aircraft = "partition by icao24 order by entry_ts, exit_ts"
    before = f"max(exit_ts) over ({aircraft} rows between unbounded preceding and 1 preceding)"
    gap = seconds_between("_before", "entry_ts")
    chained = (
        intervals.withColumn("_before", F.expr(before))
        .withColumn("_opens", F.expr(f"case when _before is null or {gap} > {gap_seconds} then 1 else 0 end"))
        .withColumn("chain", F.expr(f"sum(_opens) over ({aircraft} rows unbounded preceding)"))
    )
    run = "over (partition by icao24, chain)"
    return chained.withColumn("own", F.col("entry_ts")).withColumns(
        {
            "entry_ts": F.expr(f"min(own) {run}"),
            "exit_ts": F.expr(f"max(exit_ts) {run}"),
            "named": F.expr(f"min(named) {run}"),
            "coded": F.expr(f"min(coded) {run}"),
        }
    )
