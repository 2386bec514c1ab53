"""Gap-based presence sessions of aircraft.

A session is a maximal run of one aircraft's snapshots in which neighbours are
at most ``gap`` seconds apart (a gap of exactly ``gap`` does not split).

Ordering all snapshots of an aircraft in one task would not survive an aircraft
that holds a large share of the data. Time is therefore cut into cells no wider
than ``gap + 1`` seconds: two snapshots in one cell are at most ``gap`` apart, so
a cell never straddles a session border and can be folded to its first and last
snapshot *before* the shuffle, by an ordinary partial hash aggregate. Only the
folded cells of an aircraft are put in order. Their number is bounded by the
length of the observed time span over the gap, however many rows there are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from skylattice.functions import calendar_columns, quoted, seconds_between, time_cell

DEFAULT_GAP_SECONDS = 30 * 60
#: Widest cell in which raw rows are ordered for the row-level listing.
ROW_CELL_SECONDS = 60


def presence_cells(df: DataFrame, gap_seconds: int = DEFAULT_GAP_SECONDS) -> DataFrame:
    """Fold snapshots to first/last sighting per aircraft, cell and airline label.

    The labels are grouping keys rather than aggregates so that every buffer is a
    plain number: a hash aggregate without sorting the scan.
    """
    cell = time_cell("time", cell_width(gap_seconds)).alias("cell")
    return (
        df.select("icao24", "time", "Nome", "ICAO", cell)
        .groupBy("icao24", "cell", "Nome", "ICAO")
        .agg(F.expr("min(time) as first_seen"), F.expr("max(time) as last_seen"))
    )


def sessions_from_cells(
    cells: DataFrame,
    dataset_end: Column,
    gap_seconds: int = DEFAULT_GAP_SECONDS,
    close_stale_tail: bool = True,
) -> DataFrame:
    """Order the cells of each aircraft, number its sessions and fold them.

    ``dataset_end`` is the latest time of the whole data, see :func:`latest_time`.
    """
    merged = cells.groupBy("icao24", "cell").agg(
        F.expr("min(first_seen) as first_seen"),
        F.expr("max(last_seen) as last_seen"),
        _earliest("first_seen", "Nome", "named"),
        _earliest("first_seen", "ICAO", "coded"),
    )
    aircraft = "partition by icao24 order by cell"
    neighbours = merged.selectExpr(
        "*",
        f"lag(last_seen) over ({aircraft}) as previous_seen",
        f"lead(first_seen) over ({aircraft}) as next_seen",
    )
    opens = _opens("first_seen", "previous_seen", gap_seconds)
    numbered = neighbours.select(
        "*",
        dataset_end.alias("dataset_end"),
        F.expr(f"sum({opens}) over ({aircraft} rows unbounded preceding) as session_id"),
    )
    closes = _closes("last_seen", "next_seen", gap_seconds, close_stale_tail)
    folded = numbered.groupBy("icao24", "session_id").agg(
        F.expr("min(first_seen) as entry_ts"),
        F.expr("max(last_seen) as exit_ts"),
        F.expr(f"max({closes}) as has_exit"),
        F.expr("min(named).Nome as airline_name"),
        F.expr("min(coded).ICAO as airline_icao"),
    )
    return with_duration_and_day(folded)


def build_sessions(
    df: DataFrame,
    gap_seconds: int = DEFAULT_GAP_SECONDS,
    close_stale_tail: bool = True,
) -> DataFrame:
    """Snapshots to sessions.

    A session has an exit (``has_exit = 1``) when a later one of the aircraft
    follows, or, with ``close_stale_tail``, when the data go on for more than the
    gap after its last snapshot. The airline name and code are the earliest
    non-null ones of the session, each on its own.
    """
    cells = presence_cells(df, gap_seconds)
    return sessions_from_cells(cells, latest_seen(cells), gap_seconds, close_stale_tail)


def latest_seen(cells: DataFrame) -> Column:
    """Latest time of the snapshots that were folded to these cells.

    Asks for both ends of every cell, as the sessions do, so that both have the same shuffle
    below them: Spark runs it once and the snapshots are read once.
    """
    return cells.agg(F.expr("max(greatest(first_seen, last_seen))")).scalar()


def latest_time(df: DataFrame, timestamp_column: str = "time") -> Column:
    """Maximum of a column as a scalar subquery: one value, no join, no window."""
    return df.agg(F.max(timestamp_column)).scalar()


def session_observations(
    df: DataFrame,
    gap_seconds: int = DEFAULT_GAP_SECONDS,
    close_stale_tail: bool = True,
    tie_break: Sequence[str] = (),
    cell_seconds: int = ROW_CELL_SECONDS,
) -> DataFrame:
    """Every snapshot with its neighbours' times and its session number.

    Adds ``previous_time, next_time, dataset_end, new_session, session_id,
    session_closes``. Rows are ordered only inside short cells of an aircraft;
    what lies before and after a cell comes from the folded cells. ``tie_break``
    orders rows of the same aircraft and time. Rows must have a time. One aircraft's cell is
    ordered by one task: where a single minute holds a large part of the rows, shorter cells
    (``cell_seconds=1``) deal it to sixty, at the price of more cells to be put in order.
    """
    if cell_seconds < 1:
        raise ValueError("a cell is at least one second long")
    # Flat keys that are never NULL: rows without an aircraft join themselves, and
    # one partitioning and one sort serve the window and the join.
    keys = ("_aircraft", "_unknown", "_cell")
    slot, aircraft = ", ".join(keys), ", ".join(keys[:2])
    cell = time_cell("time", min(cell_width(gap_seconds), cell_seconds)).alias("_cell")
    rows = df.select(
        *(quoted(name) for name in df.columns if name != "icao24"),
        F.expr("coalesce(icao24, '') as _aircraft"),
        F.expr("icao24 is null as _unknown"),
        cell,
    )
    in_order = f"partition by {aircraft} order by _cell"
    opens = _opens("_first", "_before", gap_seconds)
    cells = rows.groupBy(*keys).agg(
        F.expr("min(time) as first_seen"), F.expr("max(time) as last_seen")
    )
    borders = (
        cells.selectExpr(*keys, "first_seen as _first", "last_seen as _last")
        .selectExpr(
            "*",
            f"lag(_last) over ({in_order}) as _before",
            f"lead(_first) over ({in_order}) as _after",
        )
        .selectExpr(
            *keys,
            "_before",
            "_after",
            f"sum({opens}) over ({in_order} rows unbounded preceding) as session_id",
        )
    )
    order = ", ".join(quoted(name) for name in ("time", *tie_break))
    inside = f"partition by {slot} order by {order}"
    columns = [
        "if(_unknown, null, _aircraft) as icao24" if name == "icao24" else quoted(name)
        for name in df.columns
    ]
    return (
        rows.selectExpr(
            "*", f"lag(time) over ({inside}) as _lag", f"lead(time) over ({inside}) as _lead"
        )
        .join(borders, list(keys))
        .select(
            *(F.expr(column) for column in columns),
            F.expr("coalesce(_lag, _before) as previous_time"),
            F.expr("coalesce(_lead, _after) as next_time"),
            latest_seen(cells).alias("dataset_end"),
            "session_id",
        )
        .selectExpr(
            *(quoted(name) for name in df.columns),
            "previous_time",
            "next_time",
            "dataset_end",
            f"{_opens('time', 'previous_time', gap_seconds)} as new_session",
            "session_id",
            f"{_closes('time', 'next_time', gap_seconds, close_stale_tail)} as session_closes",
        )
    )


def used_sessions(sessions: DataFrame) -> DataFrame:
    """Closed sessions of positive length, the only ones a mean is taken over."""
    return sessions.filter("has_exit = 1 and duration_seconds > 0")


def session_detail(sessions: DataFrame) -> DataFrame:
    """Listing of the used sessions, one line each."""
    return used_sessions(sessions).select(
        "icao24", "airline_icao", "airline_name", "entry_ts", "exit_ts", "duration_seconds"
    )


def with_duration_and_day(folded: DataFrame) -> DataFrame:
    """Add the length and the entry day to rows with ``entry_ts, exit_ts``."""
    day = calendar_columns("entry_ts")
    return folded.withColumns(
        {
            "duration_seconds": F.expr(seconds_between("entry_ts", "exit_ts")),
            **{name: day[name] for name in ("date", "year", "month", "day")},
        }
    )


def cell_width(gap_seconds: int) -> int:
    """Widest cell that cannot straddle a session border."""
    if gap_seconds < 0:
        raise ValueError("the session gap must not be negative")
    return gap_seconds + 1


def _earliest(time: str, value: str, name: str) -> Column:
    """Smallest (time, value) over the rows that have a value."""
    pair = f"named_struct('{time}', {time}, '{value}', {value})"
    return F.expr(f"min(case when {value} is not null then {pair} end) as {name}")


def _opens(time: str, previous: str, gap_seconds: int) -> str:
    gap = seconds_between(previous, time)
    return f"case when {previous} is null or {gap} > {gap_seconds} then 1 else 0 end"


def _closes(time: str, following: str, gap_seconds: int, close_stale_tail: bool) -> str:
    left_area = f"{seconds_between(time, following)} > {gap_seconds}"
    if close_stale_tail:
        stale = f"{seconds_between(time, 'dataset_end')} > {gap_seconds}"
        left_area = f"{left_area} or ({following} is null and {stale})"
    return f"case when {left_area} then 1 else 0 end"
