"""The four reports and the session quality counters.

Builders take snapshots in silver form and return unsorted frames; a global sort
before a partitioned write would only cost a shuffle. :func:`in_report_order`
sorts one for reading.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from skylattice.functions import (
    calendar_columns,
    exact_means,
    gather_means,
    label_or,
    mean_ranges,
    mean_value,
    merge_mean_parts,
)
from skylattice.operators.filters import airborne, on_date
from skylattice.operators.sessions import (
    DEFAULT_GAP_SECONDS,
    build_sessions,
    used_sessions,
)

DAY_COLUMNS = ("date", "year", "month", "day")
HOUR_COLUMNS = ("date", "hour", "year", "month", "day")

# Labels of snapshots without an airline.
UNKNOWN_AIRLINE = "Desconhecida"
UNKNOWN_CODE = "N/A"

#: Means of the altitude and speed report: prefix of its sums to column.
MEANS = {"altitude": "baro_altitude", "velocity": "velocity"}

#: Sort columns of each report when it is shown to a reader.
REPORT_ORDER = {
    "aircraft_activity": ("date", "hour"),
    "airline_counts": ("date", "airline_name", "airline_icao"),
    "altitude_speed": ("date", "hour"),
    "monitored_area_duration": ("date",),
    "session_detail": ("entry_ts", "icao24"),
}


def with_calendar(df: DataFrame, timestamp_column: str = "time") -> DataFrame:
    """Add ``date, hour, year, month, day``; silver's own day is overwritten."""
    return df.withColumns(calendar_columns(timestamp_column))


def with_day_columns(grouped: DataFrame) -> DataFrame:
    """Add ``year, month, day`` of ``date`` to a result.

    They follow from the date, so reports group and shuffle on the date alone.
    """
    return grouped.withColumns(
        {name: F.expr(f"{name}(date)") for name in DAY_COLUMNS[1:]}
    )


def in_report_order(df: DataFrame, report: str) -> DataFrame:
    return df.orderBy(*REPORT_ORDER[report])


def aircraft_activity(df: DataFrame, only_airborne: bool = True) -> DataFrame:
    """Distinct aircraft per date and hour, by default those in the air."""
    seen = airborne(df) if only_airborne else df
    counted = (
        with_calendar(seen)
        .groupBy("date", "hour")
        .agg(F.countDistinct("icao24").alias("active_aircraft_count"))
    )
    return with_day_columns(counted).select(*HOUR_COLUMNS, "active_aircraft_count")


def airline_counts(
    df: DataFrame,
    name_column: str = "Nome",
    code_column: str = "ICAO",
    unknown_name: str = UNKNOWN_AIRLINE,
    unknown_code: str = UNKNOWN_CODE,
) -> DataFrame:
    """Distinct aircraft per date and airline; no airline is a group of its own.

    The distinct count first groups on the aircraft as well, so the large group
    without an airline is spread by aircraft.
    """
    missing = sorted({name_column, code_column} - set(df.columns))
    if missing:
        raise ValueError(f"airline columns missing in silver: {missing}")
    counted = (
        with_calendar(df)
        .select(
            "date",
            label_or(code_column, unknown_code).alias("airline_icao"),
            label_or(name_column, unknown_name).alias("airline_name"),
            "icao24",
        )
        .groupBy("date", "airline_icao", "airline_name")
        .agg(F.countDistinct("icao24").alias("aircraft_count"))
    )
    return with_day_columns(counted).select(
        *DAY_COLUMNS, "airline_icao", "airline_name", "aircraft_count"
    )


def altitude_speed(df: DataFrame, round_velocity: bool = True) -> DataFrame:
    """Mean altitude and speed per date and hour, aircraft on the ground included."""
    means = exact_means(with_calendar(df), ("date", "hour"), MEANS)
    return _altitude_speed_report(means, round_velocity)


def altitude_speed_from_parts(rollup: DataFrame, round_velocity: bool = True) -> DataFrame:
    """The same report from rows that already hold sums and counts."""
    merged = rollup.groupBy("date", "hour", *mean_ranges(*MEANS)).agg(
        *(part for prefix in MEANS for part in merge_mean_parts(prefix))
    )
    means = gather_means(merged, ("date", "hour"), list(MEANS))
    return _altitude_speed_report(means, round_velocity)


def _altitude_speed_report(means: DataFrame, round_velocity: bool) -> DataFrame:
    return with_day_columns(means).select(
        *HOUR_COLUMNS,
        mean_value("altitude").alias("avg_altitude"),
        mean_value("velocity", 2 if round_velocity else None).alias("avg_velocity"),
        F.col("altitude_count").alias("altitude_observations"),
        F.col("velocity_count").alias("velocity_observations"),
    )


def area_duration(sessions: DataFrame) -> DataFrame:
    """Mean length and number of the used sessions per entry date."""
    report = (
        used_sessions(sessions)
        .groupBy("date")
        .agg(
            # Durations are whole numbers, so their double sum is exact.
            F.round(F.avg("duration_seconds"), 2).alias("avg_area_duration_seconds"),
            F.count(F.lit(1)).alias("sessions_used"),
        )
    )
    return with_day_columns(report).select(
        *DAY_COLUMNS, "avg_area_duration_seconds", "sessions_used"
    )


def monitored_area_duration(
    df: DataFrame,
    gap_seconds: int = DEFAULT_GAP_SECONDS,
    run_date: str | None = None,
    close_stale_tail: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Report and sessions. ``run_date`` keeps sessions that *enter* on that date.

    It is applied after sessions are built, so one that runs over midnight keeps
    its whole length. Filter the snapshots first for the other reading.
    """
    sessions = build_sessions(df, gap_seconds, close_stale_tail)
    report = area_duration(on_date(sessions, run_date, "entry_ts"))
    return report, sessions


def session_quality(sessions: DataFrame) -> DataFrame:
    """One row of counters. On no sessions the total is 0 and the others NULL."""
    closed, is_open = "has_exit = 1", "has_exit = 0"
    discarded = f"{closed} and duration_seconds <= 0"

    def counted(condition: str) -> str:
        return f"sum(case when {condition} then 1 else 0 end)"

    return sessions.agg(
        F.expr("count(*) as sessions_total"),
        F.expr(f"{counted(closed)} as sessions_closed"),
        F.expr(f"{counted(is_open)} as sessions_open"),
        F.expr(f"{counted(discarded)} as sessions_discarded_non_positive"),
    )


def session_quality_basic(sessions: DataFrame) -> DataFrame:
    """The first three counters only."""
    return session_quality(sessions).select(
        "sessions_total", "sessions_closed", "sessions_open"
    )
