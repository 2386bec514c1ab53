"""Batch jobs: one per report, all reports in one pass, and the silver rebuild."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

from skylattice.functions import (
    calendar_columns,
    mean_columns,
    mean_parts,
    mean_ranges,
    time_cell,
)
from skylattice.operators.airlines import clean_airlines
from skylattice.operators.filters import on_date
from skylattice.operators.sessions import (
    DEFAULT_GAP_SECONDS,
    build_sessions,
    cell_width,
    latest_time,
    sessions_from_cells,
)
from skylattice.plans import marts
from skylattice.plans.carry import entered_between
from skylattice.plans.silver import build_silver
from skylattice.schemas import BRONZE, DAY_PARTITION
from skylattice.scratch import scratch_table
from skylattice.session import session_zone
from skylattice.sources import WriteResult, read_airlines, read_silver, write_table

#: Silver columns each report needs beyond the contract's own.
REPORT_COLUMNS = {
    "aircraft_activity": ("on_ground",),
    "airline_counts": ("Nome", "ICAO"),
    "altitude_speed": ("baro_altitude", "velocity", "on_ground"),
    "monitored_area_duration": ("Nome", "ICAO"),
}


@dataclass(frozen=True)
class ReportRun:
    """Outcome of a job: what each report wrote and the session counters."""

    written: dict[str, WriteResult]
    quality: dict[str, int | None] | None = None

    def describe(self) -> str:
        lines = [result.describe(name) for name, result in self.written.items()]
        if self.quality is not None:
            lines.append(f"session quality: {self.quality}")
        return "\n".join(lines)


def hourly_rollup(df: DataFrame, gap_seconds: int = DEFAULT_GAP_SECONDS) -> DataFrame:
    """Snapshots folded per aircraft, hour, session cell and airline label.

    Every report can be taken from it: the distinct counts and sessions need only
    which aircraft was seen when and in the air or not, the means need sums and
    counts. All buffers are numbers, so it is one hash aggregate with a partial
    step before its only shuffle.
    """
    calendar = calendar_columns("time")
    return (
        df.select(
            "icao24",
            calendar["date"].alias("date"),
            calendar["hour"].alias("hour"),
            time_cell("time", cell_width(gap_seconds)).alias("cell"),
            "Nome",
            "ICAO",
            "time",
            "on_ground",
            *(
                column.alias(name)
                for prefix, value in marts.MEANS.items()
                for name, column in mean_columns(value, prefix).items()
            ),
        )
        .groupBy(
            "icao24", "date", "hour", "cell", "Nome", "ICAO", *mean_ranges(*marts.MEANS)
        )
        .agg(
            F.min("time").alias("first_seen"),
            F.max("time").alias("last_seen"),
            F.expr("max(coalesce(not on_ground, false)) as was_airborne"),
            *(part for prefix in marts.MEANS for part in mean_parts(prefix)),
        )
    )


def reports_from_rollup(
    rollup: DataFrame, gap_seconds: int = DEFAULT_GAP_SECONDS
) -> tuple[dict[str, DataFrame], DataFrame]:
    """The three snapshot reports, and the sessions, from one roll-up."""
    seen = rollup.withColumn("time", F.col("first_seen"))
    in_air = seen.filter("was_airborne")
    reports = {
        "aircraft_activity": marts.aircraft_activity(in_air, only_airborne=False),
        "airline_counts": marts.airline_counts(seen),
        "altitude_speed": marts.altitude_speed_from_parts(rollup),
    }
    end = latest_time(rollup, "last_seen")
    return reports, sessions_from_cells(rollup, end, gap_seconds)


def generate_all_reports(
    spark: SparkSession,
    source_path: str,
    output_path: str,
    run_date: str | None = None,
    timezone: str = "UTC",
    session_gap: int = DEFAULT_GAP_SECONDS,
) -> ReportRun:
    """All four reports and the session counters, reading silver once.

    ``run_date`` filters the snapshots before everything, so sessions are cut at
    its midnights; :func:`run_area_duration` keeps them whole. With a date only
    that day's partition is replaced, without one the whole marts.
    """
    needed = sorted({name for columns in REPORT_COLUMNS.values() for name in columns})
    with (
        session_zone(spark, timezone),
        scratch_table(spark, "rollup") as rollup_path,
        scratch_table(spark, "sessions") as sessions_path,
    ):
        run_date = _iso_date(spark, run_date)
        silver = read_silver(spark, source_path, needed, run_date)
        hourly_rollup(silver, session_gap).write.parquet(rollup_path)
        reports, sessions = reports_from_rollup(spark.read.parquet(rollup_path), session_gap)

        def write(name: str, report: DataFrame) -> WriteResult:
            return _write_report(report, f"{output_path}/{name}", run_date)

        def write_duration() -> tuple[WriteResult, dict[str, int | None]]:
            report, quality = _stored_sessions(spark, sessions, sessions_path)
            return write("monitored_area_duration", report), quality

        # The reports are small and independent of each other: their jobs share
        # the cluster instead of queueing.
        with ThreadPoolExecutor(len(reports) + 1) as pool:
            duration = pool.submit(inheritable_thread_target(spark)(write_duration))
            pending = {
                name: pool.submit(inheritable_thread_target(spark)(write), name, report)
                for name, report in reports.items()
            }
            written = {name: future.result() for name, future in pending.items()}
            written["monitored_area_duration"], quality = duration.result()
    return ReportRun(written, quality)


def _stored_sessions(
    spark: SparkSession, sessions: DataFrame, path: str, run_date: str | None = None
) -> tuple[DataFrame, dict[str, int | None]]:
    """Write the sessions once; take the duration report and the counters from them."""
    sessions.write.parquet(path)
    stored = spark.read.schema(sessions.schema).parquet(path)
    report = marts.area_duration(on_date(stored, run_date, "entry_ts"))
    return report, marts.session_quality(stored).first().asDict()


def run_aircraft_activity(
    spark: SparkSession,
    source_path: str,
    output_path: str,
    run_date: str | None = None,
    timezone: str = "UTC",
) -> ReportRun:
    name, build = "aircraft_activity", marts.aircraft_activity
    return _snapshot_report(spark, name, build, source_path, output_path, run_date, timezone)


def run_altitude_speed(
    spark: SparkSession,
    source_path: str,
    output_path: str,
    run_date: str | None = None,
    timezone: str = "UTC",
) -> ReportRun:
    name, build = "altitude_speed", marts.altitude_speed
    return _snapshot_report(spark, name, build, source_path, output_path, run_date, timezone)


def run_airline_counts(
    spark: SparkSession,
    source_path: str,
    output_path: str,
    run_date: str | None = None,
    timezone: str = "UTC",
    airline_name_column: str = "Nome",
    airline_icao_column: str = "ICAO",
) -> ReportRun:
    def build(silver: DataFrame) -> DataFrame:
        return marts.airline_counts(silver, airline_name_column, airline_icao_column)

    return _snapshot_report(
        spark,
        "airline_counts",
        build,
        source_path,
        output_path,
        run_date,
        timezone,
        (airline_name_column, airline_icao_column),
    )


def run_area_duration(
    spark: SparkSession,
    source_path: str,
    output_path: str,
    run_date: str | None = None,
    timezone: str = "UTC",
    session_gap: int = DEFAULT_GAP_SECONDS,
) -> ReportRun:
    """Area duration over the whole history; ``run_date`` picks entry dates after.

    The counters are over all sessions, also when one date is written.
    """
    name = "monitored_area_duration"
    with session_zone(spark, timezone), scratch_table(spark, "sessions") as sessions_path:
        run_date = _iso_date(spark, run_date)
        silver = read_silver(spark, source_path, REPORT_COLUMNS[name])
        sessions = build_sessions(silver, session_gap)
        report, quality = _stored_sessions(spark, sessions, sessions_path, run_date)
        written = _write_report(report, output_path, run_date)
    return ReportRun({name: written}, quality)


def run_area_duration_day(
    spark: SparkSession,
    source_path: str,
    output_path: str,
    run_date: str,
    timezone: str = "UTC",
    session_gap: int = DEFAULT_GAP_SECONDS,
) -> ReportRun:
    """The same report for one entry date, see :func:`run_area_duration_days`."""
    return run_area_duration_days(
        spark, source_path, output_path, run_date, run_date, timezone, session_gap
    )


def run_area_duration_days(
    spark: SparkSession,
    source_path: str,
    output_path: str,
    first_date: str,
    last_date: str,
    timezone: str = "UTC",
    session_gap: int = DEFAULT_GAP_SECONDS,
) -> ReportRun:
    """Area duration of the entry dates from one to another, reading each day once.

    What a day leaves open is carried to the next, see :mod:`skylattice.plans.carry`. Days of
    the table that lie before or behind what the sessions of these dates reach are not read.
    Only the partitions of these dates are replaced, and emptied where they have no sessions.
    There are no counters, which are over the whole history.
    """
    name = "monitored_area_duration"
    with session_zone(spark, timezone), scratch_table(spark, "sessions") as path:
        first, last = (_iso_date(spark, day) for day in (first_date, last_date))
        if not first or not last or first > last:
            raise ValueError(f"not a range of dates: {first_date} to {last_date}")
        silver = read_silver(spark, source_path, REPORT_COLUMNS[name])
        report = marts.area_duration(entered_between(silver, first, last, session_gap, path))
        days = (date.fromisoformat(last) - date.fromisoformat(first)).days + 1
        dates = [str(date.fromisoformat(first) + timedelta(n)) for n in range(days)]
        return ReportRun({name: _replace_days(report, output_path, dates)})


def rebuild_silver(
    spark: SparkSession,
    bronze_path: str,
    airlines_path: str,
    silver_path: str,
    timezone: str = "UTC",
) -> WriteResult:
    """Replace silver by reprocessing all of bronze in batch.

    A silver stream that goes on afterwards needs a new checkpoint and a new
    bronze folder: its old one still holds the keys it has seen.
    """
    with session_zone(spark, timezone):
        bronze = spark.read.schema(BRONZE).parquet(bronze_path)
        airlines = clean_airlines(read_airlines(spark, airlines_path))
        return write_table(build_silver(bronze, airlines), silver_path)


def _snapshot_report(
    spark, name, build, source_path, output_path, run_date, timezone, columns=None
) -> ReportRun:
    with session_zone(spark, timezone):
        run_date = _iso_date(spark, run_date)
        silver = read_silver(spark, source_path, columns or REPORT_COLUMNS[name], run_date)
        written = _write_report(build(silver), output_path, run_date)
    return ReportRun({name: written})


def _write_report(report: DataFrame, path: str, run_date: str | None) -> WriteResult:
    """Replace the whole mart, or with a date that day and no other."""
    return _replace_days(report, path, [run_date]) if run_date else write_table(report, path)


def _replace_days(report: DataFrame, path: str, dates: list[str]) -> WriteResult:
    """Replace the days of a mart that these dates name, all of the report's rows being theirs."""
    spark = report.sparkSession
    result = write_table(report, path, replace="dynamic")
    filled: set[str] = set()
    if result.rows and len(dates) > 1:
        # At most one row for each date of the range.
        filled = {str(row.date) for row in report.select("date").distinct().collect()}
    elif result.rows:
        filled = set(dates)
    for day in (date.fromisoformat(x) for x in dates if x not in filled):
        # Nothing replaces the day's old rows; an empty file does.
        nothing = spark.createDataFrame([], report.drop(*DAY_PARTITION).schema)
        nothing.write.mode("overwrite").parquet(
            f"{path}/year={day.year}/month={day.month}/day={day.day}"
        )
    return result


def _iso_date(spark: SparkSession, run_date: str | None) -> str | None:
    """A date in any form Spark reads, as ``yyyy-MM-dd``; an error if it is none."""
    if not run_date:
        return None
    return spark.sql("select cast(to_date(:day) as string) as day", {"day": run_date}).first().day
