"""Queries over the test tables, each next to the SQL that checks it.

The SQL states a result in the plain form (row-level windows over whole
partitions, for instance); the Spark side computes it in the form that scales.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from skylattice import driver_tables as tables
from skylattice.operators import sessions as sess, sketches
from skylattice.operators.airlines import clean_airlines
from skylattice.operators.envelopes import (
    decode_envelopes,
    encode_envelopes,
    rejected_messages,
)
from skylattice.operators.filters import inside_area, on_date, with_call_sign
from skylattice.plans import jobs, marts
from skylattice.plans.silver import removed_rows
from skylattice.schemas import DAY_PARTITION, SILVER
from skylattice.scratch import new_path
from skylattice.sources import (
    envelope_files,
    read_airlines,
    read_area,
    read_silver,
    snapshot_files,
    write_by_area,
    write_table,
)
from skylattice.streaming import (
    catch_up_sessions,
    compact_silver,
    finish,
    read_closed_sessions,
    read_sessions,
    read_streamed,
    start_bronze,
    start_sessions,
    start_silver,
    start_watermarked_sessions,
)

Query = Callable[[SparkSession, str], DataFrame]

#: Dates and gaps the parameterised queries run with.
RUN_DATE = "2024-01-15"
#: First and last date of a range of entry dates.
RUN_DATES = ("2024-01-08", "2024-01-17")
WIDE_GAP = 6 * 60 * 60

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- bronze -----------------------------------------------------------------


@query
def envelope_roundtrip(spark, sf_dir):
    return decode_envelopes(encode_envelopes(tables.bronze(spark, sf_dir)))


@query
def envelope_rejects(spark, sf_dir):
    return rejected_messages(broken_messages(spark, sf_dir))


def broken_messages(spark, sf_dir):
    """Messages made from the events, four of five of them without states in some way."""
    value = """case event_id % 5
        when 0 then concat('{"time": ', event_id, ', "states": []}')
        when 1 then concat('broken ', event_id)
        when 2 then concat('{"time": ', event_id, '}')
        when 3 then concat('{"time": ', event_id, ', "states": [{"icao24": "u', user_id, '"}]}')
        end as value"""
    return tables.table(spark, sf_dir, "events").selectExpr(value)


@query
def bbox_filter(spark, sf_dir):
    return inside_area(tables.bronze(spark, sf_dir)).select(
        "event_id", "time", "icao24", "latitude", "longitude"
    )


@query
def bbox_stored(spark, sf_dir):
    """The same box from a table stored by place."""
    path = new_path(spark, "area")
    write_by_area(tables.bronze(spark, sf_dir), path, files=16)
    return read_area(spark, path).select("event_id", "time", "icao24", "latitude", "longitude")


# --- silver -----------------------------------------------------------------


@query
def airline_dim_clean(spark, sf_dir):
    return tables.airlines(spark, sf_dir)


@query
def airline_csv_roundtrip(spark, sf_dir):
    """Raw airlines through the headerless CSV format and its reader."""
    path = new_path(spark, "airlines")
    tables.raw_airlines(spark, sf_dir).write.options(
        header="false", quote='"', escape='"', nullValue=r"\N"
    ).csv(path)
    return clean_airlines(read_airlines(spark, path))


@query
def silver_dedup(spark, sf_dir):
    return tables.unique(spark, sf_dir).select(
        "event_id", "time", "icao24", "last_contact", "callsign"
    )


@query
def silver_dropna(spark, sf_dir):
    return with_call_sign(tables.unique(spark, sf_dir)).select(
        "event_id", "time", "icao24", "last_contact", "callsign"
    )


@query
def silver_enrich(spark, sf_dir):
    return tables.silver(spark, sf_dir)


@query
def row_delta(spark, sf_dir):
    return removed_rows(tables.bronze(spark, sf_dir), tables.silver(spark, sf_dir))


@query
def silver_run_date(spark, sf_dir):
    """One date of the written silver table through the pruning reader."""
    path = new_path(spark, "silver")
    write_table(tables.silver(spark, sf_dir), path)
    kept = read_silver(spark, path, ("on_ground", "Nome"), run_date=RUN_DATE)
    return kept.select("event_id", "time", "icao24", "callsign", "Nome", *DAY_PARTITION)


# --- marts ------------------------------------------------------------------


@query
def aircraft_activity(spark, sf_dir):
    report = marts.aircraft_activity(tables.gold_input(spark, sf_dir))
    return marts.in_report_order(report, "aircraft_activity")


@query
def aircraft_activity_all(spark, sf_dir):
    return marts.aircraft_activity(tables.gold_input(spark, sf_dir), only_airborne=False)


@query
def aircraft_by_month(spark, sf_dir):
    """Distinct aircraft of a month, counted and estimated from stored sketches of its hours."""
    path = new_path(spark, "sketches")
    gold = tables.gold_input(spark, sf_dir)
    sketches.activity_sketches(gold).write.parquet(path)
    month = [F.expr("year(date) as year"), F.expr("month(date) as month")]
    merged = sketches.merge_sketches(spark.read.parquet(path), month)
    exact = (
        marts.with_calendar(gold.filter("on_ground = false"))
        .groupBy("year", "month")
        .agg(F.countDistinct("icao24").alias("aircraft"))
    )
    close = f"abs(active_aircraft_estimate - aircraft) <= {sketches.error_bound()} * aircraft"
    return exact.join(sketches.estimated_counts(merged), ["year", "month"]).selectExpr(
        "year", "month", "aircraft", f"{close} as within_bound"
    )


@query
def altitude_speed(spark, sf_dir):
    report = marts.altitude_speed(tables.gold_input(spark, sf_dir))
    return marts.in_report_order(report, "altitude_speed")


@query
def altitude_speed_raw(spark, sf_dir):
    return marts.altitude_speed(tables.gold_input(spark, sf_dir), round_velocity=False)


@query
def altitude_speed_extremes(spark, sf_dir):
    """Means of values that no grid or double sum holds: beyond 1e7, finer than 1e-6, no numbers.

    ``avg_velocity`` is null and ``velocity_kind`` tells why where it is no number.
    """
    special = "hour(time) % 6 = {} and event_id % 7 = {}".format
    wild = tables.gold_input(spark, sf_dir).withColumns(
        {
            "baro_altitude": F.expr(f"case when event_id % 11 <> 0 then {FINE} / 16777216D end"),
            "velocity": F.expr(
                f"""case when {special(1, 0)} then double('NaN')
                    when {special(2, 1)} or {special(3, 1)} then double('Infinity')
                    when {special(3, 2)} or {special(4, 2)} then double('-Infinity')
                    when event_id % 13 <> 0 then {LARGE} * 1099511627776D end"""
            ),
        }
    )
    finite = "abs(avg_velocity) < double('Infinity')"
    return marts.altitude_speed(wild).selectExpr(
        "date",
        "hour",
        "avg_altitude",
        "altitude_observations",
        "velocity_observations",
        f"case when {finite} then avg_velocity end as avg_velocity",
        f"""case when avg_velocity is null then 'none' when {finite} then 'finite'
            when isnan(avg_velocity) then 'NaN' when avg_velocity > 0 then 'Infinity'
            else '-Infinity' end as velocity_kind""",
    )


#: Whole numbers by event: in units of 2^-24 up to 2 * 10^7, and of 2^40 up to 5 * 10^17.
FINE = """((event_id * 7919) % 1000003 + (event_id % 3) * 167772160000000)
    * (2 * (event_id % 2) - 1)"""
LARGE = "((event_id * 104729) % 999983 - 500000)"


@query
def airline_counts(spark, sf_dir):
    report = marts.airline_counts(tables.gold_input(spark, sf_dir))
    return marts.in_report_order(report, "airline_counts")


@query
def airline_counts_custom_cols(spark, sf_dir):
    """Other columns and labels: counted by raw call sign and airline number."""
    return marts.airline_counts(
        tables.gold_input(spark, sf_dir),
        name_column="callsign",
        code_column="Airline ID",
        unknown_name="no call sign",
        unknown_code="none",
    )


@query
def session_observations(spark, sf_dir):
    rows = sess.session_observations(tables.gold_input(spark, sf_dir), tie_break=("event_id",))
    return rows.select("event_id", "icao24", "time", *OBSERVATION_COLUMNS)


@query
def session_observations_short_cells(spark, sf_dir):
    """The same listing with a cell for each second, as for a minute with very many rows."""
    rows = sess.session_observations(
        tables.gold_input(spark, sf_dir), tie_break=("event_id",), cell_seconds=1
    )
    return rows.select("event_id", "icao24", "time", *OBSERVATION_COLUMNS)


@query
def session_observations_wide(spark, sf_dir):
    rows = sess.session_observations(
        tables.gold_input(spark, sf_dir), WIDE_GAP, close_stale_tail=False, tie_break=("event_id",)
    )
    return rows.select("event_id", "icao24", "time", *OBSERVATION_COLUMNS)


OBSERVATION_COLUMNS = (
    "previous_time",
    "next_time",
    "dataset_end",
    "new_session",
    "session_id",
    "session_closes",
)


@query
def sessions(spark, sf_dir):
    return sess.build_sessions(tables.gold_input(spark, sf_dir))


@query
def sessions_wide(spark, sf_dir):
    return sess.build_sessions(tables.gold_input(spark, sf_dir), WIDE_GAP)


@query
def sessions_open_tail(spark, sf_dir):
    return sess.build_sessions(
        tables.gold_input(spark, sf_dir), WIDE_GAP, close_stale_tail=False
    )


@query
def area_duration(spark, sf_dir):
    report, _ = marts.monitored_area_duration(tables.gold_input(spark, sf_dir))
    return marts.in_report_order(report, "monitored_area_duration")


@query
def area_duration_wide(spark, sf_dir):
    report, _ = marts.monitored_area_duration(tables.gold_input(spark, sf_dir), WIDE_GAP)
    return report


@query
def area_duration_run_date(spark, sf_dir):
    report, _ = marts.monitored_area_duration(
        tables.gold_input(spark, sf_dir), WIDE_GAP, run_date=RUN_DATE
    )
    return report


@query
def area_duration_prefiltered(spark, sf_dir):
    day = on_date(tables.gold_input(spark, sf_dir), RUN_DATE)
    report, _ = marts.monitored_area_duration(day, WIDE_GAP)
    return report


@query
def session_quality(spark, sf_dir):
    return marts.session_quality(sess.build_sessions(tables.gold_input(spark, sf_dir)))


@query
def session_quality_basic(spark, sf_dir):
    wide = sess.build_sessions(tables.gold_input(spark, sf_dir), WIDE_GAP)
    return marts.session_quality_basic(wide)


@query
def session_detail(spark, sf_dir):
    detail = sess.session_detail(sess.build_sessions(tables.gold_input(spark, sf_dir), WIDE_GAP))
    return marts.in_report_order(detail, "session_detail")


# --- marts from the shared roll-up -------------------------------------------


def _from_rollup(spark, sf_dir, gap=sess.DEFAULT_GAP_SECONDS):
    rollup = jobs.hourly_rollup(tables.gold_input(spark, sf_dir), gap)
    return jobs.reports_from_rollup(rollup, gap)


@query
def rollup_aircraft_activity(spark, sf_dir):
    return _from_rollup(spark, sf_dir)[0]["aircraft_activity"]


@query
def rollup_airline_counts(spark, sf_dir):
    return _from_rollup(spark, sf_dir)[0]["airline_counts"]


@query
def rollup_altitude_speed(spark, sf_dir):
    return _from_rollup(spark, sf_dir)[0]["altitude_speed"]


@query
def rollup_sessions(spark, sf_dir):
    return _from_rollup(spark, sf_dir, WIDE_GAP)[1]


# --- written tables -----------------------------------------------------------


@query
def mart_roundtrip(spark, sf_dir):
    path = new_path(spark, "mart")
    write_table(marts.airline_counts(tables.gold_input(spark, sf_dir)), path)
    return spark.read.parquet(path)


@query
def mart_dynamic_overwrite(spark, sf_dir):
    """Write the whole mart, then one date of it again: no other day is lost."""
    path = new_path(spark, "mart")
    gold = tables.gold_input(spark, sf_dir)
    write_table(marts.airline_counts(gold), path)
    write_table(marts.airline_counts(on_date(gold, RUN_DATE)), path, replace="dynamic")
    return spark.read.parquet(path)


@query
def all_reports_activity(spark, sf_dir):
    """The activity mart as the all-reports job writes it from a silver table."""
    silver, marts_path = new_path(spark, "silver"), new_path(spark, "marts")
    write_table(tables.silver(spark, sf_dir), silver)
    jobs.generate_all_reports(spark, silver, marts_path)
    return spark.read.parquet(f"{marts_path}/aircraft_activity")


def _all_reports(spark, sf_dir, mart):
    silver, marts_path = new_path(spark, "silver"), new_path(spark, "marts")
    write_table(tables.silver(spark, sf_dir), silver)
    jobs.generate_all_reports(spark, silver, marts_path)
    return spark.read.parquet(f"{marts_path}/{mart}")


@query
def all_reports_quality(spark, sf_dir):
    """The counters that the all-reports job returns."""
    silver, marts_path = new_path(spark, "silver"), new_path(spark, "marts")
    write_table(tables.silver(spark, sf_dir), silver)
    quality = jobs.generate_all_reports(spark, silver, marts_path).quality
    return spark.createDataFrame([quality], ", ".join(f"{name} long" for name in quality))


@query
def all_reports_airlines(spark, sf_dir):
    return _all_reports(spark, sf_dir, "airline_counts")


@query
def all_reports_altitude_speed(spark, sf_dir):
    return _all_reports(spark, sf_dir, "altitude_speed")


@query
def all_reports_area_duration(spark, sf_dir):
    return _all_reports(spark, sf_dir, "monitored_area_duration")


def _job(spark, sf_dir, job, *arguments, **options):
    """The mart that a single job writes from a silver table."""
    silver, mart = new_path(spark, "silver"), new_path(spark, "mart")
    write_table(tables.silver(spark, sf_dir), silver)
    job(spark, silver, mart, *arguments, **options)
    return spark.read.parquet(mart)


@query
def job_aircraft_activity(spark, sf_dir):
    return _job(spark, sf_dir, jobs.run_aircraft_activity)


@query
def job_airline_counts(spark, sf_dir):
    return _job(spark, sf_dir, jobs.run_airline_counts)


@query
def job_altitude_speed(spark, sf_dir):
    return _job(spark, sf_dir, jobs.run_altitude_speed)


@query
def job_area_duration(spark, sf_dir):
    return _job(spark, sf_dir, jobs.run_area_duration, session_gap=WIDE_GAP)


@query
def job_area_duration_day(spark, sf_dir):
    """One entry date, from the days the job finds it needs."""
    return _job(spark, sf_dir, jobs.run_area_duration_day, RUN_DATE, session_gap=WIDE_GAP)


@query
def job_area_duration_days(spark, sf_dir):
    """Ten entry dates, each day read once; sessions run on for days behind the last."""
    return _job(spark, sf_dir, jobs.run_area_duration_days, *RUN_DATES, session_gap=WIDE_GAP)


@query
def silver_rebuild(spark, sf_dir):
    """Bronze and airline files to the silver table, by the rebuild job."""
    bronze, airlines, silver = (new_path(spark, n) for n in ("bronze", "airlines", "silver"))
    tables.bronze(spark, sf_dir).drop("event_id").write.parquet(bronze)
    tables.raw_airlines(spark, sf_dir).write.options(
        header="false", quote='"', escape='"', nullValue=r"\N"
    ).csv(airlines)
    jobs.rebuild_silver(spark, bronze, airlines, silver)
    return spark.read.parquet(silver)


# --- streams ------------------------------------------------------------------


@query
def stream_bronze(spark, sf_dir):
    messages, bronze, checkpoint = (
        new_path(spark, n) for n in ("messages", "bronze", "bronze-checkpoint")
    )
    encode_envelopes(tables.bronze(spark, sf_dir)).write.text(messages)
    start_bronze(
        envelope_files(spark, messages), bronze, checkpoint, processing_time=None
    ).awaitTermination()
    return spark.read.parquet(bronze)


def _streamed_silver(spark, sf_dir):
    """Silver as a stream over bronze as it is, in several batches, stopped and restarted.

    Copies arrive in one batch, in different batches and again after the restart.
    """
    bronze, silver, checkpoint = (
        new_path(spark, n) for n in ("bronze", "silver", "silver-checkpoint")
    )
    rows = tables.bronze(spark, sf_dir).drop("event_id")
    early = "time < 1705276800"  # the copies of 2024-01-14 and before, in mixed order
    for part in (rows.filter(early).repartition(6), rows.filter(f"not {early}"), rows):
        part.write.mode("append").parquet(bronze)
        start_silver(
            snapshot_files(spark, bronze, max_files_per_trigger=1000),
            lambda: tables.airlines(spark, sf_dir),
            silver,
            checkpoint,
            processing_time=None,
        ).awaitTermination()
    return silver


@query
def stream_silver(spark, sf_dir):
    return read_streamed(spark, _streamed_silver(spark, sf_dir))


@query
def stream_silver_compacted(spark, sf_dir):
    """The streamed table after each of its days is compacted."""
    silver, compacted = _streamed_silver(spark, sf_dir), new_path(spark, "compacted")
    folders = read_streamed(spark, silver).select(*DAY_PARTITION).distinct()
    days = [f"{year}-{month:02}-{day:02}" for year, month, day in folders.collect()]
    compact_silver(spark, silver, compacted, days)
    return spark.read.parquet(compacted)


@query
def stream_silver_shuffled(spark, sf_dir):
    """Bronze in files of mixed times and copies, one file a batch: the rebuild's rows."""
    bronze, silver, checkpoint = (
        new_path(spark, n) for n in ("bronze", "silver", "silver-checkpoint")
    )
    rows = tables.bronze(spark, sf_dir).drop("event_id")
    # Seven files by a digest, so most copies are in another file than the first one.
    spread = F.pmod(F.xxhash64("icao24", "time"), F.lit(7))
    rows.repartitionByRange(7, spread).write.parquet(bronze)
    start_silver(
        snapshot_files(spark, bronze, max_files_per_trigger=1),
        lambda: tables.airlines(spark, sf_dir),
        silver,
        checkpoint,
        processing_time=None,
    ).awaitTermination()
    return read_streamed(spark, silver)


@query
def stream_bronze_rejects(spark, sf_dir):
    """Messages without rows, as the bronze job writes them beside the rows."""
    messages, bronze, rejects, checkpoint = (
        new_path(spark, n) for n in ("messages", "bronze", "rejects", "bronze-checkpoint")
    )
    broken_messages(spark, sf_dir).coalesce(4).write.parquet(messages)
    value = spark.readStream.schema("value string").option("maxFilesPerTrigger", 2)
    start_bronze(
        value.parquet(messages), bronze, checkpoint, processing_time=None, rejects_path=rejects
    ).awaitTermination()
    return spark.read.parquet(rejects).select("value", "reason")


@query
def stream_sessions_backlog(spark, sf_dir):
    """Closed sessions from a stored table whose files hold all times.

    The last day arrives after the stream has caught up.
    """
    table, closed, checkpoint = (
        new_path(spark, n) for n in ("silver", "sessions", "sessions-checkpoint")
    )
    rows = tables.silver(spark, sf_dir).drop("event_id", *DAY_PARTITION)
    last = F.expr("cast(time >= timestamp'2024-01-30 00:00:00' as int)").alias("last")
    silver = f"{table}/last=0"  # the stored table; the rows beside it arrive later
    rows.limit(0).write.parquet(silver)  # the folder is there if all rows are late
    rows.select("*", last).write.mode("append").partitionBy("last").parquet(table)
    finish(catch_up_sessions(spark, silver, closed, checkpoint, rows.schema, lateness_seconds=1))
    arriving = spark.read.parquet(table).filter("last = 1").drop("last")
    arriving.write.mode("append").parquet(silver)
    finish(
        start_watermarked_sessions(
            snapshot_files(spark, silver, rows.schema),
            closed,
            checkpoint,
            lateness_seconds=1,
            processing_time=None,
        )
    )
    return read_closed_sessions(spark, closed)


@query
def stream_sessions(spark, sf_dir):
    """Closed sessions as the session stream keeps them, from a table in order of days."""
    silver, closed, checkpoint = (
        new_path(spark, n) for n in ("silver", "sessions", "sessions-checkpoint")
    )
    write_table(tables.silver(spark, sf_dir).drop("event_id"), silver)
    start_sessions(
        snapshot_files(spark, silver, SILVER, max_files_per_trigger=None),
        closed,
        checkpoint,
        processing_time=None,
    ).awaitTermination()
    return read_sessions(spark, closed)


@query
def stream_sessions_shuffled(spark, sf_dir):
    """The same from 112 files that each hold all times, in four batches, with all defaults."""
    silver, closed, checkpoint = (
        new_path(spark, n) for n in ("silver", "sessions", "sessions-checkpoint")
    )
    rows = tables.silver(spark, sf_dir).drop("event_id", *DAY_PARTITION)
    rows.repartition(112).write.parquet(silver)
    start_sessions(
        snapshot_files(spark, silver, rows.schema, max_files_per_trigger=28),
        closed,
        checkpoint,
        processing_time=None,
    ).awaitTermination()
    return read_sessions(spark, closed)
