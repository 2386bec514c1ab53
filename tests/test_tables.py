"""Readers, writers and the batch jobs."""

from collections import Counter
from pathlib import Path

import pytest

from skylattice import scratch
from skylattice.operators.sessions import build_sessions
from skylattice.plans import carry, jobs, marts
from skylattice.sources import (
    kafka_envelopes,
    kafka_options,
    read_silver,
    send_envelopes,
    stored_schema,
    write_table,
)
from tests.conftest import at, plan_of

SF_DIR = "/root/testdata/sf0.001"


def rows_of(df):
    return Counter(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())


@pytest.fixture(scope="module")
def silver_path(spark, tmp_path_factory):
    from skylattice import driver_tables

    path = str(tmp_path_factory.mktemp("silver") / "table")
    write_table(driver_tables.silver(spark, SF_DIR).drop("event_id"), path)
    return path


# --- reader -------------------------------------------------------------------


def test_run_date_prunes_partitions_and_keeps_its_rows(spark, silver_path):
    day = read_silver(spark, silver_path, run_date="2024-01-15")
    plan = plan_of(day)
    assert "PartitionFilters: [" in plan and "make_date" in plan
    assert "PartitionFilters: []" not in plan
    everything = spark.read.parquet(silver_path).filter("icao24 is not null")
    assert rows_of(day) == rows_of(everything.filter("to_date(time) = date'2024-01-15'"))


@pytest.mark.parametrize("zone", ["Pacific/Kiritimati", "Etc/GMT+12"])
def test_pruning_is_safe_for_the_outermost_zones(spark, silver, folder, zone):
    """Folders written in one zone, a date asked for in another."""
    hours = [{"time": at(f"2026-03-{d:02} {h:02}:30"), "icao24": "a", "year": 0, "month": 0, "day": 0}
             for d in range(1, 8) for h in range(24)]
    path = folder()
    other = "Etc/GMT+12" if zone == "Pacific/Kiritimati" else "Pacific/Kiritimati"
    from skylattice.session import session_zone

    with session_zone(spark, other):
        df = silver(*hours).drop("year", "month", "day")
        write_table(marts.with_calendar(df).drop("date", "hour"), path)
    with session_zone(spark, zone):
        assert read_silver(spark, path, run_date="2026-03-04").count() == 24


def test_contract(spark, silver_path, folder):
    with pytest.raises(ValueError, match=r"\['a_column', 'another'\]"):
        read_silver(spark, silver_path, ("another", "a_column", "Nome"))
    wall_clock = folder()
    spark.sql("select timestamp_ntz'2026-01-01 00:00' as time, 'a' as icao24, 1 as year, 1 as month, 1 as day").write.parquet(wall_clock)
    with pytest.raises(TypeError, match="timestamp_ntz"):
        read_silver(spark, wall_clock)
    with pytest.raises(RuntimeError, match="nowhere"):
        read_silver(spark, folder("nowhere"))


def test_bad_date_is_an_error(spark, silver_path):
    with pytest.raises(Exception, match="(?i)date"):
        read_silver(spark, silver_path, run_date="2024-13-45").count()


def test_rows_without_aircraft_or_time_are_left_out(spark, silver, folder):
    path = folder()
    t = at("2026-01-01 00:00")
    day = {"year": 2026, "month": 1, "day": 1}
    silver(
        {"time": t, "icao24": "a", **day}, {"time": t, **day}, {"icao24": "b", **day}
    ).write.parquet(path)
    assert [r.icao24 for r in read_silver(spark, path).collect()] == ["a"]
    assert "icao24" in stored_schema(spark, path).names


def test_only_needed_columns_are_read(spark, silver_path):
    plan = plan_of(marts.aircraft_activity(read_silver(spark, silver_path)))
    schema = next(line for line in plan.splitlines() if line.startswith("ReadSchema"))
    assert schema.count(":") == 1 + 3 and "on_ground" in schema
    assert "IsNotNull(icao24)" in plan


# --- writer -------------------------------------------------------------------


def test_write_counts_rows_and_replaces(spark, folder):
    path = folder()
    df = spark.sql("select id, id % 3 as day from range(10)")
    result = write_table(df, path, ["day"])
    assert result.rows == 10 and "10 rows" in result.describe("x") and "day" in result.describe("x")
    assert write_table(df.filter("day = 1"), path, ["day"], replace="dynamic").rows == 3
    assert spark.read.parquet(path).count() == 10
    assert write_table(df.filter("day = 1"), path, ["day"]).rows == 3
    assert spark.read.parquet(path).count() == 3
    with pytest.raises(ValueError):
        write_table(df, path, ["day"], replace="all")


def test_small_partitions_get_one_file(spark, folder):
    path = folder()
    write_table(spark.range(0, 1000, 1, 8).selectExpr("id", "id % 2 as day"), path, ["day"])
    assert len(list(Path(path).glob("day=*/*.parquet"))) == 2


def test_a_large_partition_is_split_over_files(spark, folder):
    path, key = folder(), "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "64k")
    try:
        df = spark.range(0, 90_000, 1, 8).selectExpr("id", "if(id % 3 < 2, 0, 1 + id % 5) as day")
        assert write_table(df, path, ["day"]).rows == 90_000
    finally:
        spark.conf.set(key, before)
    files = {d.name: len(list(d.glob("*.parquet"))) for d in Path(path).glob("day=*")}
    assert files["day=0"] > 3
    assert spark.read.parquet(path).count() == 90_000


def test_empty_result_is_written(spark, folder):
    assert write_table(spark.range(0).selectExpr("id", "id as day"), folder(), ["day"]).rows == 0


# --- jobs ---------------------------------------------------------------------


def test_all_reports_equal_the_single_jobs(spark, silver_path, folder):
    together = folder("marts")
    run = jobs.generate_all_reports(spark, silver_path, together)
    single = {name: folder(name) for name in run.written}
    jobs.run_aircraft_activity(spark, silver_path, single["aircraft_activity"])
    jobs.run_airline_counts(spark, silver_path, single["airline_counts"])
    jobs.run_altitude_speed(spark, silver_path, single["altitude_speed"])
    alone = jobs.run_area_duration(spark, silver_path, single["monitored_area_duration"])
    for name, path in single.items():
        rows = rows_of(spark.read.parquet(f"{together}/{name}"))
        assert rows == rows_of(spark.read.parquet(path)), name
        assert run.written[name].rows == sum(rows.values())
    assert run.quality == alone.quality
    assert run.quality["sessions_total"] > 0
    assert "session quality" in run.describe()


def test_one_date_replaces_only_its_day(spark, silver_path, folder):
    out = folder("marts")
    jobs.generate_all_reports(spark, silver_path, out)
    before = {n: rows_of(spark.read.parquet(f"{out}/{n}")) for n in jobs.REPORT_COLUMNS}
    jobs.generate_all_reports(spark, silver_path, out, run_date="2024-01-15")
    for name in ("aircraft_activity", "airline_counts", "altitude_speed"):
        assert rows_of(spark.read.parquet(f"{out}/{name}")) == before[name]
    activity = folder("activity")
    run = jobs.run_aircraft_activity(spark, silver_path, activity, run_date="2024-01-15")
    assert 0 < run.written["aircraft_activity"].rows <= 24


def test_a_day_without_rows_is_emptied(spark, silver, silver_path, folder):
    out, corrected = folder("marts"), folder("silver")
    jobs.generate_all_reports(spark, silver_path, out)
    emptied = spark.read.parquet(silver_path).filter("to_date(time) <> date'2024-01-15'")
    write_table(emptied, corrected)
    run = jobs.generate_all_reports(spark, corrected, out, run_date="2024-1-15")
    assert run.quality["sessions_total"] == 0
    for name in jobs.REPORT_COLUMNS:
        mart = spark.read.parquet(f"{out}/{name}")
        assert mart.filter("month = 1 and day = 15").count() == 0
        assert name == "monitored_area_duration" or mart.count() > 0


def test_bad_date_stops_a_job(spark, silver_path, folder):
    with pytest.raises(Exception, match="2024-13-45"):
        jobs.run_aircraft_activity(spark, silver_path, folder(), run_date="2024-13-45")


def test_area_duration_of_one_date_sees_the_whole_history(spark, silver_path, folder):
    all_days, one_day = folder(), folder()
    full = jobs.run_area_duration(spark, silver_path, all_days, session_gap=6 * 3600)
    dated = jobs.run_area_duration(
        spark, silver_path, one_day, run_date="2024-01-15", session_gap=6 * 3600
    )
    wanted = spark.read.parquet(all_days).filter("date = date'2024-01-15'")
    assert rows_of(spark.read.parquet(one_day)) == rows_of(wanted)
    assert full.quality == dated.quality


@pytest.mark.parametrize(
    "zone, gap", [("UTC", 6 * 3600), ("America/Sao_Paulo", 1800), ("UTC", 3 * 86_400)]
)
def test_area_duration_day_equals_the_whole_history(spark, silver_path, folder, zone, gap):
    """Also where sessions run for many days, past what is read at first."""
    everything = folder()
    jobs.run_area_duration(spark, silver_path, everything, timezone=zone, session_gap=gap)
    expected = spark.read.parquet(everything)
    for date in ("2024-01-02", "2024-01-15", "2024-01-30"):
        wanted = rows_of(expected.filter(f"date = date'{date}'"))
        out = folder()
        run = jobs.run_area_duration_day(spark, silver_path, out, date, zone, gap)
        assert run.written["monitored_area_duration"].rows == sum(wanted.values())
        if wanted:
            assert rows_of(spark.read.parquet(out)) == wanted


def test_area_duration_days_equal_the_whole_history(spark, silver_path, folder):
    """Also over the whole table and beyond both of its ends."""
    gap, everything = 6 * 3600, folder()
    jobs.run_area_duration(spark, silver_path, everything, session_gap=gap)
    expected = spark.read.parquet(everything)
    for first, last in (
        ("2024-01-08", "2024-01-12"), ("2023-12-30", "2024-02-02"), ("2024-01-29", "2024-01-30"),
    ):
        wanted = rows_of(expected.filter(f"date between date'{first}' and date'{last}'"))
        out = folder()
        run = jobs.run_area_duration_days(
            spark, silver_path, out, first, last, session_gap=gap
        )
        assert run.written["monitored_area_duration"].rows == sum(wanted.values()) > 0
        assert rows_of(spark.read.parquet(out)) == wanted


def test_area_duration_days_replace_their_days_only(spark, silver_path, folder):
    out, corrected = folder(), folder()
    jobs.run_area_duration(spark, silver_path, out, session_gap=6 * 3600)
    before = rows_of(spark.read.parquet(out).filter("day not between 14 and 16"))
    rest = spark.read.parquet(silver_path).filter("to_date(time) <> date'2024-01-15'")
    write_table(rest, corrected)
    jobs.run_area_duration_days(
        spark, corrected, out, "2024-01-14", "2024-1-16", session_gap=600
    )
    after = spark.read.parquet(out)
    assert rows_of(after.filter("day not between 14 and 16")) == before
    assert after.filter("day = 15").count() == 0


def test_a_range_of_dates_that_is_none_stops_the_job(spark, silver_path, folder):
    with pytest.raises(ValueError, match="range"):
        jobs.run_area_duration_days(spark, silver_path, folder(), "2024-01-02", "2024-01-01")


def _flights(spark, folder, *sightings):
    path = folder()
    rows = [(at(time), aircraft, None, None) for aircraft, *times in sightings for time in times]
    df = spark.createDataFrame(rows, "time timestamp, icao24 string, Nome string, ICAO string")
    write_table(marts.with_calendar(df).drop("date", "hour"), path)
    return path


def _steps(spark, silver, first, last, gap, folder, monkeypatch):
    """Sessions, and the spans of days read for them with the lead of each."""
    read, whole = [], carry.snapshots_between

    def noted(silver, day, start, end, lead_seconds=0):
        read.append((start, end, lead_seconds))
        return whole(silver, day, start, end, lead_seconds)

    monkeypatch.setattr(carry, "snapshots_between", noted)
    found = carry.entered_between(read_silver(spark, silver, ("Nome", "ICAO")), first, last, gap, folder())
    rows = sorted((r.icao24, str(r.entry_ts), str(r.exit_ts), r.has_exit) for r in found.collect())
    return rows, read


def test_days_are_read_once_and_only_as_far_as_sessions_run(spark, folder, monkeypatch):
    silver = _flights(
        spark, folder,
        ("before", "2026-03-01 23:50", "2026-03-02 00:10", "2026-03-02 00:35"),
        ("over", "2026-03-02 23:40", "2026-03-03 00:05", "2026-03-03 00:30"),
        ("edge", "2026-03-02 12:00", "2026-03-02 12:30", "2026-03-02 13:00:01"),
        ("next", "2026-03-03 10:00"),
        ("later", "2026-03-09 10:00"),
    )
    rows, read = _steps(spark, silver, "2026-03-02", "2026-03-02", 1800, folder, monkeypatch)
    assert rows == [
        ("edge", "2026-03-02 12:00:00", "2026-03-02 12:30:00", 1),
        ("edge", "2026-03-02 13:00:01", "2026-03-02 13:00:01", 1),
        ("over", "2026-03-02 23:40:00", "2026-03-03 00:30:00", 1),
    ]
    assert read == [(0, 1, 1800), (1, 2, 0)]


def test_the_end_of_the_data_leaves_sessions_open(spark, folder, monkeypatch):
    silver = _flights(
        spark, folder,
        ("a", "2026-03-02 10:00", "2026-03-02 10:20"),
        ("b", "2026-03-02 10:30", "2026-03-02 10:50"),
    )
    rows, read = _steps(spark, silver, "2026-03-02", "2026-03-04", 1800, folder, monkeypatch)
    # Exactly the gap before the end of the data is not yet an exit.
    assert [r[3] for r in rows] == [0, 0]
    assert read == [(0, 1, 1800), (0, 1, 1800)]
    assert _steps(spark, silver, "2026-03-02", "2026-03-02", 1799, folder, monkeypatch)[0][0][3] == 1


def test_a_session_of_many_days_is_carried(spark, folder, monkeypatch):
    hours = [f"2026-03-{d:02} {h:02}:15" for d in range(2, 8) for h in range(24)]
    silver = _flights(spark, folder, ("a", *hours), ("b", "2026-03-05 10:00"), ("c", "2026-03-20 10:00"))
    rows, read = _steps(spark, silver, "2026-03-01", "2026-03-02", 3600, folder, monkeypatch)
    assert rows == [("a", "2026-03-02 00:15:00", "2026-03-07 23:15:00", 1)]
    assert read == [(0, 1, 3600)] + [(n, n + 1, 0) for n in range(1, 8)]


def test_day_spans_read_few_partitions(spark, silver_path):
    near = carry.snapshots_between(read_silver(spark, silver_path), "2024-01-15", 0, 1, 1800)
    days = {path.split("/day=")[1].split("/")[0] for path in _scanned(near)}
    assert days <= {str(d) for d in range(12, 19)}


def _scanned(df):
    """Files left after partition pruning."""
    names = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    plan = plan_of(df)
    assert "PartitionFilters: []" not in plan and names.size() == 1
    rows = df.select("_metadata.file_path").distinct().collect()
    return [r.file_path for r in rows]


def test_job_zone_is_used_and_given_back(spark, silver_path, folder):
    out = folder()
    jobs.run_aircraft_activity(spark, silver_path, out, timezone="Asia/Tokyo")
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    tokyo = spark.read.parquet(out).agg({"date": "max"}).first()[0]
    assert str(tokyo) == "2024-01-31"


def test_rollup_reports_in_a_half_hour_zone(spark, silver_path):
    from skylattice.session import session_zone

    with session_zone(spark, "Asia/Kolkata"):
        silver = read_silver(spark, silver_path)
        reports, sessions = jobs.reports_from_rollup(jobs.hourly_rollup(silver))
        assert rows_of(reports["aircraft_activity"]) == rows_of(marts.aircraft_activity(silver))
        assert rows_of(reports["airline_counts"]) == rows_of(marts.airline_counts(silver))
        assert rows_of(reports["altitude_speed"]) == rows_of(marts.altitude_speed(silver))
        assert rows_of(sessions) == rows_of(build_sessions(silver))


# --- scratch ------------------------------------------------------------------


def test_scratch_uses_the_configured_folder_and_cleans_up(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    with scratch.scratch_table(spark, "x") as path:
        assert path.startswith(shared)
        spark.range(3).write.parquet(path)
        assert Path(path).exists()
    assert not Path(path).exists()


class _Session:
    """Just what the folder lookup asks a session for."""

    def __init__(self, master, configured=None, checkpoint_dir=None):
        self.conf = {"spark.checkpoint.dir": configured} if configured else {}
        self.sparkContext = self
        self.master = master
        self.checkpoint_dir = checkpoint_dir

    def getCheckpointDir(self):
        return self.checkpoint_dir

    def setCheckpointDir(self, folder):
        self.checkpoint_dir = folder


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.shared_folder(_Session("yarn"))
    assert scratch.shared_folder(_Session("yarn", configured="s3a://b/x/")) == "s3a://b/x"
    assert scratch.shared_folder(_Session("yarn", checkpoint_dir="hdfs:/x")) == "hdfs:/x"
    local = _Session("local[2]")
    assert scratch.shared_folder(local) == local.checkpoint_dir


# --- topic --------------------------------------------------------------------


def test_topic_options(monkeypatch):
    monkeypatch.delenv("KAFKA_BOOTSTRAP_SERVERS", raising=False)
    options = kafka_options(max_offsets_per_trigger=None)
    assert options == {
        "kafka.bootstrap.servers": "kafka:29092",
        "subscribe": "plane_data",
        "startingOffsets": "earliest",
    }
    monkeypatch.setenv("KAFKA_BOOTSTRAP_SERVERS", "broker:1")
    assert kafka_options()["kafka.bootstrap.servers"] == "broker:1"
    assert kafka_options(servers="s:2", max_offsets_per_trigger=5)["maxOffsetsPerTrigger"] == "5"
    assert "maxOffsetsPerTrigger" not in kafka_options()


def test_missing_connector_is_reported(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_envelopes(spark)
    with pytest.raises(Exception, match="(?i)kafka"):
        send_envelopes(spark.createDataFrame([("{}",)], "value string"))
