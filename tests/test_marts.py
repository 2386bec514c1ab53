import pytest
from pyspark.sql import functions as F

from skylattice.operators.filters import inside_area, on_date
from skylattice.operators.sessions import build_sessions
from skylattice.plans import marts
from tests.conftest import at, plan_of


def test_activity_counts_distinct_airborne_aircraft(snapshots):
    def active(**options):
        report = marts.aircraft_activity(snapshots, **options)
        return {r.hour: r.active_aircraft_count for r in report.collect()}

    assert active() == {6: 2, 7: 1}
    assert active(only_airborne=False) == {6: 4, 7: 1}


def test_unknown_ground_state_is_not_airborne(silver):
    df = silver({"time": at("2026-01-01 00:00"), "icao24": "x", "on_ground": None})
    assert marts.aircraft_activity(df).count() == 0


def test_airlines_count_aircraft_and_not_snapshots(snapshots):
    report = marts.airline_counts(snapshots).collect()
    counted = {r.airline_icao: (r.airline_name, r.aircraft_count) for r in report}
    assert counted == {"NRT": ("Norte", 2), "SUL": ("Sul", 1), "N/A": ("Desconhecida", 1)}


def test_blank_and_missing_labels_are_replaced(silver):
    t = at("2026-01-01 00:00")
    df = silver(
        {"time": t, "icao24": "a", "Nome": "  ", "ICAO": None},
        {"time": t, "icao24": "b", "Nome": None, "ICAO": ""},
        {"time": t, "icao24": "b", "Nome": " X ", "ICAO": " Y "},
    )
    rows = marts.airline_counts(df).collect()
    assert {(r.airline_name, r.airline_icao, r.aircraft_count) for r in rows} == {
        ("Desconhecida", "N/A", 2),
        ("X", "Y", 1),
    }


def test_airline_counts_names_missing_columns(snapshots):
    with pytest.raises(ValueError, match=r"\['Operator', 'Other'\]"):
        marts.airline_counts(snapshots, "Other", "Operator")


def test_means_ignore_nulls_and_include_ground_rows(snapshots):
    early, late = marts.altitude_speed(snapshots).orderBy("hour").collect()
    assert (early.avg_altitude, early.altitude_observations) == (4550.0, 6)
    assert (early.avg_velocity, early.velocity_observations) == (104.9, 5)
    assert (late.avg_altitude, late.altitude_observations) == (None, 0)
    assert (late.avg_velocity, late.velocity_observations) == (190.0, 1)


def test_mean_of_nothing_is_null(silver):
    df = silver({"time": at("2026-01-01 00:00"), "icao24": "x"})
    row = marts.altitude_speed(df).first()
    assert row.avg_altitude is None and row.altitude_observations == 0


def test_area_duration_uses_closed_sessions_with_a_length(snapshots):
    report, sessions = marts.monitored_area_duration(snapshots)
    lengths = {(r.icao24, r.has_exit): r.duration_seconds for r in sessions.collect()}
    assert lengths == {
        ("k1", 1): 1500, ("k1", 0): 0, ("k2", 1): 120, ("k3", 1): 1140, ("k4", 1): 0,
    }
    assert [tuple(r)[-2:] for r in report.collect()] == [(920.0, 3)]


def test_quality_counters(snapshots):
    sessions = build_sessions(snapshots)
    names = ("total", "closed", "open", "discarded_non_positive")
    expected = dict(zip((f"sessions_{n}" for n in names), (5, 4, 1, 1)))
    assert marts.session_quality(sessions).first().asDict() == expected
    assert marts.session_quality_basic(sessions).columns == list(expected)[:3]


def test_quality_of_no_sessions(snapshots):
    row = marts.session_quality(build_sessions(snapshots.filter("false"))).first()
    assert tuple(row) == (0, None, None, None)


def test_run_date_after_sessions_keeps_a_session_over_midnight_whole(silver):
    def seen(text):
        return {"time": at(text), "icao24": "a"}

    df = silver(
        seen("2026-01-01 23:50"), seen("2026-01-02 00:10"), seen("2026-01-02 12:00"),
        seen("2026-01-02 12:05"), seen("2026-01-03 12:00"),
    )
    whole, _ = marts.monitored_area_duration(df, run_date="2026-01-01")
    assert [tuple(r)[-2:] for r in whole.collect()] == [(1200.0, 1)]
    # Cut at midnight, the first half has no length and the day no used session.
    cut, _ = marts.monitored_area_duration(on_date(df, "2026-01-01"))
    assert cut.count() == 0


def test_empty_run_date_keeps_everything(snapshots):
    assert on_date(snapshots, "").count() == on_date(snapshots, None).count() == 8


def test_area_borders_are_inside(spark):
    df = spark.createDataFrame(
        [(-24.10, -47.20), (-23.20, -46.20), (-24.11, -47.0), (-24.0, -46.19), (None, -47.0)],
        "latitude double, longitude double",
    )
    assert inside_area(df).count() == 2


def test_distinct_counts_are_aggregated_before_each_shuffle(snapshots):
    plan = plan_of(marts.airline_counts(snapshots))
    tree = plan.split("\n\n\n")[0]
    # Per group and aircraft, then per group; each has a partial step before its shuffle.
    assert (tree.count("HashAggregate"), tree.count("Exchange")) == (4, 2)
    assert "SinglePartition" not in plan


def test_local_hours_follow_the_session_zone(spark, silver):
    df = silver({"time": at("2026-01-01 01:30"), "icao24": "a", "on_ground": False})
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        row = marts.aircraft_activity(df).select(F.col("date").cast("string"), "hour").first()
        assert tuple(row) == ("2025-12-31", 22)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
