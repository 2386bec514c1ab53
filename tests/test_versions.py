"""Versioned rows, and the two streams that keep them, in the orders that go wrong."""

import random
from collections import Counter
from datetime import date

import pytest

from skylattice import scratch
from skylattice.operators.airlines import clean_airlines
from skylattice.operators.dedupe import deduplicate
from skylattice.operators.sessions import build_sessions
from skylattice.plans.silver import build_silver
from skylattice.schemas import SILVER
from skylattice.sources import read_silver, snapshot_files
from skylattice.sources.sinks import batch_stream
from skylattice.streaming import (
    VersionStore,
    compact_sessions,
    compact_silver,
    read_sessions,
    read_streamed,
    start_sessions,
    start_silver,
)
from skylattice.streaming import jobs as stream_jobs, versions
from tests.conftest import instant

BASE = 1_767_225_600  # a midnight in UTC
DAY = 86_400


def store(spark, path, fold_at=3):
    schema = spark.createDataFrame([], "k int, v string").schema
    return VersionStore(spark, path, schema, ("k",), fold_at=fold_at)


def put(spark, kept, number, rows):
    rows = [(k, v, None if day is None else date(2026, 1, day)) for k, v, day in rows]
    kept.append(spark.createDataFrame(rows, "k int, v string, day date").coalesce(1), number)


def content(kept, days, before=None):
    return {(r.k, r.day): (r.v, r.batch) for r in kept.rows(days, before).collect()}


def folder_of(day):
    return versions.NO_DAY if day is None else f"2026-01-{day:02}"


def test_runs_stay_few_and_hold_the_latest_versions(spark, folder):
    kept, rng, want, listed = store(spark, folder()), random.Random(1), {}, []
    days = [folder_of(d) for d in (1, 2, None)]
    for number in range(30):
        kept.fold(days, number)
        rows = {(rng.randrange(6), rng.choice([1, 1, 2, None])) for _ in range(2)} | {(0, 1)}
        put(spark, kept, number, [(k, f"{k}-{number}", day) for k, day in rows])
        want |= {(k, day and date(2026, 1, day)): (f"{k}-{number}", number) for k, day in rows}
        listed.append(len(kept.runs(days[0])))
    assert content(kept, days) == want
    assert set(kept.days()) == set(days)
    # Two runs of each level and the one a batch adds: log(30) levels, however many batches.
    assert max(listed) <= 2 * 4 + 1 and max(listed[15:]) <= max(listed[:15]) + 2
    names = scratch.list_folders(spark, f"{kept.path}/day={days[0]}")
    assert len(names) <= 2 * 4 + 1


def test_a_batch_that_runs_again_sees_what_it_saw(spark, folder, monkeypatch):
    kept = store(spark, folder())
    for number in range(3):
        put(spark, kept, number, [(1, f"v{number}", 1), (number, "own", 2)])
    before = content(kept, ["2026-01-01", "2026-01-02"], 3)

    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(versions, "delete", broken)
        with pytest.raises(OSError):
            kept.fold(["2026-01-01", "2026-01-02"], 3)
    # Folded runs and their parts are there side by side now.
    assert content(kept, ["2026-01-01", "2026-01-02"], 3) == before
    put(spark, kept, 3, [(1, "unfinished", 1)])
    kept.fold(["2026-01-01", "2026-01-02"], 3)
    assert content(kept, ["2026-01-01", "2026-01-02"], 3) == before
    assert [r.folder for r in kept.runs("2026-01-01", 3)] == ["run=1_0_2"]
    put(spark, kept, 3, [(1, "v3", 1)])
    assert content(kept, ["2026-01-01"])[1, date(2026, 1, 1)] == ("v3", 3)


def test_nothing_stored_yet(spark, folder):
    kept = store(spark, folder())
    kept.fold(["2026-01-01"], 0)
    assert kept.days() == [] and kept.rows(["2026-01-01"]).collect() == []
    with pytest.raises(ValueError):
        store(spark, folder(), fold_at=1)


# --- silver ---------------------------------------------------------------------


def streamed_silver(spark, bronze, folder, batches, dimension):
    source, out, checkpoint = folder(), folder(), folder()
    for rows in batches:
        bronze(*rows).coalesce(1).write.mode("append").parquet(source)
        stream = snapshot_files(spark, source)
        start_silver(stream, dimension, out, checkpoint, processing_time=None).awaitTermination()
    return out


def multiset(df):
    columns = sorted(df.columns)
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


def test_silver_in_any_order_is_the_rebuilt_one(spark, bronze, airlines, folder):
    rng = random.Random(5)
    dimension = clean_airlines(airlines({"Airline ID": "1", "Nome": "Gol", "ICAO": "GLO"}))
    rows = []
    for _ in range(120):
        contact = BASE + rng.choice([0, 5, DAY, 3 * DAY, -DAY])
        rows.append(
            {
                "icao24": rng.choice(["a", "b", None]),
                "last_contact": rng.choice([contact, contact, None]),
                # Kept copies of one key may lie on different days.
                "time": contact + rng.choice([0, 0, 30, DAY]),
                "callsign": rng.choice(["GLO1", "XXX", None, " "]),
                "velocity": rng.choice([None, 1.5, -0.0, float("nan")]),
            }
        )
    batches = [rows[i : i + 30] for i in range(0, len(rows), 30)]
    out = streamed_silver(spark, bronze, folder, batches, dimension)
    want = build_silver(bronze(*rows), dimension)
    key = ("icao24", "last_contact", "time", "callsign", "Nome", "year", "month", "day")

    def rows_of(df):
        return multiset(df.selectExpr(*key, "cast(velocity as string) as velocity"))

    assert rows_of(read_streamed(spark, out)) == rows_of(want)
    readable = want.filter("icao24 is not null")
    assert rows_of(read_silver(spark, out)) == rows_of(readable)
    assert spark.read.parquet(out).count() > want.count()
    compacted = folder()
    for year, month, day in {(r.year, r.month, r.day) for r in want.collect()}:
        compact_silver(spark, out, compacted, f"{year}-{month:02}-{day:02}")
    assert rows_of(spark.read.parquet(compacted)) == rows_of(want)


def test_batches_are_planned_like_the_callers_jobs(spark, bronze, folder):
    """A small batch's shuffles, kept tables too, are cut to its size; Spark's streams are not."""
    source, parts = folder(), []
    bronze(*({"icao24": f"a{n}", "last_contact": BASE} for n in range(50))).write.parquet(source)

    def write(batch, number):
        kept = deduplicate(batch).persist()
        parts.append(kept.rdd.getNumPartitions())
        kept.unpersist()

    batch_stream(snapshot_files(spark, source), write, folder(), None).awaitTermination()
    assert parts == [1]


def test_all_versions_of_a_day(spark, folder):
    """For the silver stream, which finds the latest in the shuffle of its batch."""
    kept = store(spark, folder())
    assert kept.versions([folder_of(1)]) is None
    put(spark, kept, 0, [(1, "old", 1)])
    put(spark, kept, 1, [(1, "new", 1)])
    found = kept.versions([folder_of(1), folder_of(2)]).collect()
    assert sorted((r.v, r.batch) for r in found) == [("new", 1), ("old", 0)]
    assert [r.v for r in kept.versions([folder_of(1)], before=1).collect()] == ["old"]


def test_days_are_compacted_in_one_job(spark, bronze, airlines, folder):
    dimension = clean_airlines(airlines({"Airline ID": "1", "Nome": "Gol", "ICAO": "GLO"}))
    rows = [
        {"icao24": "a", "last_contact": at, "time": at + late, "callsign": "GLO1"}
        for at in (BASE, BASE + DAY, BASE + 2 * DAY)
        for late in (30, 0)
    ]
    out = streamed_silver(spark, bronze, folder, [rows[::2], rows[1::2]], dimension)
    days = [str(r[0]) for r in read_streamed(spark, out).selectExpr("to_date(time)").collect()]
    compacted = folder()
    assert compact_silver(spark, out, compacted, days[:2]).rows == 2
    assert compact_silver(spark, out, compacted, days[1:]).rows == 2
    assert multiset(spark.read.parquet(compacted)) == multiset(build_silver(bronze(*rows), dimension))


def test_an_earlier_copy_without_call_sign_takes_the_row_away(spark, bronze, airlines, folder):
    row = {"icao24": "a", "last_contact": BASE, "time": BASE + 60, "callsign": "GLO1"}
    batches = [[row], [{**row, "time": BASE, "callsign": None}], [{**row, "time": BASE + 30}]]
    out = streamed_silver(spark, bronze, folder, batches, airlines({"ICAO": "GLO"}))
    assert read_streamed(spark, out).collect() == []


def test_silver_batch_that_failed_half_way(spark, bronze, airlines, folder, monkeypatch):
    dimension = clean_airlines(airlines({"ICAO": "GLO", "Nome": "Gol"}))
    source, out, checkpoint = folder(), folder(), folder()
    row = {"icao24": "a", "last_contact": BASE, "time": BASE + 60, "callsign": "GLO1"}
    bronze(row).write.parquet(source)

    def run():
        stream = snapshot_files(spark, source)
        start_silver(stream, dimension, out, checkpoint, processing_time=None).awaitTermination()

    run()
    bronze({**row, "time": BASE}, {**row, "icao24": "b"}).write.mode("append").parquet(source)
    whole = stream_jobs.write_table

    def broken(rows, path, *rest):
        if path == out:
            raise OSError("lost after keys and retractions were written")
        return whole(rows, path, *rest)

    with monkeypatch.context() as patch:
        patch.setattr(stream_jobs, "write_table", broken)
        with pytest.raises(Exception):
            run()
    run()
    got = read_streamed(spark, out).selectExpr("icao24", "unix_timestamp(time) as t").collect()
    assert sorted(map(tuple, got)) == [("a", BASE), ("b", BASE + 60)]


# --- sessions ---------------------------------------------------------------------

COLUMNS = ("icao24", "entry_ts", "exit_ts", "has_exit", "airline_name", "airline_icao",
           "duration_seconds", "date", "year", "month", "day")


def streamed_sessions(spark, silver, folder, batches, gap=1800):
    source, out, checkpoint = folder(), folder(), folder()
    for rows in batches:
        silver(*rows).coalesce(1).write.mode("append").parquet(source)
        stream = snapshot_files(spark, source, SILVER)
        start_sessions(stream, out, checkpoint, gap, processing_time=None).awaitTermination()
    return out


def seen(aircraft, offset, name=None, code=None):
    return {"time": instant(BASE + offset), "icao24": aircraft, "Nome": name, "ICAO": code}


def check_sessions(spark, silver, out, rows, gap=1800):
    batch = build_sessions(silver(*rows).filter("icao24 is not null and time is not null"), gap)
    got = read_sessions(spark, out, closed=False).select(*COLUMNS)
    assert multiset(got) == multiset(batch.select(*COLUMNS))
    closed = read_sessions(spark, out).select(*COLUMNS)
    assert multiset(closed) == multiset(batch.filter("has_exit = 1").select(*COLUMNS))


def test_sessions_in_any_order_are_the_batch_ones(spark, silver, folder):
    rng = random.Random(7)
    rows = [
        seen(
            rng.choice(["a", "b", "c", None]), rng.choice([0, DAY, 2 * DAY]) + rng.randrange(14_000),
            rng.choice(["N", "M", None]), rng.choice(["C", None]),
        )
        for _ in range(90)
    ]
    rows.append({"time": None, "icao24": "a"})
    batches = [rows[i : i + 19] for i in range(0, len(rows), 19)]
    out = streamed_sessions(spark, silver, folder, batches)
    check_sessions(spark, silver, out, rows)


def test_late_snapshots_join_sessions_over_midnight(spark, silver, folder):
    ends = [seen("a", -4000, "Old"), seen("a", 3 * DAY + 9), seen("b", 5 * DAY)]
    bridge = [seen("a", s, "Bridge", "B") for s in range(-2200, 3 * DAY, 1800)]
    rows = ends + bridge
    rng = random.Random(3)
    rng.shuffle(bridge)
    out = streamed_sessions(spark, silver, folder, [ends, bridge[:70], bridge[70:], [seen("c", 0)]])
    check_sessions(spark, silver, out, rows + [seen("c", 0)])
    first = read_sessions(spark, out, ["2025-12-31"]).collect()
    assert [(r.airline_name, r.duration_seconds) for r in first] == [("Old", 4009 + 3 * DAY)]
    compacted = folder()
    for _ in range(2):
        compact_sessions(spark, out, compacted, "2025-12-31")
    assert spark.read.parquet(compacted).count() == 1


def test_sessions_keep_their_gap(spark, silver, folder):
    source, out, checkpoint = folder(), folder(), folder()
    silver(seen("a", 0), seen("b", 9000)).write.parquet(source)

    def run(gap):
        stream = snapshot_files(spark, source, SILVER)
        start_sessions(stream, out, checkpoint, gap, processing_time=None).awaitTermination()

    run(60)
    silver(seen("a", 50)).write.mode("append").parquet(source)
    with pytest.raises(Exception, match="gap of 60"):
        run(61)
    run(60)
    assert [r.duration_seconds for r in read_sessions(spark, out).collect()] == [50]


def test_batches_without_aircraft(spark, silver, folder):
    out = streamed_sessions(spark, silver, folder, [[seen(None, 0)], [seen("a", 5)]])
    assert read_sessions(spark, out).collect() == []
    assert read_sessions(spark, out, closed=False).count() == 1
