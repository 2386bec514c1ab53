"""Streams run to the end of their input and are compared with the batch form."""

import json
from collections import Counter
from pathlib import Path

import pytest

from skylattice.operators.airlines import clean_airlines
from skylattice.operators.envelopes import decode_envelopes
from skylattice.operators.sessions import build_sessions
from skylattice.plans import jobs
from skylattice.plans.silver import build_silver
from skylattice.schemas import BRONZE, SILVER
from skylattice.sources import envelope_files, snapshot_files
from skylattice.streaming import finish as strict
from skylattice.streaming import (
    read_sessions,
    read_streamed,
    start_bronze,
    start_sessions,
    start_silver,
    start_watermarked_sessions,
)
from tests.conftest import instant

BASE = 1_767_225_600


def finish(query):
    query.awaitTermination()
    assert query.exception() is None


def write_messages(path, *messages):
    Path(path).mkdir(exist_ok=True)
    number = len(list(Path(path).iterdir()))
    lines = "\n".join(m if isinstance(m, str) else json.dumps(m) for m in messages)
    (Path(path) / f"{number}.json").write_text(lines + "\n")


def poll(time, *aircraft):
    return {"time": time, "states": [{"icao24": a, "last_contact": time} for a in aircraft]}


def test_bronze_goes_on_where_it_stopped(spark, folder):
    messages, bronze, checkpoint = folder(), folder(), folder()

    def run():
        finish(start_bronze(envelope_files(spark, messages), bronze, checkpoint, None))

    write_messages(messages, poll(1, "a", "b"), "broken {", poll(2))
    run()
    write_messages(messages, poll(3, "c"))
    run()
    run()
    result = spark.read.parquet(bronze)
    assert result.schema.simpleString() == BRONZE.simpleString()
    assert sorted((r.time, r.icao24) for r in result.collect()) == [(1, "a"), (1, "b"), (3, "c")]
    batch = decode_envelopes(spark.read.text(messages))
    assert Counter(result.collect()) == Counter(batch.collect())


def test_silver_starts_before_bronze_has_data(spark, bronze, airlines, folder):
    source, out, checkpoint = folder(), folder(), folder()
    Path(source).mkdir()
    dimension = clean_airlines(airlines({"Airline ID": "1", "Nome": "Gol", "ICAO": "GLO"}))

    def run(within=None):
        stream = snapshot_files(spark, source)
        finish(start_silver(stream, dimension, out, checkpoint, within, processing_time=None))

    run()
    row = {"icao24": "a", "last_contact": BASE, "time": BASE, "callsign": "GLO1"}
    bronze(row, {**row, "icao24": "b", "callsign": None}).write.mode("append").parquet(source)
    run()
    # A repeat much later in event time, and the same key with a call sign at last.
    bronze(
        {**row, "time": BASE + 10_000_000}, {**row, "icao24": "b"}, {**row, "last_contact": 1, "time": 1}
    ).write.mode("append").parquet(source)
    run()
    result = spark.read.parquet(out)
    # Nothing is late: the very old snapshot is in.
    assert sorted((r.icao24, r.last_contact, r.Nome) for r in result.collect()) == [
        ("a", 1, "Gol"), ("a", BASE, "Gol"),
    ]
    assert {f.name for f in Path(out).iterdir() if f.name.startswith("year=")} == {
        "year=1970", "year=2026",
    }


def test_exact_mode_remembers_keys(spark, bronze, airlines, folder):
    source, out, checkpoint = folder(), folder(), folder()
    row = {"icao24": "a", "last_contact": 5, "time": 5, "callsign": "x"}
    for _ in range(2):
        bronze(row, row, {**row, "icao24": None}).write.mode("append").parquet(source)
        stream = snapshot_files(spark, source)
        finish(
            start_silver(stream, airlines({"ICAO": "GLO"}), out, checkpoint, None, processing_time=None)
        )
    assert spark.read.parquet(out).count() == 2


def test_rebuild_replaces_a_streamed_silver(spark, bronze, airlines, folder):
    source, dim, out, checkpoint = folder(), folder(), folder(), folder()
    row = {"icao24": "a", "last_contact": 5, "time": 5, "callsign": "GLO1"}
    bronze(row).write.parquet(source)
    airlines({"Airline ID": "1", "Nome": "Gol", "ICAO": "GLO"}).write.csv(dim, nullValue=r"\N")
    dimension = clean_airlines(airlines({"ICAO": "GLO"}))
    finish(start_silver(snapshot_files(spark, source), dimension, out, checkpoint, processing_time=None))
    bronze({**row, "last_contact": 6}, row).write.mode("append").parquet(source)
    assert jobs.rebuild_silver(spark, source, dim, out).rows == 2
    rebuilt = spark.read.parquet(out)
    assert sorted((r.last_contact, r.Nome) for r in rebuilt.collect()) == [(5, "Gol"), (6, "Gol")]


def seen(aircraft, *offsets):
    return [
        {"time": instant(BASE + o), "icao24": aircraft, "Nome": "N", "ICAO": None} for o in offsets
    ]


def closed_by_stream(spark, silver, folder, batches, lateness=None, gap=1800):
    """Sessions after the batches; with a lateness by the watermarked stream."""
    source, out, checkpoint = folder(), folder(), folder()
    for rows in batches:
        silver(*rows).write.mode("append").parquet(source)
        stream = snapshot_files(spark, source, SILVER)
        if lateness is None:
            strict(start_sessions(stream, out, checkpoint, gap, processing_time=None))
        else:
            strict(
                start_watermarked_sessions(
                    stream, out, checkpoint, gap, lateness_seconds=lateness, processing_time=None
                )
            )
    return read_sessions(spark, out) if lateness is None else spark.read.schema(SESSIONS).parquet(out)


SESSIONS = (
    "icao24 string, entry_ts timestamp, exit_ts timestamp, has_exit int, airline_name string, "
    "duration_seconds bigint"
)
SESSION_COLUMNS = ("icao24", "entry_ts", "exit_ts", "has_exit", "airline_name", "duration_seconds")


@pytest.mark.parametrize("lateness", [None, 1])
@pytest.mark.parametrize("later, closed", [(1800, 0), (1801, 1)])
def test_session_closes_strictly_after_the_gap(spark, silver, folder, later, closed, lateness):
    batches = [seen("a", 0) + seen("b", later)]
    result = closed_by_stream(spark, silver, folder, batches, lateness)
    assert result.filter("icao24 = 'a'").count() == closed


def test_stream_sessions_equal_closed_batch_sessions(spark, silver, folder):
    first = seen("a", 0, 600, 2400, 4201) + seen("b", 10, 1811)
    second = seen("a", 4300, 9000) + seen("c", 20_000) + seen(None, 19_000)
    for lateness in (None, 1, 900):
        result = closed_by_stream(spark, silver, folder, [first, second], lateness)
        batch = build_sessions(silver(*first, *second).filter("icao24 is not null"))
        expected = batch.filter("has_exit = 1").select(*SESSION_COLUMNS)
        assert Counter(result.select(*SESSION_COLUMNS).collect()) == Counter(expected.collect())
        assert expected.count() == 5


def test_late_snapshots_are_counted_and_end_the_wait(spark, silver, folder):
    batches = [seen("a", 0) + seen("b", 10_000), seen("a", 100)]
    with pytest.raises(RuntimeError, match="1 late"):
        closed_by_stream(spark, silver, folder, batches, 1)
    waiting = closed_by_stream(spark, silver, folder, [*batches, seen("b", 20_000)], 12_000)
    assert [(r.icao24, r.duration_seconds) for r in waiting.collect()] == [("a", 100)]


def test_kept_copy_is_the_earliest_of_all_batches(spark, bronze, airlines, folder):
    source, out, checkpoint = folder(), folder(), folder()
    row = {"icao24": "a", "last_contact": BASE, "callsign": "GLO1"}
    bronze(*({**row, "time": BASE + o} for o in (30, 5, 90))).repartition(3).write.parquet(source)
    dimension, run = airlines({"ICAO": "GLO", "Nome": "Gol"}), None
    for limit in (10**9, 1):
        stream = snapshot_files(spark, source)
        run = start_silver(
            stream, lambda: dimension, out, checkpoint, None, None, broadcast_limit_bytes=limit
        )
        run.awaitTermination()
        bronze({**row, "time": BASE}, {**row, "time": BASE, "icao24": "b"}).write.mode(
            "append"
        ).parquet(source)
    rows = read_streamed(spark, out).selectExpr("icao24", "unix_timestamp(time)", "Nome")
    # The copy of the second batch is earlier still; the row of the first is taken back.
    assert sorted(map(tuple, rows.collect())) == [("a", BASE, "Gol"), ("b", BASE, "Gol")]


@pytest.mark.parametrize("options", [{"lateness": 0}, {"gap": 0, "lateness": 1}, {"gap": -1}])
def test_impossible_session_settings(spark, silver, folder, options):
    with pytest.raises(ValueError):
        closed_by_stream(spark, silver, folder, [seen("a", 0)], **options)


def test_continuous_silver_is_stopped_and_goes_on(spark, bronze, airlines, folder):
    """A trigger that keeps on running, stopped between batches, equals the rebuild."""
    source, out, checkpoint = folder(), folder(), folder()
    dimension = clean_airlines(airlines({"Airline ID": "1", "Nome": "Norte", "ICAO": "NRT"}))
    files = [
        [dict(time=BASE + t, icao24=f"k{t % 4}", callsign="NRT1", last_contact=BASE + t % 3)
         for t in range(start, start + 8)]
        for start in (40, 0, 20)
    ]
    for number, rows in enumerate(files):
        bronze(*rows).coalesce(1).write.mode("append").parquet(source)
        stream = snapshot_files(spark, source)
        query = start_silver(stream, dimension, out, checkpoint, processing_time="1 second")
        assert query.isActive
        query.processAllAvailable()
        query.stop()
        assert query.exception() is None
        assert len(list(Path(checkpoint, "commits").glob("[0-9]*"))) == number + 1
    rebuilt = build_silver(bronze(*(row for rows in files for row in rows)), dimension)
    columns = sorted(rebuilt.columns)

    def rows_of(df):
        return Counter(map(tuple, df.select(*columns).collect()))

    assert rows_of(read_streamed(spark, out)) == rows_of(rebuilt)
