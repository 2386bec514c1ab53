"""A stored table taken into the watermarked session stream."""

import random
from collections import Counter

import pytest

from skylattice.operators.sessions import build_sessions
from skylattice.schemas import SILVER
from skylattice.sources import snapshot_files
from skylattice.streaming import (
    catch_up_sessions,
    finish,
    read_closed_sessions,
    start_watermarked_sessions,
)
from tests.conftest import instant

BASE = 1_767_225_600
GAP = 1800
COLUMNS = (
    "icao24", "entry_ts", "exit_ts", "has_exit", "airline_name", "airline_icao",
    "duration_seconds", "date", "year", "month", "day",
)


def seen(aircraft, *offsets, name="N", code=None):
    return [
        {"time": instant(BASE + o), "icao24": aircraft, "Nome": name, "ICAO": code} for o in offsets
    ]


@pytest.fixture
def stream(spark, silver, folder):
    return Stream(spark, silver, folder(), folder(), folder())


class Stream:
    def __init__(self, spark, silver, source, out, checkpoint):
        self.spark, self.silver = spark, silver
        self.source, self.out, self.checkpoint = source, out, checkpoint
        silver().write.parquet(source)

    def arrive(self, rows, files=1):
        self.silver(*rows).repartition(files).write.mode("append").parquet(self.source)

    def catch_up(self, lateness=1):
        query = catch_up_sessions(
            self.spark, self.source, self.out, self.checkpoint, gap_seconds=GAP,
            lateness_seconds=lateness,
        )
        finish(query)
        return query

    def go_on(self, lateness=1):
        finish(
            start_watermarked_sessions(
                snapshot_files(self.spark, self.source, SILVER), self.out, self.checkpoint, GAP,
                lateness_seconds=lateness, processing_time=None,
            )
        )

    def found(self):
        rows = read_closed_sessions(self.spark, self.out).select(*COLUMNS).collect()
        return Counter(map(tuple, rows))


def batch_of(silver, rows):
    known = [row for row in rows if row["icao24"] is not None]
    closed = build_sessions(silver(*known), GAP).filter("has_exit = 1").select(*COLUMNS)
    return Counter(map(tuple, closed.collect()))


def waiting(query):
    return query.lastProgress["stateOperators"][0]["numRowsTotal"]


def test_state_holds_the_open_sessions_only(stream, silver):
    old = [row for day in range(40) for row in seen(f"k{day % 4}", day * 86_400, day * 86_400 + 60)]
    end = 40 * 86_400
    # One that has gone on for days, one that ends exactly the gap before the end, one before that.
    long = seen("long", *range(end - 2 * 86_400, end + 1, GAP))
    edge = seen("edge", end - GAP) + seen("gone", end - GAP - 1)
    stored = old + long + edge + seen(None, end + 9)
    stream.arrive(stored, files=6)
    assert waiting(stream.catch_up()) == 2
    known = batch_of(silver, stored)
    assert stream.found() == known and sum(known.values()) == 41
    later = seen("edge", end + 1) + seen("long", end + GAP, name=None) + seen("x", end + 9 * GAP)
    stream.arrive(later)
    stream.go_on()
    assert stream.found() == batch_of(silver, stored + later)


@pytest.mark.parametrize("lateness", [1, 5000])
def test_backlog_and_later_days_equal_the_batch(stream, silver, lateness):
    pick = random.Random(lateness)
    times = sorted(pick.sample(range(400_000), 600))
    rows = [
        row for t in times
        for row in seen(
            f"k{pick.randrange(9)}", t, name=pick.choice([None, "A", "B"]),
            code=pick.choice([None, "C", "D"]),
        )
    ]
    rows += [dict(row, Nome="0") for row in rows[::7]]
    early = [row for row in rows if row["time"] < instant(BASE + 250_000)]
    last = max(row["time"] for row in early).timestamp() - BASE
    later = [row for row in rows if row not in early] + seen("z", 500_000)
    # Late, but not later than allowed.
    later += seen("k1", last - lateness + 1, name=None) + seen("new", last - lateness + 1)
    stream.arrive(early, files=5)
    stream.catch_up(lateness)
    stream.catch_up(lateness)  # there is nothing new: nothing changes
    stream.arrive(later, files=3)
    stream.go_on(lateness)
    assert stream.found() == batch_of(silver, early + later)


def test_snapshots_older_than_the_lateness_are_counted(stream):
    stream.arrive(seen("a", 0, 600) + seen("b", 100_000))
    stream.catch_up()
    stream.arrive(seen("a", 1200))
    with pytest.raises(RuntimeError, match="1 late"):
        stream.go_on()


def test_catch_up_that_did_not_end_runs_again(stream, silver, monkeypatch):
    stored = seen("a", 0, 600) + seen("b", 100_000)
    stream.arrive(stored)
    with monkeypatch.context() as broken:
        broken.setattr("skylattice.streaming.watermarked._started", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            stream.catch_up()
    stored += seen("c", 50_000)
    stream.arrive(seen("c", 50_000))
    stream.catch_up()
    later = seen("d", 200_000)
    stream.arrive(later)
    stream.go_on()
    assert stream.found() == batch_of(silver, stored + later)


def test_empty_backlog(stream, silver):
    stream.catch_up()
    assert not stream.found()
    later = seen("a", 0) + seen("b", 10_000)
    stream.arrive(later)
    stream.go_on()
    assert stream.found() == batch_of(silver, later)
