import random
from collections import Counter

import pytest

from skylattice.operators import sessions as sess
from tests.conftest import instant, plan_of

BASE = 1_767_225_600


def seen(aircraft, *offsets, **more):
    return [{"time": instant(BASE + o), "icao24": aircraft, **more} for o in offsets]


def spans(df):
    return sorted(
        (
            r.icao24,
            r.session_id,
            int(r.entry_ts.timestamp()) - BASE,
            int(r.exit_ts.timestamp()) - BASE,
            r.has_exit,
        )
        for r in df.collect()
    )


def brute_force(rows, gap, stale_tail=True):
    """Sessions by the definition, one aircraft after the other in plain Python."""
    end = max(t for _, t in rows)
    result = []
    for aircraft in {a for a, _ in rows}:
        times = sorted(t for a, t in rows if a == aircraft)
        runs = [[times[0]]]
        for before, after in zip(times, times[1:]):
            if after - before > gap:
                runs.append([])
            runs[-1].append(after)
        for number, run in enumerate(runs, 1):
            closed = number < len(runs) or (stale_tail and end - run[-1] > gap)
            result.append((aircraft, number, run[0], run[-1], int(closed)))
    return sorted(result)


def test_gap_of_exactly_the_limit_continues(silver):
    df = silver(*seen("a", 0, 1800, 3601))
    assert spans(sess.build_sessions(df)) == [("a", 1, 0, 1800, 1), ("a", 2, 3601, 3601, 0)]


def test_stale_tail_rule_is_strict(silver):
    def tail(last):
        return spans(sess.build_sessions(silver(*seen("a", 0), *seen("b", last))))[0][-1]

    assert (tail(1800), tail(1801)) == (0, 1)


def test_open_tail_variant_leaves_last_session_open(silver):
    df = silver(*seen("a", 0, 5000), *seen("b", 100_000))
    closed = sess.build_sessions(df, close_stale_tail=False)
    assert [s[-1] for s in spans(closed)] == [1, 0, 0]


@pytest.mark.parametrize("gap", [0, 1, 7, 60, 61, 600])
@pytest.mark.parametrize("stale_tail", [True, False])
def test_random_series_match_the_definition(silver, gap, stale_tail):
    rng = random.Random(gap)
    rows = [
        (rng.choice("abc"), rng.randrange(-2000, 2000) // rng.choice([1, 5])) for _ in range(300)
    ]
    df = silver(*({"icao24": a, "time": instant(BASE + t)} for a, t in rows))
    assert spans(sess.build_sessions(df, gap, stale_tail)) == brute_force(rows, gap, stale_tail)


def test_times_before_1970(silver):
    rows = [("a", t - BASE) for t in (-1801, -1, 0, 1, 1801, 1802, 3603)]
    df = silver(*({"icao24": a, "time": instant(BASE + t)} for a, t in rows))
    for gap in (0, 1, 1799, 1800):
        assert spans(sess.build_sessions(df, gap)) == brute_force(rows, gap)


def test_names_are_the_earliest_known_each_on_its_own(silver):
    df = silver(
        *seen("a", 0),
        *seen("a", 10, Nome="Late", ICAO=None),
        *seen("a", 20, Nome="Later", ICAO="LAT"),
        *seen("a", 5, Nome=None, ICAO=None),
        *seen("b", 0),
    )
    named = {r.icao24: (r.airline_name, r.airline_icao) for r in sess.build_sessions(df).collect()}
    assert named == {"a": ("Late", "LAT"), "b": (None, None)}


def test_name_tie_at_one_time_is_settled_by_value(silver):
    for order in ((0, 1), (1, 0)):
        rows = [*seen("a", 0, Nome="B"), *seen("a", 0, Nome="A")]
        df = silver(*(rows[i] for i in order))
        assert sess.build_sessions(df).first().airline_name == "A"


def test_rows_without_aircraft_form_one_group(silver):
    df = silver(*seen(None, 0, 10), *seen("a", 0))
    assert sess.build_sessions(df).count() == 2
    rows = sess.session_observations(df).filter("icao24 is null").collect()
    assert Counter((r.previous_time is None, r.next_time is None) for r in rows) == Counter(
        {(True, False): 1, (False, True): 1}
    )


@pytest.mark.parametrize("gap", [0, 30, 1800])
def test_observations_match_the_definition(silver, gap):
    rng = random.Random(gap)
    rows = [(rng.choice("ab"), rng.randrange(0, 4000)) for _ in range(200)]
    df = silver(*({"icao24": a, "time": instant(BASE + t)} for a, t in rows))
    end = max(t for _, t in rows)
    expected = Counter()
    for aircraft in "ab":
        times = sorted(t for a, t in rows if a == aircraft)
        number = 0
        for i, t in enumerate(times):
            before = times[i - 1] if i else None
            after = times[i + 1] if i + 1 < len(times) else None
            opens = int(before is None or t - before > gap)
            number += opens
            closes = int((after if after is not None else end) - t > gap)
            expected[(aircraft, t, before, after, opens, number, closes)] += 1

    def offset(value):
        return None if value is None else int(value.timestamp()) - BASE

    actual = Counter(
        (r.icao24, offset(r.time), offset(r.previous_time), offset(r.next_time),
         r.new_session, r.session_id, r.session_closes)
        for r in sess.session_observations(df, gap).collect()
    )
    assert actual == expected


def test_negative_gap_is_refused(silver):
    df = silver(*seen("a", 0))
    with pytest.raises(ValueError):
        sess.build_sessions(df, -1)
    with pytest.raises(ValueError):
        sess.session_observations(df, -1)


def test_detail_lists_used_sessions(silver):
    df = silver(*seen("a", 0, 60, Nome="N", ICAO="I"), *seen("b", 0), *seen("c", 9000))
    rows = sess.session_detail(sess.build_sessions(df)).collect()
    assert [(r.icao24, r.duration_seconds, r.airline_name) for r in rows] == [("a", 60, "N")]


def test_snapshots_are_folded_before_any_ordering(spark, silver, folder):
    path = folder()
    silver(*seen("a", 0)).write.parquet(path)
    plan = plan_of(sess.build_sessions(spark.read.parquet(path)))
    main = plan.split("===== Subqueries =====")[0]
    # The only single-task exchange belongs to the scalar maximum.
    assert "SinglePartition" not in main
    assert "Join" not in plan
    tree = main.split("(1) ")[0].splitlines()
    operators = [line.strip(" +-:*|").split(" (")[0] for line in tree]
    scan = next(i for i, name in enumerate(operators) if name.startswith("Scan"))
    above = operators[:scan]
    fold = len(above) - 1 - above[::-1].index("HashAggregate")
    assert "Window" in above and above.index("Window") < fold
    assert not any(name == "Sort" for name in above[fold:])
    assert not any(name == "Exchange" for name in above[fold:])


def test_the_end_of_the_data_needs_no_second_reading(spark, silver, folder):
    path = folder()
    rows = [{"time": instant(s), "icao24": f"a{s % 3}"} for s in range(0, 9000, 700)]
    silver(*rows).write.parquet(path)
    result = sess.build_sessions(spark.read.parquet(path))
    assert result.count() and result.collect()
    ended = result._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    subquery = ended[ended.index("Subquery") :]
    assert "ReusedExchange" in subquery and "FileScan" not in subquery
