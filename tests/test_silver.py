from collections import Counter

import pytest

from skylattice.operators import airlines as air
from skylattice.operators.dedupe import deduplicate
from skylattice.operators.filters import with_call_sign
from skylattice.plans.silver import build_silver, removed_rows, with_silver_time
from skylattice.schemas import SILVER
from skylattice.sources import read_airlines
from tests.conftest import instant, plan_of


def test_csv_quotes_nulls_and_accents(spark, folder):
    path = folder("airlines") + ".dat"
    with open(path, "w", encoding="utf-8") as file:
        file.write('1,"Say ""Hi"", Air",\\N,"","hey","CALL","São Tomé",Y\n2,Plain,x,1T,\\N,c,p,N\n')
    first, second = read_airlines(spark, path).orderBy("`Airline ID`").collect()
    assert first["Nome"] == 'Say "Hi", Air' and first["País"] == "São Tomé"
    assert first["Alias"] is None and first["ICAO"] == "hey"
    assert second["ICAO"] is None and second["Nome"] == "Plain"


def test_best_airline_per_code(airlines):
    raw = airlines(
        {"Airline ID": "2", "Nome": "closed, low", "ICAO": "AAA", "Active": "N"},
        {"Airline ID": "30", "Nome": "open, high", "ICAO": " aaa ", "Active": "y"},
        {"Airline ID": "9", "Nome": "open, low", "ICAO": "aaa", "Active": "Y"},
        {"Airline ID": "1", "ICAO": "  "},
        {"Airline ID": "1", "ICAO": None},
        {"Airline ID": "x7", "Nome": "not a number", "ICAO": "BBB"},
    )
    best = {r.ICAO: r.Nome for r in air.clean_airlines(raw).collect()}
    assert best == {"AAA": "open, low", "BBB": "not a number"}


def join_cases(bronze, airlines):
    calls = (" aaa12 ", "AAA", "aab1", "", "   ", "A", "ZZZ9")
    rows = bronze(
        *({"time": i, "icao24": f"p{i}", "last_contact": i, "callsign": c} for i, c in enumerate(calls))
    )
    dimension = air.clean_airlines(
        airlines(
            {"Airline ID": "1", "Nome": "Triple", "ICAO": "AAA"},
            {"Airline ID": "2", "Nome": "Single", "ICAO": "a"},
            {"Airline ID": "3", "Nome": "Long", "ICAO": "AAAA"},
        )
    )
    return rows, dimension


def test_join_by_prefix_keeps_every_row(bronze, airlines):
    rows, dimension = join_cases(bronze, airlines)
    joined = air.join_airlines(rows, dimension)
    assert "BroadcastHashJoin LeftOuter" in plan_of(joined)
    names = {r.callsign: r.Nome for r in joined.collect()}
    assert names == {
        " aaa12 ": "Triple", "AAA": "Triple", "aab1": None, "": None, "   ": None,
        "A": "Single", "ZZZ9": None,
    }


def test_salted_join_gives_the_same_rows(spark, bronze, airlines):
    rows, dimension = join_cases(bronze, airlines)
    small = air.join_airlines(rows, dimension)
    large = air.join_airlines(rows, dimension, broadcast_limit_bytes=0, salts=4)
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        assert "BroadcastHashJoin" not in plan_of(large)
        assert sorted(map(str, large.collect())) == sorted(map(str, small.collect()))
    finally:
        spark.conf.set(threshold, before)


def test_table_size_is_measured(airlines):
    assert air.table_bytes(airlines({"Nome": "abcd"}, {"Nome": "é"})) == 2 * 8 * 16 + 4 + 2
    assert air.table_bytes(airlines({"Nome": "x"}).filter("false")) == 0


def test_earliest_copy_is_kept(bronze):
    df = bronze(
        {"icao24": "a", "last_contact": 1, "time": 30, "callsign": "late"},
        {"icao24": "a", "last_contact": 1, "time": 10, "callsign": "z"},
        {"icao24": "a", "last_contact": 1, "time": 10, "callsign": "early"},
        {"icao24": "a", "last_contact": 2, "time": 50},
        {"icao24": None, "last_contact": None, "time": 2},
        {"icao24": None, "last_contact": None, "time": 1},
        {"icao24": None, "last_contact": 3, "time": 1},
    )
    kept = deduplicate(df.repartition(3)).select("icao24", "last_contact", "time", "callsign")
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(
        [("a", 1, 10, "early"), ("a", 2, 50, None), (None, None, 1, None), (None, 3, 1, None)],
        key=str,
    )


def test_copies_are_reduced_before_the_shuffle(spark, bronze, folder):
    path = folder()
    bronze({"icao24": "a", "last_contact": 1}).write.parquet(path)
    tree = plan_of(deduplicate(spark.read.parquet(path))).split("\n\n\n")[0]
    assert tree.count("WindowGroupLimit") == 2
    assert tree.rindex("WindowGroupLimit") > tree.index("Exchange")
    assert tree.count("Exchange") == 1


def test_duplicates_go_before_missing_call_signs(bronze, airlines):
    df = bronze(
        {"icao24": "a", "last_contact": 1, "time": 10, "callsign": None},
        {"icao24": "a", "last_contact": 1, "time": 20, "callsign": "GLO1"},
        {"icao24": "b", "last_contact": 1, "time": 20, "callsign": "  "},
    )
    silver = build_silver(df, air.clean_airlines(airlines({"ICAO": "GLO"})))
    assert [r.icao24 for r in silver.collect()] == ["b"]
    assert with_call_sign(df).count() == 2
    assert tuple(removed_rows(df, silver).first()) == (3, 1, 2)


def test_silver_schema(bronze, airlines):
    silver = build_silver(bronze({"time": 0, "callsign": "x"}), airlines({"ICAO": "GLO"}))
    assert silver.schema.simpleString() == SILVER.simpleString()


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo"])
def test_repeated_local_hour_keeps_its_instants(spark, bronze, zone):
    seconds = (1518915600, 1518919200, -1, 0)
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = with_silver_time(bronze(*({"time": s} for s in seconds)))
        back = {r.s for r in df.selectExpr("cast(time as bigint) as s").collect()}
        assert back == set(seconds)
        folder_day = df.filter("time = timestamp_seconds(0)").first().day
        assert folder_day == (1 if zone == "UTC" else 31)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert instant(0).day == 1


def test_only_busy_codes_are_salted(spark, bronze, airlines):
    """One code has half of the rows, one that no airline has a quarter, others are rare."""
    names = [f"{a}{b}X" for a in "ABCDEFGH" for b in "ABCDEFGH"]
    rows = [{"icao24": f"h{i}", "callsign": "GLO1"} for i in range(400)]
    rows += [{"icao24": f"z{i}", "callsign": "ZZZ9"} for i in range(200)]
    rows += [{"icao24": f"r{i}", "callsign": f"{names[i % 64]}{i}"} for i in range(192)]
    rows += [{"icao24": f"n{i}", "callsign": None} for i in range(8)]
    rows = [{**r, "last_contact": i, "time": i} for i, r in enumerate(rows)]
    df = bronze(*rows)
    dimension = airlines(*({"ICAO": code, "Nome": code} for code in ["GLO", *names]))
    keyed = df.withColumn("_key", air.airline_key("callsign"))
    assert sorted(air.busy_keys(keyed, 8)) == ["GLO", "ZZZ"]
    assert air.busy_keys(keyed.limit(0), 8) == []
    joined = air.join_airlines(df, dimension, broadcast_limit_bytes=0, salts=8)
    plain = air.join_airlines(df, dimension)
    assert Counter(map(tuple, joined.collect())) == Counter(map(tuple, plain.collect()))
    # Of the 65 airlines one is copied, to eight.
    assert air.with_copies(dimension, ["GLO", "ZZZ"], 8).count() == 64 + 8
    assert air.with_copies(dimension, None, 8).count() == 65 * 8
