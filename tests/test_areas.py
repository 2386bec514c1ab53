import random

import pytest

from skylattice import driver_tables
from skylattice.operators import sketches
from skylattice.operators.filters import inside_area
from skylattice.sources import read_area, write_by_area
from skylattice.sources.areas import morton_code
from tests.conftest import instant

SF_DIR = "/root/testdata/sf0.01"


def files_read(df):
    df.collect()
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    if not scan.metrics().contains("numFiles"):
        return 0  # not even a scan is left in the plan
    return scan.metrics().apply("numFiles").value()


def test_a_box_reads_a_part_of_the_files(spark, folder):
    rows = driver_tables.bronze(spark, SF_DIR)
    path = folder()
    write_by_area(rows, path, 32)
    small = ((-23.9, -23.8), (-47.0, -46.9))
    got = read_area(spark, path, *small)
    assert 1 <= files_read(got) <= 8
    want = inside_area(rows, *small)
    assert sorted(r.event_id for r in got.collect()) == sorted(r.event_id for r in want.collect())
    assert "PushedFilters: [IsNotNull(latitude)" in got._jdf.queryExecution().toString()
    assert files_read(read_area(spark, path, (40.0, 41.0), (0.0, 1.0))) == 0
    assert files_read(read_area(spark, path, (-90.0, 90.0), (-180.0, 180.0))) == 32
    assert spark.read.parquet(path).count() == rows.count()


def test_codes_take_bits_in_turn(spark):
    rng = random.Random(1)
    places = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(200)]
    places += [(90.0, 180.0), (-90.0, -180.0), (120.0, 500.0), (-200.0, -300.0)]
    df = spark.createDataFrame(places, "latitude double, longitude double")

    def plain(latitude, longitude):
        x, y = (
            max(0, min(65535, int((value - low) / width * 65536 // 1)))
            for value, low, width in ((latitude, -90, 180), (longitude, -180, 360))
        )
        return sum(((x >> b & 1) << 2 * b) | ((y >> b & 1) << 2 * b + 1) for b in range(16))

    for r in df.withColumn("code", morton_code()).collect():
        assert r.code == plain(r.latitude, r.longitude)


def test_places_that_are_none(spark, bronze, folder):
    nan = float("nan")
    rows = bronze(
        {"latitude": None, "longitude": 1.0}, {"latitude": nan, "longitude": 1.0},
        {"latitude": -23.5, "longitude": -46.5}, {"latitude": 1.0, "longitude": None},
    )
    path = folder()
    write_by_area(rows, path, 3)
    assert read_area(spark, path).count() == 1
    write_by_area(rows.limit(0), path, 2)
    assert read_area(spark, path).collect() == []
    with pytest.raises(ValueError):
        write_by_area(rows.withColumn("span", rows.time), path, 3)
    with pytest.raises(ValueError):
        write_by_area(rows, path, 0)


def test_sketches_of_hours_give_longer_spans(spark, silver):
    rng = random.Random(2)
    rows = [
        {"time": instant(rng.randrange(30 * 86_400)), "icao24": f"a{rng.randrange(4000)}",
         "on_ground": rng.choice([False, False, True, None])}
        for _ in range(9000)
    ]
    df = silver(*rows)
    hours = sketches.activity_sketches(df)
    by_day = sketches.merge_sketches(hours, ["date"])
    exact = len({r["icao24"] for r in rows if r["on_ground"] is False})
    estimates = {
        sketches.estimated_counts(sketches.merge_sketches(part, [])).first()[0]
        for part in (hours, by_day, hours.repartition(7))
    }
    assert all(abs(e - exact) <= sketches.error_bound() * exact for e in estimates)
    fine = sketches.activity_sketches(df, only_airborne=False, bits=16)
    total = sketches.estimated_counts(sketches.merge_sketches(fine, [])).first()[0]
    everyone = len({r["icao24"] for r in rows})
    assert abs(total - everyone) <= sketches.error_bound(16) * everyone
