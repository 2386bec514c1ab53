import math
import random
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from skylattice.functions import (
    exact_means,
    gather_means,
    mean_columns,
    mean_parts,
    mean_ranges,
    mean_value,
    merge_mean_parts,
)


def mean(df, digits=2):
    means = exact_means(df, ["g"], {"m": "x"})
    return {r.g: r.v for r in means.select("g", mean_value("m", digits).alias("v")).collect()}


def frame(spark, values, partitions=1):
    rows = [(0, v) for v in values]
    return spark.createDataFrame(rows, "g int, x double").repartition(partitions)


@settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.decimals(-20000, 20000, places=3, allow_nan=False, allow_infinity=False),
        min_size=1,
        max_size=30,
    )
)
def test_mean_is_the_exact_one(spark, values):
    exact = sum(values) / len(values)
    expected = float(exact.quantize(Decimal("0.01"), ROUND_HALF_UP))
    assert mean(frame(spark, [float(v) for v in values]))[0] == expected


def test_partitioning_does_not_matter(spark):
    values = [round(i * 0.1 + 0.005, 3) for i in range(1000)]
    results = {mean(frame(spark, values, n), None)[0] for n in (1, 3, 8)}
    assert len(results) == 1


def test_half_goes_up_in_magnitude(spark):
    assert mean(frame(spark, [1.0, 1.01]))[0] == 1.01
    assert mean(frame(spark, [-1.0, -1.01]))[0] == -1.01


@pytest.mark.parametrize("odd", [1e300, 1e15, 0.1234567891])
def test_values_off_the_grid_still_count(spark, odd):
    values = [1.0, odd]
    assert mean(frame(spark, values), None)[0] == pytest.approx(sum(values) / 2)


def test_nan_and_null(spark):
    assert math.isnan(mean(frame(spark, [1.0, float("nan")]))[0])
    assert mean(frame(spark, [None]))[0] is None
    assert mean(frame(spark, [None, 3.0]))[0] == 3.0
    assert mean(frame(spark, [float("inf"), 3.0]))[0] == float("inf")


def test_parts_merge(spark):
    df = spark.createDataFrame(
        [(i % 7, i % 2, i * 0.37) for i in range(500)] + [(1, 1, None)], "h int, g int, x double"
    )
    rows = df.withColumns(mean_columns("x", "m"))
    fine = rows.groupBy("h", "g", *mean_ranges("m")).agg(*mean_parts("m"))
    for _ in range(3):
        keys = ["g", *(["h"] if _ < 2 else []), *mean_ranges("m")]
        fine = fine.groupBy(*keys).agg(*merge_mean_parts("m"))
    means = gather_means(fine, ["g"], ["m"])
    merged = {r.g: r.v for r in means.select("g", mean_value("m").alias("v")).collect()}
    assert merged == mean(df)


def exactly(values):
    """The mean from exact fractions, rounded once: what the parts should come close to."""
    return float(sum(map(Fraction, values)) / len(values))


EXTREMES = [
    [1e300, -1e300, 0.1234567891], [1e16, 1.0, -1e16, 2.0 ** -30], [5e-324, 5e-324, 1e-310],
    [1.7e308, 1.7e308, 1.7e308], [2.0 ** 21, 2.0 ** 21 - 2.0 ** -32, -(2.0 ** 42) + 2.0 ** -11],
    [math.pi * 10.0 ** k for k in range(-12, 13)], [-1 / 3] * 1000 + [1e9 / 7],
    [-(2.0 ** -60), 2.0 ** 62 + 2048.0, -(2.0 ** 62)], [0.1, 0.2, 1 / 3], [-1e-9, 1.0, -1.0],
]


@pytest.mark.parametrize("values", EXTREMES, ids=range(len(EXTREMES)))
def test_every_finite_double_is_added_exactly(spark, values):
    rows = values * 3
    random.Random(1).shuffle(rows)
    found = {mean(frame(spark, order, n), None)[0] for order in (values * 3, rows) for n in (1, 5)}
    assert len(found) == 1
    got, want = found.pop(), exactly(values)
    assert got == want or abs(got - want) <= 4 * math.ulp(want)


@settings(
    max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False), min_size=1, max_size=20))
def test_any_doubles(spark, values):
    got, want = mean(frame(spark, values), None)[0], exactly(values)
    grid = sum(abs(v) for v in values if abs(v) < 4e12 and round(v * 1e6) / 1e6 == v)
    assert abs(got - want) <= 4 * math.ulp(want) + 4 * math.ulp(grid)


@pytest.mark.parametrize(
    "values, expected",
    [
        ([float("inf"), float("-inf"), 1.0], float("nan")),
        ([float("-inf"), 1e300], float("-inf")),
        ([float("inf"), float("nan")], float("nan")),
    ],
)
def test_what_is_no_number(spark, values, expected):
    got = mean(frame(spark, values))[0]
    assert got == expected or (math.isnan(got) and math.isnan(expected))
