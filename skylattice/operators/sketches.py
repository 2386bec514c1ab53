"""Distinct aircraft over any span of time, from hours that are already counted.

Exact distinct counts of two hours do not add up to that of both. A sketch of each hour does:
sketches merge, in any order and any grouping, and give the count to within
``error_bound`` with a probability of 95 % (the estimate itself may differ a little with the
order, inside that bound). A month is then counted from its 720 stored hours instead of its
snapshots. The reports themselves stay exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from skylattice.functions import calendar_columns
from skylattice.operators.filters import airborne

#: Registers of a sketch, as a power of two: 4 KB and an error of 3.3 %.
SKETCH_BITS = 12


def activity_sketches(
    df: DataFrame, only_airborne: bool = True, bits: int = SKETCH_BITS
) -> DataFrame:
    """One sketch of the aircraft seen for each date and hour: ``date, hour, aircraft``."""
    seen = airborne(df) if only_airborne else df.filter("icao24 is not null")
    calendar = calendar_columns("time")
    return (
        seen.select(calendar["date"].alias("date"), calendar["hour"].alias("hour"), "icao24")
        .groupBy("date", "hour")
        .agg(F.hll_sketch_agg("icao24", bits).alias("aircraft"))
    )


def merge_sketches(sketches: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Sketches of longer spans, from those of the hours or of any other parts."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg("aircraft").alias("aircraft"))


def estimated_counts(sketches: DataFrame) -> DataFrame:
    """``active_aircraft_estimate`` in place of the sketch."""
    estimate = F.hll_sketch_estimate("aircraft").alias("active_aircraft_estimate")
    return sketches.select(*(c for c in sketches.columns if c != "aircraft"), estimate)


def error_bound(bits: int = SKETCH_BITS) -> float:
    """Relative error that 95 of 100 estimates stay within."""
    return 2 * 1.04 / 2 ** (bits / 2)
