"""Bronze snapshots to the enriched, day-partitioned silver table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from skylattice.functions import quoted
from skylattice.operators.airlines import join_airlines
from skylattice.operators.dedupe import deduplicate
from skylattice.operators.filters import with_call_sign
from skylattice.schemas import DAY_PARTITION


def with_silver_time(df: DataFrame) -> DataFrame:
    """Epoch seconds to a timestamp, plus the day partition columns.

    Direct arithmetic on the instant: no detour over a local time string, so the
    repeated hour at the end of daylight saving time keeps its instants.
    """
    instant = "timestamp_seconds(time)"
    return df.withColumns(
        {
            "time": F.expr(instant),
            **{name: F.expr(f"{name}({instant})") for name in DAY_PARTITION},
        }
    )


def enrich(unique: DataFrame, airlines: DataFrame, **join_options: int) -> DataFrame:
    """Deduplicated bronze to silver rows. Batch or stream.

    Duplicates are removed before the call-sign filter: a key whose kept copy has
    no call sign disappears even when a later copy had one.
    """
    named = with_silver_time(with_call_sign(unique))
    joined = join_airlines(named, airlines, **join_options)
    leading = [quoted(name) for name in joined.columns if name not in DAY_PARTITION]
    return joined.select(*leading, *DAY_PARTITION)


def build_silver(bronze: DataFrame, airlines: DataFrame, **join_options: int) -> DataFrame:
    """All of bronze to silver in one batch plan."""
    return enrich(deduplicate(bronze), airlines, **join_options)


def removed_rows(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """One row: rows before, rows after and how many were removed."""
    count = F.count(F.lit(1))
    before = bronze.agg(count.alias("rows_before"))
    after = silver.agg(count.alias("rows_after")).scalar()
    return before.select(
        "rows_before",
        after.alias("rows_after"),
        (F.col("rows_before") - after).alias("rows_removed"),
    )
