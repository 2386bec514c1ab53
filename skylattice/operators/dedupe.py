"""Duplicate removal on (aircraft, last contact)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from skylattice.functions import quoted

SNAPSHOT_KEY = ("icao24", "last_contact")


def deduplicate(
    df: DataFrame,
    key: Sequence[str] = SNAPSHOT_KEY,
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Keep one row per key: the earliest by ``time``, ties broken by all columns.

    That is the row a stream sees first, and the same one on every run. NULL keys
    equal each other. Because only rank 1 is kept, Spark ranks inside each input
    task before the shuffle (WindowGroupLimit), so a key with any number of
    copies sends at most one row per task.
    """
    if order is None:
        rest = [name for name in df.columns if name not in (*key, "time")]
        order = ("time", *rest)
    group, ranking = (", ".join(map(quoted, names)) for names in (key, order))
    rank = f"row_number() over (partition by {group} order by {ranking})"
    return df.withColumn("_copy", F.expr(rank)).filter("_copy = 1").drop("_copy")
