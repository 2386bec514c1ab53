"""Row filters and the schema contract."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from skylattice.schemas import DAY_PARTITION, SILVER

#: Columns every silver reader needs.
BASE_COLUMNS = frozenset({"time", "icao24", *DAY_PARTITION})

# The monitored area in degrees.
AREA_LATITUDE = (-24.10, -23.20)
AREA_LONGITUDE = (-47.20, -46.20)

#: Local dates of one instant differ by up to two days between the zones UTC-12
#: and UTC+14, so a partition written in one zone is searched this far around.
ZONE_SLACK_DAYS = 2


def inside_area(
    df: DataFrame,
    latitude: tuple[float, float] = AREA_LATITUDE,
    longitude: tuple[float, float] = AREA_LONGITUDE,
) -> DataFrame:
    """Rows inside a latitude/longitude box, borders included."""
    return df.filter(
        F.col("latitude").between(*latitude) & F.col("longitude").between(*longitude)
    )


def with_call_sign(df: DataFrame) -> DataFrame:
    """Drop rows whose call sign is NULL; a blank one stays."""
    return df.dropna(subset=["callsign"])


def identified(df: DataFrame) -> DataFrame:
    """Rows that carry both an aircraft and a time."""
    return df.filter("icao24 is not null and time is not null")


def airborne(df: DataFrame) -> DataFrame:
    """Rows known to be in the air; an unknown ``on_ground`` does not count."""
    return df.filter("icao24 is not null and on_ground = false")


def on_date(df: DataFrame, run_date: str | None, timestamp_column: str = "time") -> DataFrame:
    """Rows of one local date; None or '' keeps every row."""
    if not run_date:
        return df
    return df.filter(F.to_date(timestamp_column) == F.to_date(F.lit(run_date)))


def near_partition(df: DataFrame, run_date: str | None) -> DataFrame:
    """Keep the day partitions that can hold rows of ``run_date`` in any zone.

    Catalyst does not derive a partition filter from a filter on ``time``; this
    predicate is on the partition columns alone, so whole folders are skipped at
    planning. It only prunes: :func:`on_date` still decides about each row.
    """
    if not run_date:
        return df
    wanted = F.to_date(F.lit(run_date))
    folder = F.expr(f"make_date({', '.join(DAY_PARTITION)})")
    return df.filter(
        folder.between(
            F.date_sub(wanted, ZONE_SLACK_DAYS), F.date_add(wanted, ZONE_SLACK_DAYS)
        )
    )


def require_columns(df: DataFrame, required: Iterable[str]) -> None:
    """Compare a table with the declared silver columns; one error names all that differ.

    Missing columns make it a ValueError. ``time`` alone must also have its declared type,
    else it is a TypeError; other columns are read by name.
    """
    found = dict(df.dtypes)
    wanted = {name: SILVER["time"].dataType.simpleString() for name in ("time",)}
    absent = sorted({*required, *wanted} - found.keys())
    other = {n: found[n] for n, kind in wanted.items() if found.get(n, kind) != kind}
    if absent or other:
        kind = ValueError if absent else TypeError
        raise kind(f"not a silver table: missing {absent}, of another type {other}")
