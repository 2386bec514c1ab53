"""Declared schemas of every layer.

Nothing is inferred from files: a stream can start before the layer below it
has written anything, and batch reads never pay for a schema scan.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(columns: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


# Field names and types of one aircraft state on the wire.
STATE_COLUMNS: dict[str, T.DataType] = {
    "icao24": T.StringType(),
    "callsign": T.StringType(),
    "origin_country": T.StringType(),
    "time_position": T.LongType(),
    "last_contact": T.LongType(),
    "longitude": T.DoubleType(),
    "latitude": T.DoubleType(),
    "baro_altitude": T.DoubleType(),
    "on_ground": T.BooleanType(),
    "velocity": T.DoubleType(),
    "true_track": T.DoubleType(),
    "vertical_rate": T.DoubleType(),
    "geo_altitude": T.DoubleType(),
    "spi": T.BooleanType(),
    "position_source": T.IntegerType(),
    "category": T.IntegerType(),
}

# Column names of the airline dimension, all text.
AIRLINE_COLUMNS: dict[str, T.DataType] = {
    "Airline ID": T.StringType(),
    "Nome": T.StringType(),
    "Alias": T.StringType(),
    "IATA": T.StringType(),
    "ICAO": T.StringType(),
    "Indicativo": T.StringType(),
    "País": T.StringType(),
    "Active": T.StringType(),
}

STATE = _struct(STATE_COLUMNS)
ENVELOPE = _struct({"time": T.LongType(), "states": T.ArrayType(STATE)})
BRONZE = _struct({"time": T.LongType(), **STATE_COLUMNS})
AIRLINE = _struct(AIRLINE_COLUMNS)

#: Partition columns of silver and of every mart.
DAY_PARTITION = ("year", "month", "day")

SILVER = _struct(
    {
        "time": T.TimestampType(),
        **STATE_COLUMNS,
        **AIRLINE_COLUMNS,
        **{name: T.IntegerType() for name in DAY_PARTITION},
    }
)
