"""The library's own tables derived from the general test tables.

``events`` gives aircraft snapshots and ``customer`` gives airlines. Everything
is computed from whole tables inside Spark; constants only shape the values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skylattice.operators.airlines import clean_airlines
from skylattice.operators.dedupe import SNAPSHOT_KEY, deduplicate
from skylattice.operators.filters import identified
from skylattice.plans.silver import enrich
from skylattice.schemas import AIRLINE_COLUMNS, BRONZE

# Types of the test tables that are read.
TABLE_SCHEMAS = {
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
        "value double, props string"
    ),
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
        "c_mktsegment string"
    ),
}

#: Call-sign prefixes by ``user_id % 6``.
_PREFIX = """element_at(
    array('aut', 'BUI', 'Fur', 'HOU', 'MAC', 'ZZZ'), cast(user_id % 6 + 1 as int))"""

_BRONZE_VALUES = {
    "time": "cast(cast(ts as timestamp) as bigint) + delay",
    "icao24": "case when event_id % 97 <> 0 then concat('u', user_id) end",
    "callsign": f"""case
        when delay = 30 and user_id % 26 = 0 then ' BUI9 '
        when user_id % 13 = 0 then null
        when user_id % 17 = 0 then '   '
        else concat(' ', {_PREFIX}, event_id % 1000, ' ') end""",
    "origin_country": "'Brazil'",
    "last_contact": "cast(cast(ts as timestamp) as bigint) - event_id % 5",
    "longitude": "-47.5D + (event_id % 200) * 0.0078125D",
    "latitude": "-24.3D + (user_id % 100) * 0.015625D",
    "baro_altitude": "case when event_type <> 'signup' then value end",
    "on_ground": "case when event_type <> 'purchase' then event_type = 'error' end",
    "velocity": """case when event_type <> 'click'
        then cast(get_json_object(props, '$.k') as double) end""",
    "spi": "false",
    "position_source": "0",
}

_AIRLINE_VALUES = {
    "Airline ID": "c_custkey",
    "Nome": "c_name",
    "ICAO": "concat(' ', lower(substring(c_mktsegment, 1, 3)))",
    "Active": "case when c_acctbal > 9000 then 'y' else 'N' end",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows plus ``event_id``; every tenth event is repeated 30 s later."""
    delays = "explode(if(event_id % 10 = 0, array(0, 30), array(0))) as delay"
    columns = [
        f"cast({_BRONZE_VALUES.get(f.name, 'null')} as {f.dataType.simpleString()}) as {f.name}"
        for f in BRONZE
    ]
    events = table(spark, sf_dir, "events").selectExpr("*", delays)
    return events.selectExpr(*columns, "event_id")


def raw_airlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [
        f"cast({_AIRLINE_VALUES.get(name, 'null')} as string) as `{name}`"
        for name in AIRLINE_COLUMNS
    ]
    return table(spark, sf_dir, "customer").selectExpr(*columns)


def airlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_airlines(raw_airlines(spark, sf_dir))


def unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(bronze(spark, sf_dir), SNAPSHOT_KEY, ("time", "event_id"))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(unique(spark, sf_dir), airlines(spark, sf_dir))


def gold_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver as the mart readers see it."""
    return identified(silver(spark, sf_dir))
