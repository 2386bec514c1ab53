from __future__ import annotations

import datetime as dt
import itertools
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession, types as T

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from skylattice.schemas import AIRLINE, BRONZE, SILVER  # noqa: E402
from skylattice.session import RECOMMENDED  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = SparkSession.builder.master("local[8]").appName("tests")
    settings = {
        **RECOMMENDED,
        "spark.sql.shuffle.partitions": "4",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    """Fresh path for each call."""
    numbers = itertools.count()
    return lambda name="data": str(tmp_path / f"{name}-{next(numbers)}")


def at(text: str) -> dt.datetime:
    """A UTC instant; naive datetimes would go through the machine's zone."""
    return dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc)


def instant(seconds: int) -> dt.datetime:
    return dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(seconds=seconds)


def _frame(spark, schema: T.StructType, rows: list[dict]):
    known = {field.name for field in schema}
    for row in rows:
        assert set(row) <= known, set(row) - known
    return spark.createDataFrame(
        [tuple(row.get(field.name) for field in schema) for row in rows], schema
    )


@pytest.fixture
def bronze(spark):
    return lambda *rows: _frame(spark, BRONZE, list(rows))


@pytest.fixture
def silver(spark):
    return lambda *rows: _frame(spark, SILVER, list(rows))


@pytest.fixture
def airlines(spark):
    return lambda *rows: _frame(spark, AIRLINE, list(rows))


@pytest.fixture
def snapshots(silver):
    """A morning: two flights, one taxiing aircraft and one of which little is known."""

    def seen(clock, aircraft, altitude, speed, ground, name, code):
        return {
            "time": at(f"2026-03-05 {clock}"), "icao24": aircraft, "baro_altitude": altitude,
            "velocity": speed, "on_ground": ground, "Nome": name, "ICAO": code,
        }

    north, south = ("Norte", "NRT"), ("Sul", "SUL")
    return silver(
        seen("06:00", "k1", 9500.0, 210.0, False, *north),
        seen("06:25", "k1", 9700.0, None, False, *north),
        seen("07:30", "k1", None, 190.0, False, *north),
        seen("06:10", "k2", 4000.0, 150.5, False, *south),
        seen("06:12", "k2", 4100.0, 151.5, False, *south),
        seen("06:40", "k3", 0.0, 5.0, True, *north),
        seen("06:59", "k3", 0.0, 7.5, True, *north),
        seen("06:05", "k4", None, None, None, None, None),
    )


def plan_of(df) -> str:
    """Physical plan text, as ``explain('formatted')`` prints it."""
    query_execution = df._jdf.queryExecution()
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return query_execution.explainString(mode)
