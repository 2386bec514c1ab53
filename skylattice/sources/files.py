"""File sources."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from skylattice.operators.filters import (
    BASE_COLUMNS,
    identified,
    near_partition,
    on_date,
    require_columns,
)
from skylattice.schemas import AIRLINE, BRONZE, DAY_PARTITION
from skylattice.scratch import list_folders


def envelope_files(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = 1000
) -> DataFrame:
    """Stream of JSON-lines files holding the same envelopes as the topic."""
    reader = spark.readStream
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path)


def snapshot_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType = BRONZE,
    max_files_per_trigger: int | None = 1000,
) -> DataFrame:
    """Stream of Parquet files with a declared schema; the folder may be empty."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def stored_schema(spark: SparkSession, path: str) -> T.StructType:
    """Schema that existing Parquet files carry, for callers that do not declare one."""
    return spark.read.parquet(path).schema


def read_airlines(spark: SparkSession, path: str) -> DataFrame:
    r"""Headerless airline CSV; ``\N`` is NULL, a doubled quote is a quote."""
    return (
        spark.read.options(header="false", sep=",", quote='"', escape='"', nullValue=r"\N")
        .schema(AIRLINE)
        .csv(path)
    )


#: Folder, below the day, of what one micro-batch wrote.
BATCH = "batch"
#: Table, inside a streamed one, of the rows that a later batch took back.
RETRACTED = "_retracted/rows"

RETRACTIONS = T.StructType(
    [
        *(T.StructField(name, kind) for name, kind in (
            ("icao24", T.StringType()), ("last_contact", T.LongType()), ("gone", T.LongType()),
        )),
        *(T.StructField(name, T.IntegerType()) for name in DAY_PARTITION),
        T.StructField(BATCH, T.LongType()),
    ]
)


def read_streamed(
    spark: SparkSession, path: str, day: str | Iterable[str] | None = None
) -> DataFrame:
    """A silver table, written by a stream or a job, in silver's own columns.

    Rows that a later batch replaced are left out. ``day`` is the date of one folder, or
    those of several.
    """
    days = [day] if isinstance(day, str) else None if day is None else list(day)

    def of_day(rows: DataFrame) -> DataFrame:
        if days is None:
            return rows
        wanted = [F.to_date(F.lit(one)) for one in days]
        return rows.filter(F.expr(f"make_date({', '.join(DAY_PARTITION)})").isin(wanted))

    rows = of_day(spark.read.parquet(path))
    if BATCH not in rows.columns:
        return rows
    if list_folders(spark, f"{path}/{RETRACTED}"):
        gone = of_day(spark.read.schema(RETRACTIONS).parquet(f"{path}/{RETRACTED}"))
        gone = gone.select(*(F.col(name).alias(f"_{name}") for name in RETRACTIONS.names))
        same = F.col(BATCH) == F.col("_gone")
        for name in ("icao24", "last_contact"):
            same = same & F.col(name).eqNullSafe(F.col(f"_{name}"))
        for name in DAY_PARTITION:
            same = same & (F.col(name) == F.col(f"_{name}"))
        rows = rows.join(gone, same, "left_anti")
    return rows.drop(BATCH)


def read_silver(
    spark: SparkSession,
    path: str,
    required_columns: Iterable[str] = (),
    run_date: str | None = None,
) -> DataFrame:
    """Silver rows with an aircraft and a time, optionally of one local date.

    The date is taken in the session's time zone. Partitions that cannot hold it
    are skipped at planning.
    """
    try:
        silver = read_streamed(spark, path)
    except AnalysisException as error:
        raise RuntimeError(f"no readable silver table at {path}") from error
    require_columns(silver, BASE_COLUMNS.union(required_columns))
    return on_date(identified(near_partition(silver, run_date)), run_date)
