"""Snapshots stored by place, so that a box of latitude and longitude reads few files.

Rows are put in order of their Morton code, the bits of latitude and longitude taken in
turn, which keeps what is near in both near in the table. Each file takes one stretch of that
order, and a small table beside the files has the box around each file's rows. A reader
looks up which files a box touches, and inside them Parquet's own statistics skip row groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from skylattice.operators.filters import AREA_LATITUDE, AREA_LONGITUDE, inside_area
from skylattice.scratch import list_folders

#: Column of the folder that holds one stretch.
SPAN = "span"
#: Table of the boxes around the stretches; readers of the rows pass it over.
BOXES = "_boxes/rows"
#: Bits of each coordinate in a code: cells of 0.0055 by 0.0027 degrees.
_BITS = 16


def morton_code(latitude: str = "latitude", longitude: str = "longitude"):
    """Code of a place; null without one. Places beyond the poles count as the poles."""

    def cell(column: str, low: int, width: int) -> str:
        place = f"cast(floor((`{column}` - {low}) / {width} * {1 << _BITS}) as bigint)"
        return f"greatest(0L, least({(1 << _BITS) - 1}L, {place}))"

    def spread(x: str) -> str:
        for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
            x = f"element_at(transform(array({x}), x -> (x | shiftleft(x, {shift})) & {mask}L), 1)"
        return x

    north, east = spread(cell(latitude, -90, 180)), spread(cell(longitude, -180, 360))
    known = f"`{latitude}` is not null and `{longitude}` is not null"
    finite = f"not isnan(`{latitude}`) and not isnan(`{longitude}`)"
    return F.expr(f"case when {known} and {finite} then {north} | shiftleft({east}, 1) end")


def write_by_area(df: DataFrame, path: str, files: int) -> None:
    """Replace a table by these rows in ``files`` stretches of about equal size.

    Rows at one place stay together only if they fit a stretch; ``files`` should give files of
    a few hundred MB. Columns named ``span`` are not allowed.
    """
    if files < 1:
        raise ValueError("there is at least one file")
    if SPAN in df.columns:
        raise ValueError(f"a column named {SPAN} is in the way")
    spark = df.sparkSession
    code = morton_code()
    # Rows at one place are told apart by their content, else a busy place would be one task's.
    spread = F.xxhash64(*(F.col(f"`{name}`") for name in df.columns))
    ordered = df.repartitionByRange(files, code, spread).sortWithinPartitions(code)
    ordered.withColumn(SPAN, F.spark_partition_id()).write.mode("overwrite").partitionBy(
        SPAN
    ).parquet(path)
    if not list_folders(spark, path, f"{SPAN}="):
        # A file without rows, which at least has the columns.
        df.limit(0).write.parquet(f"{path}/{SPAN}=0")
    stored = spark.read.parquet(path)
    boxes = stored.groupBy(SPAN).agg(
        *(F.expr(f"{call}({name}) as {call}_{name}")
          for name in ("latitude", "longitude") for call in ("min", "max"))
    )
    boxes.coalesce(1).write.mode("overwrite").parquet(f"{path}/{BOXES}")


def read_area(
    spark: SparkSession,
    path: str,
    latitude: tuple[float, float] = AREA_LATITUDE,
    longitude: tuple[float, float] = AREA_LONGITUDE,
) -> DataFrame:
    """Rows of a table by :func:`write_by_area` inside a box, borders included."""
    boxes = spark.read.parquet(f"{path}/{BOXES}")
    touched = boxes.filter(
        " and ".join(
            f"min_{name} <= {high}D and max_{name} >= {low}D"
            for name, (low, high) in (("latitude", latitude), ("longitude", longitude))
        )
    )
    # One number for each file that is read.
    spans = [row[SPAN] for row in touched.select(SPAN).collect()]
    rows = spark.read.parquet(path).filter(F.col(SPAN).isin(spans))
    return inside_area(rows, latitude, longitude).drop(SPAN)
