"""File sinks."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from skylattice.schemas import DAY_PARTITION

# Fixed value: trigger of the two continuous jobs.
DEFAULT_TRIGGER = "35 seconds"


@dataclass(frozen=True)
class WriteResult:
    """What a write did; counted while writing, so nothing runs twice."""

    path: str
    rows: int
    schema: T.StructType

    def describe(self, name: str) -> str:
        columns = "\n".join(f" |-- {f.name}: {f.dataType.simpleString()}" for f in self.schema)
        return f"{name}: {self.rows} rows in {self.path}\n{columns}"


def write_table(
    df: DataFrame,
    path: str,
    partition_columns: Sequence[str] = DAY_PARTITION,
    replace: str = "static",
) -> WriteResult:
    """Overwrite a Parquet table partitioned by ``partition_columns``.

    ``replace='static'`` replaces the whole table, ``'dynamic'`` only the
    partitions that occur in ``df``. Rows are rebalanced on the partition columns
    first: small partitions get one file instead of one per task, and AQE splits
    a large partition over several tasks and files.
    """
    if replace not in ("static", "dynamic"):
        raise ValueError("replace must be 'static' or 'dynamic'")
    # Counted in the writing tasks: a map task that runs again after an executor
    # is lost is then not counted twice.
    counter = Observation()
    (
        df.hint("rebalance", *partition_columns)
        .observe(counter, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", replace)
        .partitionBy(*partition_columns)
        .parquet(path)
    )
    return WriteResult(path, counter.get["rows"], df.schema)


def append_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    partition_columns: Sequence[str] = (),
    processing_time: str | None = DEFAULT_TRIGGER,
    name: str | None = None,
) -> StreamingQuery:
    """Append a stream to Parquet, exactly once per checkpoint.

    ``processing_time=None`` processes what is available now, in as many batches
    as the source's limits ask for, and stops.
    """
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if partition_columns:
        writer = writer.partitionBy(*partition_columns)
    if name:
        writer = writer.queryName(name)
    return _triggered(writer, processing_time).start()


_ADAPTIVE = "spark.sql.adaptive.enabled"
#: The same for tables that a batch keeps for its jobs; off in the stream's session as well.
_ADAPTIVE_CACHED = "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning"


def batch_stream(
    df: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    processing_time: str | None = DEFAULT_TRIGGER,
) -> StreamingQuery:
    """Hand each micro-batch and its number to ``write``, which must bear being repeated.

    Spark plans a stream without adaptive execution, in its own copy of the session. ``write``
    runs ordinary jobs there, so they get the caller's setting: shuffles are cut to the size of
    the batch, and a day's rows are rebalanced over several tasks. ``df`` must keep no state.
    """
    adaptive = df.sparkSession.conf.get(_ADAPTIVE)

    def planned(batch: DataFrame, number: int) -> None:
        for setting in (_ADAPTIVE, _ADAPTIVE_CACHED):
            batch.sparkSession.conf.set(setting, adaptive)
        write(batch, number)

    writer = df.writeStream.foreachBatch(planned).option("checkpointLocation", checkpoint)
    return _triggered(writer, processing_time).start()


def _triggered(writer: DataStreamWriter, processing_time: str | None) -> DataStreamWriter:
    if processing_time is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=processing_time)
