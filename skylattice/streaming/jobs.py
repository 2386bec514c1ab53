"""Envelope stream to bronze, bronze to silver."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from skylattice.functions import quoted
from skylattice.operators.dedupe import SNAPSHOT_KEY, deduplicate
from skylattice.operators.envelopes import (
    decode_envelopes,
    parse_messages,
    rejects_of,
    states_of,
)
from skylattice.plans.silver import enrich, with_silver_time
from skylattice.schemas import DAY_PARTITION
from skylattice.sources.files import BATCH, RETRACTED, read_streamed
from skylattice.sources.sinks import (
    DEFAULT_TRIGGER,
    WriteResult,
    append_stream,
    batch_stream,
    write_table,
)
from skylattice.streaming.versions import NO_DAY, VersionStore


def start_bronze(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    processing_time: str | None = DEFAULT_TRIGGER,
    rejects_path: str | None = None,
) -> StreamingQuery:
    """Decode envelopes into the flat bronze table; stateless, without a shuffle.

    With ``rejects_path`` the messages that give no rows are written there, with the
    reason. Each batch is then read once, into both tables, below ``batch=`` folders that a
    batch which runs again replaces.
    """
    if rejects_path is None:
        return append_stream(
            decode_envelopes(messages), path, checkpoint, processing_time=processing_time
        )

    def write(batch: DataFrame, number: int) -> None:
        parsed = parse_messages(batch).persist(StorageLevel.DISK_ONLY)
        try:
            for rows, target in ((states_of(parsed), path), (rejects_of(parsed), rejects_path)):
                rows.write.mode("overwrite").parquet(f"{target}/{BATCH}={number}")
        finally:
            parsed.unpersist()

    return batch_stream(messages, write, checkpoint, processing_time)


def start_silver(
    bronze: DataFrame,
    airlines: DataFrame | Callable[[], DataFrame],
    path: str,
    checkpoint: str,
    dedupe_within: str | None = None,
    processing_time: str | None = DEFAULT_TRIGGER,
    **join_options: int,
) -> StreamingQuery:
    """Deduplicate and enrich bronze into day partitions, batch by batch.

    Of all copies of a snapshot the earliest by time stays, ties settled by all columns,
    which is the row of ``rebuild_silver``, in whatever order and batches they arrive: the
    kept copies are stored beside the checkpoint by day of last contact
    (:class:`VersionStore`), and when an earlier copy comes later, the row kept before is
    taken back. :func:`read_streamed` and ``read_silver`` leave out rows that were
    taken back; reading the folder as plain Parquet does not. A batch reads the kept copies
    of the days it holds and, of those, the row groups with its times of last contact.

    With ``dedupe_within`` (an interval such as ``"2 days"``) only copies kept within that
    time of arrival count, and later ones pass.

    The airline table's size is measured in each batch, so the join follows a table that
    grows; give a function to have its file listed anew as well. Rows are rebalanced and
    written below day and ``batch`` folders, which a batch that runs again replaces.
    :func:`compact_silver` merges the files of past days.
    """
    rest = [f for f in bronze.schema.fields if f.name not in ("time", *SNAPSHOT_KEY)]
    order = T.StructType([bronze.schema["time"], *rest])
    columns = T.StructType(
        [
            *(bronze.schema[name] for name in SNAPSHOT_KEY),
            T.StructField("kept", order),
            T.StructField("arrived", T.TimestampType()),
        ]
    )

    def write(batch: DataFrame, number: int) -> None:
        dimension = airlines() if callable(airlines) else airlines
        copies = VersionStore(
            batch.sparkSession, f"{checkpoint.rstrip('/')}-keys", columns, SNAPSHOT_KEY,
            sort=("last_contact", "icao24"),
        )
        unique = deduplicate(batch).withColumn("_day", F.expr(_CONTACT_DAY)).persist()
        changed = _earlier_copies(unique, copies, order.names, number, dedupe_within).persist()
        try:
            copies.append(
                changed.select(
                    *SNAPSHOT_KEY, F.struct(*map(quoted, order.names)).alias("kept"),
                    F.current_timestamp().alias("arrived"), F.col("_day").alias("day"),
                ),
                number,
            )
            _retract(changed, path, number)
            rows = enrich(changed.select(*map(quoted, batch.columns)), dimension, **join_options)
            write_table(
                rows.withColumn(BATCH, F.lit(number)), path, (*DAY_PARTITION, BATCH), "dynamic"
            )
        finally:
            changed.unpersist()
            unique.unpersist()

    return batch_stream(bronze, write, checkpoint, processing_time)


_CONTACT_DAY = "to_date(timestamp_seconds(last_contact))"


def _earlier_copies(
    unique: DataFrame, copies: VersionStore, order: list[str], number: int, within: str | None
) -> DataFrame:
    """Rows of a batch that are new or earlier than the copy kept so far.

    Adds that copy's time (``_old_time``, in epoch seconds) and batch (``_old_batch``).
    """
    spans = unique.groupBy("_day").agg(F.min("last_contact"), F.max("last_contact")).collect()
    days = [NO_DAY if day is None else str(day) for day, _, _ in spans]
    copies.fold(days, number)
    ranges = [f"last_contact between {low} and {high}" for _, low, high in spans if low is not None]
    if len(ranges) > _RANGES:
        lows, highs = zip(*((low, high) for _, low, high in spans if low is not None), strict=True)
        ranges = [f"last_contact between {min(lows)} and {max(highs)}"]
    seen = copies.versions(days, number, " or ".join(["last_contact is null", *ranges]))
    if seen is None:
        nothing = F.lit(None).cast("long")
        return unique.withColumns({"_old_batch": nothing, "_old_time": nothing})
    stored = seen.select(
        *SNAPSHOT_KEY,
        F.col("kept").alias("_kept"),
        F.col("arrived").alias("_arrived"),
        F.col("batch").alias("_batch"),
    )
    # One shuffle and one sort for the stored rows: in a key's order the batch's row, which
    # has no number yet, follows the latest version.
    latest = f"""lag(struct(_batch, _kept, _arrived)) over (
        partition by {", ".join(map(quoted, SNAPSHOT_KEY))} order by _batch nulls last)"""
    rows = unique.unionByName(stored, allowMissingColumns=True)
    rows = rows.withColumn("_known", F.expr(latest)).filter("_batch is null")
    if within is not None:
        counts = F.expr(f"_known._arrived >= current_timestamp() - interval {within}")
        rows = rows.withColumn("_known", F.when(counts, F.col("_known")))
    newer = F.struct(*map(quoted, order)) < F.col("_known._kept")
    return (
        rows.filter(F.col("_known").isNull() | newer)
        .withColumns({"_old_batch": F.col("_known._batch"), "_old_time": F.col("_known._kept.time")})
        .drop("_kept", "_arrived", "_batch", "_known")
    )


#: So many ranges of last contact, one a day, go into one filter; beyond, their hull does.
_RANGES = 64


def _retract(changed: DataFrame, path: str, number: int) -> None:
    """Note the rows of earlier batches that rows of this one replace."""
    replaced = changed.filter("_old_batch is not null")
    if replaced.isEmpty():
        return
    old = replaced.select(
        *SNAPSHOT_KEY, F.col("_old_batch").alias("gone"), F.col("_old_time").alias("time")
    )
    rows = with_silver_time(old).drop("time").withColumn(BATCH, F.lit(number))
    write_table(rows, f"{path}/{RETRACTED}", (*DAY_PARTITION, BATCH), "dynamic")


def compact_silver(
    spark: SparkSession, path: str, compacted: str, day: str | Iterable[str]
) -> WriteResult:
    """Write days of a streamed silver table as few files into a table without batches.

    The days are replaced there, so the job may run again. ``day`` is a folder's date; several
    are written by one job, which uses all cores where one day has too few files for that.
    """
    return write_table(read_streamed(spark, path, day), compacted, replace="dynamic")
