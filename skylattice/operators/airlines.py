"""The airline dimension and its join to snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from skylattice.functions import airline_key, quoted

#: Largest dimension that is sent to every executor.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
#: Parts into which the rows of one busy key are split when it is not broadcast.
JOIN_SALTS = 32
#: Keys that the search for busy ones follows at a time.
_FOLLOWED_KEYS = 4_096


def clean_airlines(raw: DataFrame) -> DataFrame:
    """One row per airline code: active ones first, then the lowest number.

    Codes are trimmed and upper-cased, empty ones removed. An airline number that
    is not numeric sorts as NULL instead of failing the job; the name settles
    what is left, so the choice is the same on every run.
    """
    coded = raw.withColumn("ICAO", F.expr("upper(trim(ICAO))")).filter("ICAO <> ''")
    rank = """row_number() over (
        partition by ICAO
        order by if(upper(Active) = 'Y', 0, 1), try_cast(`Airline ID` as bigint),
                 Nome, `Airline ID`)"""
    return coded.withColumn("_rank", F.expr(rank)).filter("_rank = 1").drop("_rank")


def joinable_airlines(airlines: DataFrame) -> DataFrame:
    """Airlines a three-letter key can reach; the others can never match."""
    return airlines.filter("length(ICAO) <= 3")


def table_bytes(df: DataFrame) -> int:
    """Size of a text table as one small aggregate job; only a number returns."""
    per_row = " + ".join(
        f"coalesce(octet_length({quoted(name)}), 0) + 16" for name in df.columns
    )
    return df.agg(F.expr(f"coalesce(sum(cast({per_row} as bigint)), 0)")).first()[0]


def busy_keys(keyed: DataFrame, salts: int) -> list[str]:
    """Keys that hold more than their share of the rows, as one small aggregate job.

    A sketch follows the most frequent keys, so its size is bounded however many there
    are, and at most ``2 * salts`` come back. A key with a part of more than ``1 / (2 * salts)``
    of the rows is among them unless more than its followed keys are about as frequent.
    """
    wanted = 2 * salts
    found = keyed.filter("_key is not null").agg(
        F.expr("count(*) as n"),
        F.expr(f"approx_top_k(_key, {wanted}, {max(_FOLLOWED_KEYS, 2 * wanted)}) as top"),
    ).first()
    return [item.item for item in found.top or [] if item["count"] * wanted > found.n]


def join_airlines(
    snapshots: DataFrame,
    airlines: DataFrame,
    broadcast_limit_bytes: int = BROADCAST_LIMIT_BYTES,
    salts: int = JOIN_SALTS,
) -> DataFrame:
    """Left outer join of snapshots to cleaned airlines by call-sign prefix.

    The dimension's size is measured first (one small job). Up to the limit it is
    broadcast and the snapshots are not shuffled. Beyond it both sides are
    shuffled on (code, salt). Only the keys that hold a large part of the rows, found by
    :func:`busy_keys`, are spread over ``salts`` tasks, whether an airline has them or not,
    and only their airlines are copied; all other rows of the dimension travel once. The
    result is the same. On a stream of snapshots, which cannot be measured, every key
    counts as busy.
    """
    dimension = joinable_airlines(airlines)
    keyed = snapshots.withColumn("_key", airline_key("callsign"))
    if table_bytes(dimension) <= broadcast_limit_bytes:
        return keyed.join(F.broadcast(dimension), F.expr("_key = ICAO"), "left").drop("_key")
    busy = None if snapshots.isStreaming else busy_keys(keyed, salts)
    # Rows without a key match nothing and may go anywhere.
    spread = F.lit(True) if busy is None else F.col("_key").isNull() | F.col("_key").isin(busy)
    salt = F.expr(f"cast(pmod(xxhash64(icao24, last_contact, time), {salts}) as int)")
    return (
        keyed.withColumn("_salt", F.when(spread, salt).otherwise(0))
        .join(
            with_copies(dimension, busy, salts), F.expr("_key = ICAO and _salt = _copy"), "left"
        )
        .drop("_key", "_salt", "_copy")
    )


def with_copies(dimension: DataFrame, busy: list[str] | None, salts: int) -> DataFrame:
    """Airlines of busy codes (None: of all) once for each salt, the others once."""
    copied = F.lit(True) if busy is None else F.col("ICAO").isin(busy)
    copies = F.when(copied, F.expr(f"sequence(0, {salts - 1})")).otherwise(F.array(F.lit(0)))
    return dimension.withColumn("_copy", F.explode(copies))
