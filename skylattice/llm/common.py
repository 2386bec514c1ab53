"""Helpers that several operators share: words, digests of words, Arrow batches.

Words are ``[^\\x20\\x09-\\x0D]+`` in UTF-8 bytes, which is what ``bytes.split()``
gives. Digests of words and of word windows are 64-bit polynomial sums over
prefix sums, finished by a mixing step, so a whole batch is handled by a few
numpy calls.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from skylattice.scratch import new_path

WHITE_SPACE = b" \t\n\x0b\x0c\r"

_IS_WHITE = np.zeros(256, dtype=bool)
_IS_WHITE[list(WHITE_SPACE)] = True

#: Any odd number serves as base; it has an inverse modulo 2^64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)

#: Bytes of text whose digests are computed at a time.
SEGMENT_BYTES = 1 << 20

#: Bytes of text that an operator holds at a time inside a task.
PIECE_BYTES = 1 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table to the shared folder and read it back, which cuts lineage."""
    spark = df.sparkSession
    path = new_path(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_pieces(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = PIECE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``limit`` bytes of text; texts stay whole."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(
            zero_copy_only=False
        )
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
    # Workers are used again by later stages; give back what the batches took.
    pa.default_memory_pool().release_unused()


def encoded(column: pa.Array) -> list[bytes]:
    """Texts in UTF-8; null counts as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_TABLES: dict[str, np.ndarray] = {}


def _table(name: str, base: int, n: int) -> np.ndarray:
    if name not in _TABLES or len(_TABLES[name]) < n:
        grown = powers(base, max(n, SEGMENT_BYTES + 1))
        if len(grown) > 8 * SEGMENT_BYTES:
            return grown  # for one extreme text; not worth keeping
        _TABLES[name] = grown
    return _TABLES[name][:n]


def range_digests(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Digest of ``values[starts[i]:ends[i]]`` for each i, independent of the place."""
    n = len(values)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(values.astype(np.uint64, copy=False) * _table("up", _BASE, n), out=sums[1:])
    out = (sums[ends] - sums[starts]) * _table("down", _INVERSE, n + 1)[starts]
    return mix(out + mix((ends - starts).astype(np.uint64) + np.uint64(1)))


class Words:
    """Words of a list of texts: byte ranges, 64-bit digests, and each text's first word.

    ``first`` has one entry more than there are texts; the words of text i are
    ``first[i]:first[i + 1]``.
    """

    def __init__(self, texts: list[bytes], digests: bool = True):
        self.data = b"\n".join(texts)
        sizes = np.fromiter((len(x) + 1 for x in texts), dtype=np.int64, count=len(texts))
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        raw = np.frombuffer(self.data, dtype=np.uint8)
        edges = np.diff(np.concatenate([[True], _IS_WHITE[raw], [True]]).astype(np.int8))
        self.starts = np.flatnonzero(edges == -1)
        self.ends = np.flatnonzero(edges == 1)
        self.first = np.searchsorted(self.starts, bounds)
        self.digest = self._digests(raw) if digests else None

    def __len__(self) -> int:
        return len(self.starts)

    def _digests(self, raw: np.ndarray) -> np.ndarray:
        out = np.empty(len(self), dtype=np.uint64)
        at = 0
        while at < len(self):
            origin = self.starts[at]
            stop = int(np.searchsorted(self.ends, origin + SEGMENT_BYTES, side="right"))
            stop = max(stop, at + 1)
            segment = raw[origin : self.ends[stop - 1]]
            out[at:stop] = range_digests(
                segment, self.starts[at:stop] - origin, self.ends[at:stop] - origin
            )
            at = stop
        return out


def windows(digest: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and digests of all windows of ``width`` words that lie in one text."""
    n = len(digest)
    if n < width:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    inside = np.zeros(n + 1, dtype=np.int32)
    lengths = np.diff(first)
    long = lengths >= width
    np.add.at(inside, first[:-1][long], 1)
    np.add.at(inside, first[1:][long] - width + 1, -1)
    starts = np.flatnonzero(np.cumsum(inside)[:n] > 0)
    return starts, range_digests(digest, starts, starts + width)


def groups_of(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index and size of each run of equal keys."""
    if not len(sorted_keys):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    begins = np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]))
    return begins, np.diff(np.concatenate([begins, [len(sorted_keys)]]))


def whole_groups(
    batches: Iterator[pa.RecordBatch], key: str
) -> Iterator[pa.Table]:
    """Regroup key-sorted batches so that no run of equal keys is cut in two."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(keys, keys[-1], side="left"))
        if cut or (held and held[-1].column(key)[-1].as_py() != keys[0]):
            table = pa.Table.from_batches([*held, batch.slice(0, cut)])
            if table.num_rows:
                yield table
            held = [batch.slice(cut)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)
