"""Line deduplication by a deletion-neighbourhood join.

Two lines count as the same if one word insertion, deletion or replacement turns one into
the other (lines of fewer than ``least_words`` words must be equal). The earliest occurrence
in the order (doc_id, line number) stays. A line emits, as hashed keys, all variants with
one word deleted:

* lines of n words that differ in word i leave the same variant at i, so the key
  (variant, i, n) joins them; any two lines under such a key are within the bound;
* a line with one more word has the other line itself as a variant, so the key (variant)
  joins the longer lines to the line that is the variant.

Each key keeps only the earliest line (and, for the second kind, the earliest among the
longer lines and the line itself), by partial aggregation, so a template that a third of
all lines share never gives pairs. What a line learns from its keys is joined back by a
second aggregation, and the earliest partner is verified on the words themselves.

Equal lines are folded first: only distinct lines emit keys. Of these, only lines that can
have a partner do: within one edit, one half of the words is equal in place from the front
or from the back, so a line whose halves occur in no other line is left out without loss.
All this runs on digests; the words of the lines that are left are fetched by a second scan
of the texts, with a broadcast of their digests if they are few, else with a join by shuffle.

Defined results: lines end at ``\\n``; words are ``[^\\x20\\x09-\\x0D]+`` and lines with the
same words are equal. Lines without words and null texts are no lines. A null ``doc_id``
comes after all others. Repeated rows are told apart by the order in which they are read,
so of repeated rows one keeps its lines. Extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from skylattice.llm.common import Words, encoded, mix, range_digests, store, text_pieces

LEAST_WORDS = 8
#: Lines with a possible partner whose digests are broadcast; more are joined by shuffle.
BROADCAST_LINES = 1_000_000

_LAST = np.iinfo(np.int64).max


def _scan(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row for each line with words: its 128-bit digest, and place or text."""
        for batch in text_pieces(batches):
            texts = encoded(batch.column("text"))
            split = [x.split(b"\n") for x in texts]
            counts = np.array([len(x) for x in split], dtype=np.int64)
            document = np.repeat(np.arange(len(texts)), counts)
            number = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            lines = [line for x in split for line in x]
            words = Words(lines)
            first, last = words.first[:-1], words.first[1:]
            kept = np.flatnonzero(last > first)
            first, last = first[kept], last[kept]
            low = range_digests(words.digest, first, last)
            other = mix(words.digest ^ np.uint64(0xC3C3C3C3C3C3C3C3))
            high = range_digests(other, first, last)
            columns = {"low": low.view(np.int64), "high": high.view(np.int64)}
            if with_text:
                columns["text"] = pa.array([lines[i] for i in kept.tolist()], pa.binary())
            else:
                at = pa.array(document[kept])
                columns |= {
                    "doc_id": batch.column("doc_id").take(at),
                    "row": batch.column("row").take(at),
                    "line": number[kept].astype(np.int32),
                    "n": (last - first).astype(np.int32),
                }
                for i, key in enumerate(_halves(words.digest, first, last)):
                    columns[f"half{i}"] = key.view(np.int64)
            yield pa.RecordBatch.from_pydict(columns)

    return run


def _halves(digest: np.ndarray, first: np.ndarray, last: np.ndarray) -> Iterator[np.ndarray]:
    """Keys of the halves that a line has in common with any line within one edit.

    For lines of c and of c or c + 1 words: the first c // 2 words, or the last
    c - c // 2, are the same.
    """
    n = last - first
    for c in (n, n - 1):
        front, back = c // 2, c - c // 2
        for side, a, b in ((1, first, first + front), (2, last - back, last)):
            yield mix(range_digests(digest, a, b) ^ mix((c * 4 + side).astype(np.uint64)))


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Deletion variants of each line as keys.

    ``kind`` 0: lines that differ in one place. ``kind`` 1: the line itself; ``kind`` 2: a
    line with one more word; these two share their keys.
    """
    for batch in text_pieces(batches, limit=1 << 20):
        words = Words(encoded(batch.column("text")))
        first = words.first
        n = np.diff(first)
        line = np.repeat(np.arange(len(n)), n)
        at = np.arange(len(words))
        front = range_digests(words.digest, first[line], at)
        back = range_digests(words.digest, at + 1, first[line + 1])
        place = (at - first[line]).astype(np.uint64)
        replaced = mix(front ^ mix(back + mix(place * np.uint64(2) + np.uint64(1)))
                       + mix(n[line].astype(np.uint64)))
        shorter, itself = _without(words.digest, first, line)
        keys = np.concatenate([replaced, itself, shorter])
        kinds = np.repeat(np.array([0, 1, 2], dtype=np.int8), [len(at), len(n), len(at)])
        owner = np.concatenate([line, np.arange(len(n)), line])
        takes = pa.array(owner)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(keys.view(np.int64)),
                pa.array(kinds),
                batch.column("line_id").take(takes),
            ],
            ["key", "kind", "line_id"],
        )


def _without(
    digest: np.ndarray, first: np.ndarray, line: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Digests of each line without each of its words, and of each line."""
    base = np.uint64(0x9E3779B97F4A7C15)
    n = np.diff(first)
    place = np.arange(len(digest)) - first[line]
    longest = int(n.max()) + 1 if len(n) else 1
    power = np.cumprod(
        np.concatenate([[np.uint64(1)], np.full(longest, base, dtype=np.uint64)]), dtype=np.uint64
    )
    ahead = np.concatenate([[np.uint64(0)], np.cumsum(digest * power[place], dtype=np.uint64)])
    moved = np.concatenate(
        [[np.uint64(0)], np.cumsum(digest * power[np.maximum(place - 1, 0)], dtype=np.uint64)]
    )
    at = np.arange(len(digest))
    front = ahead[at] - ahead[first[line]]
    back = moved[first[line + 1]] - moved[at + 1]
    whole = ahead[first[1:]] - ahead[first[:-1]]
    length = mix(n.astype(np.uint64) + np.uint64(7))
    return (
        mix(front + back + mix((n[line] - 1).astype(np.uint64) + np.uint64(7))),
        mix(whole + length),
    )


def _within_one(a: list[bytes], b: list[bytes]) -> bool:
    if abs(len(a) - len(b)) > 1:
        return False
    front = 0
    while front < min(len(a), len(b)) and a[front] == b[front]:
        front += 1
    if len(a) == len(b):
        return a[front + 1 :] == b[front + 1 :]
    longer, shorter = (a, b) if len(a) > len(b) else (b, a)
    return longer[front + 1 :] == shorter[front:]


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        same = [
            _within_one(a.split(), b.split())
            for a, b in zip(
                encoded(batch.column("text")), encoded(batch.column("other")), strict=True
            )
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column("line_id").filter(pa.array(same))], ["line_id"]
        )


def repeated_lines(
    docs: DataFrame,
    least_words: int = LEAST_WORDS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per line with words: doc_id, line, kept.

    Lines are numbered from 0, blank ones counted.
    """
    rows = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"),
        F.col(f"`{text_column}`").cast("string").alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    halves = [f"half{i}" for i in range(4)]
    lines = store(
        rows.mapInArrow(
            _scan(with_text=False),
            "low long, high long, doc_id long, row long, line int, n int, "
            + ", ".join(f"{x} long" for x in halves),
        ),
        "lines",
    )
    # An occurrence's place in the order; null ids last.
    place = F.struct(F.coalesce("doc_id", F.lit(_LAST)).alias("doc_id"), "row", "line")
    # Distinct lines, numbered in the order of their first occurrence.
    distinct = store(
        lines.groupBy("low", "high", "n")
        .agg(F.min(place).alias("place"), *(F.first(x).alias(x) for x in halves))
        .orderBy("place")
        .withColumn("line_id", F.monotonically_increasing_id()),
        "distinct-lines",
    )
    keyed = distinct.filter(F.col("n") >= least_words).select(
        "line_id", F.explode(F.array(*halves)).alias("key")
    )
    shared = (
        keyed.groupBy("key")
        .agg(F.min("line_id").alias("a"), F.max("line_id").alias("b"))
        .filter("a < b")
        .select("key")
    )
    possible = store(
        distinct.join(keyed.join(shared, "key").select("line_id"), "line_id", "left_semi").select(
            "line_id", "low", "high"
        ),
        "possible-lines",
    )
    few = possible.count() <= BROADCAST_LINES
    texts = store(
        rows.mapInArrow(_scan(with_text=True), "low long, high long, text binary")
        .join(F.broadcast(possible) if few else possible, ["low", "high"])
        .groupBy("line_id")
        .agg(F.first("text").alias("text")),
        "line-texts",
    )
    variants = store(
        texts.mapInArrow(_variants, "key long, kind byte, line_id long"), "variants"
    )

    def least(kind: int) -> Column:
        return F.min(F.when(F.col("kind") == kind, F.col("line_id")))

    of_key = variants.groupBy("key").agg(
        least(0).alias("alike"),
        least(1).alias("itself"),
        least(2).alias("longer"),
        F.min("line_id").alias("a"),
        F.max("line_id").alias("b"),
    ).filter("a < b")
    partner = (
        F.when(F.col("kind") == 0, F.col("alike"))
        .when(F.col("kind") == 1, F.col("longer"))
        .otherwise(F.col("itself"))
    )
    earliest = (
        variants.join(of_key, "key")
        .withColumn("other_id", partner)
        .filter("other_id < line_id")
        .groupBy("line_id")
        .agg(F.min("other_id").alias("other_id"))
    )
    others = texts.select(F.col("line_id").alias("other_id"), F.col("text").alias("other"))
    gone = (
        earliest.join(texts, "line_id")
        .join(others, "other_id")
        .select("line_id", "text", "other")
        .mapInArrow(_verify, "line_id long")
        .withColumn("gone", F.lit(True))
    )
    leaders = (
        distinct.select("line_id", "low", "high", "n", F.col("place").alias("leader"))
        .join(gone, "line_id", "left")
        .filter("gone is null")
        .drop("line_id", "gone")
    )
    return lines.join(leaders, ["low", "high", "n"], "left").select(
        "doc_id", "line", F.coalesce(F.col("leader") == place, F.lit(False)).alias("kept")
    )
