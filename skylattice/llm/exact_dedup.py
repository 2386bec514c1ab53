"""Exact deduplication by Grace hashing.

Records are dealt to buckets by a hash of their content's digest. A bucket is
worked off with an open-addressing table that compares complete contents; what
does not fit the table's byte budget goes to a spill file in the shared folder and
is dealt again, by another hash and into more buckets, until nothing is left.
Copies are folded before the first deal, batch by batch, so a group that holds a
third of all rows sends one record per batch and not one per row.

The group's figures come from a second, narrow aggregation over records without
content. No group is gathered anywhere: members stay in the records of their batch.

Defined results: a null text is empty; texts are equal when identical without
``[\\x20\\x09-\\x0D]``; of equal texts the one with the most code points stays, then
the smallest ``doc_id`` (null last), then the first record read. Repeated rows with
the same id count as rows of their own, and exactly one row of a group has
``kept``. An empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from skylattice.llm.common import WHITE_SPACE, shuffle_width, store, text_pieces

#: Bytes of distinct contents that one bucket's table holds.
TABLE_BYTES = 64 << 20

_RECORD = (
    "digest binary, content binary, class long, members array<struct<doc_id:long,"
    "tag:long>>, best struct<chars:long,known:boolean,order:long,first:long>"
)
_ARROW = pa.schema(
    [
        ("digest", pa.binary()),
        ("content", pa.binary()),
        ("class", pa.int64()),
        ("members", pa.list_(pa.struct([("doc_id", pa.int64()), ("tag", pa.int64())]))),
        (
            "best",
            pa.struct(
                [
                    ("chars", pa.int64()),
                    ("known", pa.bool_()),
                    ("order", pa.int64()),
                    ("first", pa.int64()),
                ]
            ),
        ),
    ]
)


class ContentTable:
    """Open addressing with linear probing; a hit needs equal digest and equal content."""

    def __init__(self, budget: int):
        self.budget, self.used = budget, 0
        self.slots: list[int] = [-1] * 64
        self.entries: list[tuple[bytes, bytes, int]] = []

    def _slot(self, digest: bytes, content: bytes) -> int:
        mask = len(self.slots) - 1
        at = int.from_bytes(digest[:8], "little") & mask
        while (entry := self.slots[at]) >= 0:
            known, text, _ = self.entries[entry]
            if known == digest and text == content:
                return at
            at = (at + 1) & mask
        return at

    def put(self, digest: bytes, content: bytes, value: int) -> int | None:
        """The value stored for this content, at first ``value``; None if there is no room."""
        at = self._slot(digest, content)
        if (entry := self.slots[at]) >= 0:
            return self.entries[entry][2]
        if self.entries and self.used + len(content) > self.budget:
            return None
        self.slots[at] = len(self.entries)
        self.entries.append((digest, content, value))
        self.used += len(content) + 200
        if 2 * len(self.entries) > len(self.slots):
            self.slots = [-1] * (2 * len(self.slots))
            for i, (known, text, _) in enumerate(self.entries):
                self.slots[self._slot(known, text)] = i
        return value


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One record for each content of a batch, with the rows that have it."""
    tag = TaskContext.get().partitionId() << 33
    for batch in text_pieces(batches):
        table, records = ContentTable(1 << 62), []
        for doc_id, text in zip(
            batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True
        ):
            text = text or ""
            content = text.encode().translate(None, WHITE_SPACE)
            digest = hashlib.sha256(content).digest()
            at = table.put(digest, content, len(records))
            # ~x falls as x grows and never overflows.
            rank = (len(text), doc_id is not None, ~(doc_id or 0), ~tag)
            if at == len(records):
                records.append([digest, content, [], rank])
            records[at][2].append({"doc_id": doc_id, "tag": tag})
            records[at][3] = max(records[at][3], rank)
            tag += 1
        names = ("chars", "known", "order", "first")
        yield pa.RecordBatch.from_pydict(
            {
                "digest": [r[0] for r in records],
                "content": [r[1] for r in records],
                "class": [None] * len(records),
                "members": [r[2] for r in records],
                "best": [dict(zip(names, r[3], strict=True)) for r in records],
            },
            schema=_ARROW,
        )


def _settle(budget: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Give each record its class, or pass it on with its content when the table is full."""
        table = ContentTable(budget)
        for batch in text_pieces(batches, "content"):
            digests = batch.column("digest").to_pylist()
            contents = batch.column("content").to_pylist()
            firsts = [m[0]["tag"] for m in batch.column("members").to_pylist()]
            classes = [
                table.put(digest, content, first)
                for digest, content, first in zip(digests, contents, firsts, strict=True)
            ]
            left = [c if k is None else None for c, k in zip(contents, classes, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("digest"),
                    pa.array(left, pa.binary()),
                    pa.array(classes, pa.int64()),
                    batch.column("members"),
                    batch.column("best"),
                ],
                schema=_ARROW,
            )

    return run


def exact_groups(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    table_bytes: int = TABLE_BYTES,
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"),
        F.col(f"`{text_column}`").cast("string").alias("text"),
    )
    left, done, width, level = rows.mapInArrow(_fold, _RECORD), None, shuffle_width(spark), 0
    while True:
        dealt = left.repartition(width, F.xxhash64("digest", F.lit(level)))
        spilled = store(dealt.mapInArrow(_settle(table_bytes), _RECORD), f"exact-level{level}")
        settled = spilled.filter(F.col("class").isNotNull()).drop("content")
        done = settled if done is None else done.unionByName(settled)
        left = spilled.filter(F.col("class").isNull())
        size = left.agg(F.sum(F.octet_length("content") + 200)).first()[0]
        if not size:
            break
        width, level = max(width, 2 * size // table_bytes + 1), level + 1
    groups = done.groupBy("class").agg(
        F.sum(F.size("members")).alias("group_size"), F.max("best").alias("top")
    )
    top = F.col("top")
    return (
        done.select("class", "digest", "members")
        .join(groups, "class")
        .select("digest", "group_size", "top", F.explode("members").alias("member"))
        .select(
            F.col("member.doc_id").alias("doc_id"),
            F.when(top["known"], F.bitwise_not(top["order"])).alias("keep_id"),
            F.col("group_size").cast("long").alias("group_size"),
            (F.col("member.tag") == F.bitwise_not(top["first"])).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )
    )
