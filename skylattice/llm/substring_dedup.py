"""Substring deduplication with fixed-block anchors.

Reference blocks of ``window // 2`` words that do not overlap are indexed for every
document, and every rolling window of that width is looked up among them. A repeat of
``window`` words always holds a whole block of either side, so the hits lose no
repeat. Windows of the full width around a hit are then compared by their digest; the
smallest document of each digest is found and the windows of larger documents are
removed. Neighbouring windows merge, which extends a hit to the maximal repeat.

How the lookups travel: documents are dealt to units of bounded size by their id and text,
so rows without an id, or many texts under one id, are spread like any others (only rows alike
in both share a unit). A unit asks about its distinct digests only, sorted, as one packed row
for each bucket of the index; there are as many buckets as bound what one of them is asked.
Answers come back in the same order: one bit for a block lookup, the smallest
document for a full window. So a passage that a third of all documents share is asked
about once per unit, and neither its documents nor their pairs meet anywhere. Texts are
shuffled once; the units' exchange is the same in all three passes and Spark reuses it.

Defined results: null texts have no words. Repeats inside one document stay; so do those
of rows with the same ``doc_id``. A null ``doc_id`` counts as larger than all others and
gives null back. An empty table gives an empty result. Windows are judged on the input.
Digests have 64 bits in lookups and 96 bits where removal is decided. Other columns are
not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from skylattice.llm.common import (
    Words,
    encoded,
    groups_of,
    mix,
    shuffle_width,
    text_pieces,
    windows,
)

WINDOW_WORDS = 50
#: Bytes of text in one unit; a unit's digests are held in one task.
UNIT_BYTES = 8 << 20
#: Bytes of text for each bucket of the index; about so much is asked of a bucket as well.
BUCKET_BYTES = 64 << 20

_UNKNOWN = np.iinfo(np.int64).max

_ASK = "bucket int, unit int, asked binary, own binary, blocks binary"
_ANSWER = "unit int, bucket int, kind int, answer binary"


class Unit:
    """Word digests of a unit's documents and its distinct block lookups, sorted."""

    def __init__(self, ids: np.ndarray, texts: list[bytes], width: int):
        self.width, self.block = width, max(1, width // 2)
        digests, counts = [], []
        at = 0
        while at < len(texts):
            stop, size = at, 0
            while stop < len(texts) and (stop == at or size + len(texts[stop]) < 4 << 20):
                size += len(texts[stop])
                stop += 1
            words = Words(texts[at:stop])
            digests.append(words.digest)
            counts.append(np.diff(words.first))
            at = stop
        self.ids = ids
        self.digest = np.concatenate(digests) if digests else np.zeros(0, dtype=np.uint64)
        sizes = np.concatenate(counts) if counts else np.zeros(0, dtype=np.int64)
        self.first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.document = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
        self.starts, self.looked_up = windows(self.digest, self.first, self.block)
        self.order = np.argsort(self.looked_up, kind="stable")
        ordered = self.looked_up[self.order]
        self.begins, self.sizes = groups_of(ordered)
        self.asked = ordered[self.begins]

    def local_repeats(self) -> np.ndarray:
        """Which distinct lookups occur in two documents of the unit."""
        ids = self.ids[self.document[self.starts[self.order]]]
        if not len(ids):
            return np.zeros(0, dtype=bool)
        return np.minimum.reduceat(ids, self.begins) < np.maximum.reduceat(ids, self.begins)

    def own_blocks(self) -> np.ndarray:
        offset = self.starts - self.first[self.document[self.starts]]
        return np.unique(self.looked_up[offset % self.block == 0])

    def candidates(self, hits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, digests and check digests of full windows that hold a hit."""
        starts, digest = windows(self.digest, self.first, self.width)
        hit = np.zeros(len(self.digest) + 1, dtype=np.int64)
        chosen = np.repeat(hits, self.sizes)
        hit[self.starts[self.order[chosen]] + 1] = 1
        hit = np.cumsum(hit)
        near = hit[starts + self.width - self.block + 1] > hit[starts]
        starts = starts[near]
        if not len(starts):
            return starts, np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint32)
        # Another sum over the same words, by differently mixed digests.
        _, check = windows(mix(self.digest ^ np.uint64(0xA5A5A5A5A5A5A5A5)), self.first, self.width)
        return starts, digest[near], (check[near] >> np.uint64(32)).astype(np.uint32)


def _cuts(ordered: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins in sorted digests; buckets are ranges of equal width."""
    edges = [(b << 64) // buckets for b in range(1, buckets)]
    inner = np.searchsorted(ordered, np.array(edges, dtype=np.uint64), side="left")
    return np.concatenate([[0], inner, [len(ordered)]])


def _packed(values: np.ndarray) -> bytes:
    """Sorted unsigned digests as 4-byte gaps where they fit, else as they are.

    Digests are compared by their upper 48 bits in block lookups.
    """
    short = (values >> np.uint64(16)).astype(np.uint64)
    if len(short) > 1:
        gaps = np.diff(short)
        if gaps.max() < 1 << 32:
            return b"g" + short[:1].tobytes() + gaps.astype(np.uint32).tobytes()
    return b"p" + short.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    if data[:1] == b"p":
        return np.frombuffer(data, dtype=np.uint64, offset=1)
    first = np.frombuffer(data, dtype=np.uint64, offset=1, count=1)
    gaps = np.frombuffer(data, dtype=np.uint32, offset=9).astype(np.uint64)
    return np.cumsum(np.concatenate([first, gaps]), dtype=np.uint64)


def _units(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[int, Unit]]:
    """Units of a partition; documents of one unit may come in any order."""
    held: dict[int, tuple[list, list]] = {}
    for batch in text_pieces(batches):
        for unit, doc_id, text in zip(
            batch.column("unit").to_pylist(),
            batch.column("doc_id").to_pylist(),
            encoded(batch.column("text")),
            strict=True,
        ):
            ids, texts = held.setdefault(unit, ([], []))
            ids.append(_UNKNOWN if doc_id is None else doc_id)
            texts.append(text)
    for unit in sorted(held):
        ids, texts = held.pop(unit)
        yield unit, Unit(np.array(ids, dtype=np.int64), texts, width)


def _ask_blocks(width: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, unit in _units(batches, width):
            local, blocks = unit.local_repeats(), unit.own_blocks()
            cuts, block_cuts = _cuts(unit.asked, buckets), _cuts(blocks, buckets)
            for b in range(buckets):
                part = slice(cuts[b], cuts[b + 1])
                if part.start == part.stop:
                    continue
                yield pa.RecordBatch.from_pydict(
                    {
                        "bucket": [b],
                        "unit": [number],
                        "asked": [_packed(unit.asked[part])],
                        "own": [np.packbits(local[part]).tobytes()],
                        "blocks": [_packed(blocks[block_cuts[b] : block_cuts[b + 1]])],
                    },
                    schema=pa.schema(
                        [
                            ("bucket", pa.int32()),
                            ("unit", pa.int32()),
                            ("asked", pa.binary()),
                            ("own", pa.binary()),
                            ("blocks", pa.binary()),
                        ]
                    ),
                )

    return run


def _answer(unit: int, bucket: int, kind: int, data: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {"unit": [unit], "bucket": [bucket], "kind": [kind], "answer": [data]},
        schema=pa.schema(
            [
                ("unit", pa.int32()),
                ("bucket", pa.int32()),
                ("kind", pa.int32()),
                ("answer", pa.binary()),
            ]
        ),
    )


def _answer_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A bit for each lookup: it is a block and occurs in two documents."""
    rows: dict[int, list[tuple[int, bytes, bytes, bytes]]] = {}
    for batch in batches:
        for row in batch.to_pylist():
            rows.setdefault(row["bucket"], []).append(
                (row["unit"], row["asked"], row["own"], row["blocks"])
            )
    for bucket in sorted(rows):
        asks = rows.pop(bucket)
        index = np.unique(np.concatenate([_unpacked(blocks) for *_, blocks in asks]))
        found, seen = [], np.zeros(len(index), dtype=np.int32)
        for _, asked, own, _ in asks:
            digests = _unpacked(asked)
            place = np.searchsorted(index, digests)
            place[place == len(index)] = 0
            there = (
                np.flatnonzero(index[place] == digests) if len(index) else np.zeros(0, np.int64)
            )
            place = place[there]
            again = np.unpackbits(np.frombuffer(own, dtype=np.uint8), count=len(digests))[there]
            np.add.at(seen, place, 1 + again)
            found.append((len(digests), there, place))
        for (unit, *_), (n, there, place) in zip(asks, found, strict=True):
            bits = np.zeros(n, dtype=bool)
            bits[there[seen[place] > 1]] = True
            yield _answer(unit, bucket, 0, np.packbits(bits).tobytes())


def _hits(unit: Unit, answers: list[tuple[int, bytes]], buckets: int) -> np.ndarray:
    cuts = _cuts(unit.asked, buckets)
    hits = np.zeros(len(unit.asked), dtype=bool)
    for bucket, data in answers:
        n = cuts[bucket + 1] - cuts[bucket]
        hits[cuts[bucket] : cuts[bucket + 1]] = np.unpackbits(
            np.frombuffer(data, dtype=np.uint8), count=n
        )
    return hits


class _Windows:
    """A unit's distinct candidate windows, sorted by digest and check digest."""

    def __init__(self, unit: Unit, hits: np.ndarray):
        self.starts, digest, check = unit.candidates(hits)
        self.order = np.lexsort((check, digest))
        digest, check = digest[self.order], check[self.order]
        new = (
            np.concatenate([[True], (digest[1:] != digest[:-1]) | (check[1:] != check[:-1])])
            if len(digest)
            else np.zeros(0, dtype=bool)
        )
        self.begins = np.flatnonzero(new)
        self.sizes = np.diff(np.concatenate([self.begins, [len(digest)]]))
        self.digest, self.check = digest[self.begins], check[self.begins]
        ids = unit.ids[unit.document[self.starts[self.order]]]
        self.ids = ids
        self.least = np.minimum.reduceat(ids, self.begins) if len(ids) else ids


def _table_unit(table: pa.Table, width: int) -> Unit:
    ids = [_UNKNOWN if x is None else x for x in table.column("doc_id").to_pylist()]
    texts = [x for chunk in table.column("text").chunks for x in encoded(chunk)]
    return Unit(np.array(ids, dtype=np.int64), texts, width)


def _answers(table: pa.Table, kind: int) -> list[tuple[int, bytes]]:
    rows = table.select(["bucket", "kind", "answer"]).to_pylist()
    return [(r["bucket"], r["answer"]) for r in rows if r["kind"] == kind]


_WINDOW_ARROW = pa.schema(
    [
        ("bucket", pa.int32()),
        ("unit", pa.int32()),
        ("digest", pa.binary()),
        ("check", pa.binary()),
        ("least", pa.binary()),
    ]
)


def _ask_windows(width: int, buckets: int):
    def run(key: tuple, documents: pa.Table, answers: pa.Table) -> pa.Table:
        number = key[0].as_py()
        unit = _table_unit(documents, width)
        asked = _Windows(unit, _hits(unit, _answers(answers, 0), buckets))
        cuts = _cuts(asked.digest, buckets)
        used = [b for b in range(buckets) if cuts[b] < cuts[b + 1]]
        parts = [slice(cuts[b], cuts[b + 1]) for b in used]
        return pa.Table.from_pydict(
            {
                "bucket": used,
                "unit": [number] * len(used),
                "digest": [asked.digest[p].tobytes() for p in parts],
                "check": [asked.check[p].tobytes() for p in parts],
                "least": [asked.least[p].tobytes() for p in parts],
            },
            schema=_WINDOW_ARROW,
        )

    return run


def _answer_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The smallest document of each window asked about."""
    rows: dict[int, list[dict]] = {}
    for batch in batches:
        for row in batch.to_pylist():
            rows.setdefault(row["bucket"], []).append(row)
    for bucket in sorted(rows):
        asks = rows.pop(bucket)
        digest = np.concatenate([np.frombuffer(r["digest"], dtype=np.uint64) for r in asks])
        check = np.concatenate([np.frombuffer(r["check"], dtype=np.uint32) for r in asks])
        least = np.concatenate([np.frombuffer(r["least"], dtype=np.int64) for r in asks])
        order = np.lexsort((check, digest))
        d, c = digest[order], check[order]
        begins = np.flatnonzero(
            np.concatenate([[True], (d[1:] != d[:-1]) | (c[1:] != c[:-1])])
        )
        sizes = np.diff(np.concatenate([begins, [len(d)]]))
        answer = np.empty(len(d), dtype=np.int64)
        answer[order] = np.repeat(np.minimum.reduceat(least[order], begins), sizes)
        at = 0
        for row in asks:
            n = len(row["least"]) // 8
            yield _answer(row["unit"], bucket, 1, answer[at : at + n].tobytes())
            at += n


_RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"


def _remove(width: int, buckets: int, with_text: bool):
    def run(documents: pa.Table, answers: pa.Table) -> pa.Table:
        unit = _table_unit(documents, width)
        asked = _Windows(unit, _hits(unit, _answers(answers, 0), buckets))
        cuts = _cuts(asked.digest, buckets)
        least = asked.least.copy()
        for bucket, data in _answers(answers, 1):
            least[cuts[bucket] : cuts[bucket + 1]] = np.frombuffer(data, dtype=np.int64)
        gone = np.repeat(least, asked.sizes) < asked.ids
        cover = np.zeros(len(unit.digest) + 1, dtype=np.int32)
        starts = asked.starts[asked.order[gone]]
        np.add.at(cover, starts, 1)
        np.add.at(cover, starts + width, -1)
        kept = np.cumsum(cover)[:-1] == 0
        texts = (x for chunk in documents.column("text").chunks for x in encoded(chunk))
        removed, digests, kept_texts = [], [], []
        for i, text in enumerate(texts):
            keep = kept[unit.first[i] : unit.first[i + 1]]
            words = text.split()
            if not keep.all():
                words = [w for w, k in zip(words, keep.tolist(), strict=True) if k]
            joined = b" ".join(words)
            removed.append(len(keep) - len(words))
            digests.append(hashlib.sha256(joined).hexdigest())
            kept_texts.append(joined.decode() if with_text else None)
        return pa.table(
            {
                "doc_id": documents.column("doc_id"),
                "n_words": pa.array(np.diff(unit.first)),
                "n_removed": pa.array(removed, pa.int64()),
                "kept_sha256": pa.array(digests, pa.string()),
                "kept_text": pa.array(kept_texts, pa.string()),
            }
        )

    return run


def _dealt(rows: DataFrame, units: int) -> DataFrame:
    """Rows with their unit; the windows of one id may lie in several, as removal compares ids."""
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(units))
    return rows.withColumn("unit", place.cast("int"))


def remove_repeats(
    docs: DataFrame,
    window: int = WINDOW_WORDS,
    unit_bytes: int = UNIT_BYTES,
    with_text: bool = False,
    id_column: str = "doc_id",
    text_column: str = "text",
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 and, on demand, kept_text.

    ``kept_text`` has the kept words joined by one space.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"),
        F.col(f"`{text_column}`").cast("string").alias("text"),
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    width = shuffle_width(spark)
    buckets = max(width, size // bucket_bytes + 1)
    units = max(width, size // unit_bytes + 1)
    dealt = _dealt(rows, units).repartition(units, "unit")
    asked = dealt.mapInArrow(_ask_blocks(window, buckets), _ASK)
    hits = asked.repartition(buckets, "bucket").mapInArrow(_answer_blocks, _ANSWER)
    by_unit = dealt.groupBy("unit")
    windows_asked = by_unit.cogroup(hits.groupBy("unit")).applyInArrow(
        _ask_windows(window, buckets),
        "bucket int, unit int, digest binary, check binary, least binary",
    )
    first = windows_asked.repartition(buckets, "bucket").mapInArrow(_answer_windows, _ANSWER)
    result = by_unit.cogroup(hits.unionByName(first).groupBy("unit")).applyInArrow(
        _remove(window, buckets, with_text), _RESULT
    )
    return result if with_text else result.drop("kept_text")
