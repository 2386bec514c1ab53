"""Packing into as few sequences as possible: dominance reduction, then best fit.

A document's token ids end in one closing id; only documents of more than ``width`` ids are
cut, into pieces of ``width`` and a rest. Pieces are packed by size alone, and there are at
most ``width`` sizes, so all that a packing of the whole table needs is the number of pieces
of each size. That histogram is the only thing the driver reads, whatever the table's size:

1. **Dominance reduction** (Martello and Toth). A set of pieces that holds a given piece
   dominates the others that hold it if each of those can be matched, part by part, with
   pieces at least as large. The sequence that takes such a set is in some best packing and
   is fixed for good, as many times as the pieces last. Recognised are the sets of the piece
   alone (nothing fits beside it), with one more (it fills the rest, only one fits, or it
   outweighs every pair that fits) and with two more. Sizes are gone through from the
   largest until no set is found any more.
2. **Best fit** of the remainder, largest first, each piece into the fullest sequence that
   takes it, done for all pieces of a size and all sequences with equal room at a time.

The plan is a list of groups of sequences with the same content; there are a few groups for
each size. Pieces are then dealt out in Spark: a piece's rank among those of its size is its
rank within the task that wrote it plus a sum over the tasks before, and the rank tells the
sequence and the place. A size that holds a third of all pieces is ranked by many tasks and
gathered nowhere.

Ids are computed once and stored in the shared folder, so a lost executor repeats a task
and ranks stay as they are.

Defined results: a null or empty text is the closing id alone, one piece of length 1.
Repeated rows, and rows without a ``doc_id``, are packed one by one. Other columns are not
looked at. An empty table gives no row. Which of several pieces of one size takes which
place is left to the order in which they were read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from skylattice.llm.common import store, text_pieces
from skylattice.llm.word_tokens import word_tokens

WIDTH = 4_096
#: Id that ends each document.
END_ID = 1
#: Bytes of ids in one batch of output.
_BATCH_BYTES = 4 << 20
#: Sizes and ranks share one 64-bit key.
_RANK_BITS = 47


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@dataclass(frozen=True)
class Group:
    """``times`` sequences, each with so many pieces of each size, in order."""

    content: tuple[tuple[int, int], ...]
    times: int


def dominating_set(size: int, counts: dict[int, int], sizes: list[int], width: int):
    """What goes with a piece of ``size`` in a set that dominates all others, or None.

    ``sizes`` are those in ``counts`` in rising order; one piece of ``size`` is taken out.
    """
    room = width - size
    left = {size: counts[size] - 1}

    def count(s: int) -> int:
        return left.get(s, counts[s])

    small: list[int] = []
    for s in sizes:
        small += [s] * min(count(s), 3 - len(small))
        if len(small) == 3 or s > room:
            break
    if not small or small[0] > room:
        return ()
    at = bisect_right(sizes, room) - 1
    if not count(sizes[at]):
        at -= 1
    partner = sizes[at]
    if partner == room or len(small) < 2 or small[0] + small[1] > room:
        return (partner,)
    if len(small) == 3 and sum(small) <= room:
        return None  # three more may fit: no set of at most three is known to dominate
    best = _best_pair([s for s in sizes[: at + 1] if count(s)], count, room)
    if partner >= best:
        return (partner,)
    second = sizes[bisect_right(sizes, room - partner) - 1] if sizes[0] <= room - partner else 0
    if second and not (count(second) - (second == partner)):
        lower = [s for s in sizes[: sizes.index(second)] if count(s)]
        second = lower[-1] if lower else 0
    if second and partner + second == best:
        # A pair of two pieces larger than the second must not fit.
        between: list[int] = []
        for s in sizes[bisect_right(sizes, second) : at]:
            between += [s] * min(count(s), 2 - len(between))
        if len(between) < 2 or sum(between[:2]) > room:
            return (partner, second)
    return None


def _best_pair(sizes: list[int], count, room: int) -> int:
    """Largest sum of two pieces that fits, or 0."""
    best, low, high = 0, 0, len(sizes) - 1
    while low <= high:
        total = sizes[low] + sizes[high]
        if total > room or (low == high and count(sizes[low]) < 2):
            high -= 1
        else:
            best = max(best, total)
            low += 1
    return best


def reduce_by_dominance(counts: dict[int, int], width: int) -> tuple[list[Group], dict[int, int]]:
    """Sequences fixed by dominance, and the pieces that are left."""
    counts = {s: n for s, n in counts.items() if n}
    fixed: list[Group] = []
    found = True
    while found and counts:
        found = False
        for size in sorted(counts, reverse=True):
            while size in counts:
                others = dominating_set(size, counts, sorted(counts), width)
                if others is None:
                    break
                found = True
                content = Counter((size, *others))
                # The sets it is compared with only become fewer as pieces go.
                times = min(counts[s] // n for s, n in content.items())
                fixed.append(Group(tuple(sorted(content.items(), reverse=True)), times))
                for s, n in content.items():
                    counts[s] -= n * times
                    if not counts[s]:
                        del counts[s]
    return fixed, counts


def best_fit(counts: dict[int, int], width: int) -> list[Group]:
    """Pieces, largest first, each into the sequence with the least room that takes it."""
    open_: dict[int, list[Group]] = {width: []}
    rooms: list[int] = []

    def put(group: Group, room: int) -> None:
        if room not in open_ or not open_[room]:
            insort(rooms, room)
        open_.setdefault(room, []).append(group)

    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            at = bisect_left(rooms, size)
            room = rooms[at] if at < len(rooms) else width
            if at < len(rooms):
                group = open_[room].pop()
                if not open_[room]:
                    rooms.pop(at)
            else:
                group = Group((), left)  # as many new sequences as could be wanted
            # The first piece leaves less room than any other sequence has, so the next
            # ones follow it until it is full.
            fill = room // size
            full = min(group.times, left // fill)
            if full:
                put(Group((*group.content, (size, fill)), full), room - size * fill)
                left -= full * fill
            if group.times > full:
                rest = group.times - full
                if left:
                    put(Group((*group.content, (size, left)), 1), room - size * left)
                    left, rest = 0, rest - 1
                if rest and group.content:
                    put(Group(group.content, rest), room)
    return [group for groups in open_.values() for group in groups]


def packing_plan(counts: dict[int, int], width: int) -> list[Group]:
    fixed, left = reduce_by_dominance(counts, width)
    return [*fixed, *best_fit(left, width)]


class Places:
    """Sequence and offset by (size, rank) from a plan."""

    def __init__(self, plan: list[Group]):
        rows, first_sequence, used = [], 0, Counter()
        for group in plan:
            offset = 0
            for size, copies in group.content:
                rows.append((size, used[size], first_sequence, copies, offset))
                used[size] += copies * group.times
                offset += size * copies
            first_sequence += group.times
        rows.sort()
        table = np.array(rows, dtype=np.int64).reshape(-1, 5)
        self.size, self.rank, self.first, self.copies, self.offset = np.ascontiguousarray(table.T)
        self.key = (self.size << _RANK_BITS) + self.rank
        self.sequences = first_sequence

    def __call__(self, size: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.key, (size << _RANK_BITS) + rank, side="right") - 1
        within = rank - self.rank[at]
        sequence = self.first[at] + within // self.copies[at]
        return sequence, self.offset[at] + (within % self.copies[at]) * size


_PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids", pa.binary()),
        ("task", pa.int32()),
        ("rank_in_task", pa.int64()),
    ]
)
_PIECES_SQL = (
    "doc_id long, piece int, start long, length long, ids binary, task int, rank_in_task long"
)


def token_pieces(
    docs: DataFrame,
    width: int = WIDTH,
    vocabulary: str | None = None,
    end_id: int = END_ID,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Documents as pieces of at most ``width`` ids (little-endian, 32 bits each)."""
    path = vocabulary or vocabulary_path()
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, task = word_tokens(path), TaskContext.get().partitionId()
        ranks, rows, held = Counter(), [], 0
        for batch in text_pieces(batches):
            for doc_id, text in zip(
                batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True
            ):
                ids = (tokens.encode(text) if text else b"") + end
                for piece, at in enumerate(range(0, len(ids), 4 * width)):
                    part = ids[at : at + 4 * width]
                    length = len(part) // 4
                    rows.append((doc_id, piece, at // 4, length, part, task, ranks[length]))
                    ranks[length] += 1
                    held += len(part)
                if held >= _BATCH_BYTES:
                    yield _piece_batch(rows)
                    rows, held = [], 0
        if rows:
            yield _piece_batch(rows)

    rows = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"),
        F.col(f"`{text_column}`").cast("string").alias("text"),
    )
    return rows.mapInArrow(run, _PIECES_SQL)


def _piece_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    arrays = [pa.array(x, f.type) for x, f in zip(columns, _PIECES, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=_PIECES)


def place_pieces(pieces: DataFrame, width: int = WIDTH) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to stored pieces, or to some of their columns.

    Needs ``length``, ``task`` and ``rank_in_task`` of :func:`token_pieces`; the last two are
    dropped. What other columns there are goes through the one shuffle.
    """
    if not 1 <= width < 1 << 15:
        raise ValueError("width must be between 1 and 32767")
    by_task = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("pieces"))
    before = by_task.selectExpr(
        "length",
        "task",
        "sum(pieces) over (partition by length order by task) - pieces as rank_before",
    )
    # One row for each size, so never more than ``width``.
    sizes = by_task.groupBy("length").agg(F.sum("pieces").alias("pieces")).collect()
    places = Places(packing_plan({r.length: r.pieces for r in sizes}, width))
    kept = [name for name in pieces.columns if name not in ("task", "rank_in_task")]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, rank = (
                batch.column(name).to_numpy(zero_copy_only=False) for name in ("length", "rank")
            )
            sequence, offset = places(size, rank)
            arrays = [batch.column(name) for name in kept]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(sequence), pa.array(offset)],
                names=[*kept, "sequence_id", "offset"],
            )

    ranked = pieces.join(before, ["length", "task"]).select(
        *kept, F.expr("rank_in_task + rank_before").alias("rank")
    )
    placed = T.StructType([pieces.schema[name] for name in kept])
    return ranked.mapInArrow(deal, placed.add("sequence_id", "long").add("offset", "long"))


def pack_sequences(
    docs: DataFrame,
    width: int = WIDTH,
    vocabulary: str | None = None,
    end_id: int = END_ID,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Every piece with its ids, its sequence and its place there.

    Columns: ``doc_id, piece, start, length, ids, sequence_id, offset``. Sequences are
    numbered from 0; those that share a content have neighbouring numbers.
    """
    pieces = token_pieces(docs, width, vocabulary, end_id, id_column, text_column)
    return place_pieces(store(pieces, "token-pieces"), width)
