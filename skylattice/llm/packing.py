"""Token ids packed into matrices of fixed width, best fit decreasing.

Documents are tokenised by a public byte-level BPE vocabulary whose path is a parameter.
A document of more than ``width`` tokens is cut into pieces of ``width`` tokens and a
rest, so nothing is lost and the pieces, in order, give the document back. Each task packs
the pieces of its partition: longest first, each into the open row with the least room
that still takes it. Rows are found in a segment tree over capacities (a leaf for each
amount of room, holding the rows that have it), in time logarithmic in ``width``.

A task gathers about ``group_tokens`` tokens before it packs, so memory is bounded
whatever the size of a partition; packing groups differ only in how full their last rows
are. There is no shuffle.

Each output row is a shard: a matrix of ``n_rows`` x ``width`` ids (little-endian, two
bytes if the vocabulary fits, else four), padded by ``pad_id``, and for each matrix row
the cumulative segment lengths (beginning with 0), the places where positions start again
at 0, and for each segment its document and the number of its piece in the document.
Padding is a segment of no document: it begins where the cumulative lengths end.

Defined results: null and empty texts have no tokens and get no segment. Repeated rows are
packed once each. An empty table gives no shard. Other columns are not looked at. Strings
that look like special tokens are ordinary text.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from skylattice.llm.common import text_pieces

WIDTH = 2_048
#: Tokens gathered before they are packed.
GROUP_TOKENS = 4 << 20
#: Matrix rows in one shard.
SHARD_ROWS = 256
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

# Fixed value: the pattern by which the public vocabulary splits text.
_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

@lru_cache(maxsize=2)
def encoding(path: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("bpe", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})


class Tokenizer:
    """Encodes whole texts to ids of the least type that holds the vocabulary."""

    def __init__(self, path: str):
        self.encoding = encoding(path)
        self.dtype = np.dtype("<u2" if self.encoding.max_token_value < 65_535 else "<u4")

    def encode(self, text: str) -> np.ndarray:
        return self.encoding.encode_to_numpy(text, disallowed_special=()).astype(self.dtype)


class Capacities:
    """Open rows by room left; the row with the least sufficient room is found in a tree."""

    def __init__(self, width: int):
        self.leaves = 1 << width.bit_length()
        self.there = bytearray(2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(width + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        at = room + self.leaves
        while at and not self.there[at]:
            self.there[at] = 1
            at >>= 1

    def take(self, size: int) -> tuple[int, int] | None:
        """(room, row) of a row with the least room of at least ``size``, removed."""
        at, there = size + self.leaves, self.there
        while not there[at]:
            # Up while this is a right child or the sibling is empty, then to the sibling.
            while at & 1 or not there[at + 1]:
                at >>= 1
                if at <= 1:
                    return None
            at += 1
            while at < self.leaves:
                at = 2 * at if there[2 * at] else 2 * at + 1
        room = at - self.leaves
        row = self.rows[room].pop()
        if not self.rows[room]:
            there[at] = 0
            at >>= 1
            while at and not (there[2 * at] or there[2 * at + 1]):
                there[at] = 0
                at >>= 1
        return room, row


def best_fit(sizes: np.ndarray, width: int) -> list[list[int]]:
    """Rows as lists of pieces, longest first; every size is between 1 and ``width``."""
    rows: list[list[int]] = []
    open_ = Capacities(width)
    for piece in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[piece])
        found = open_.take(size)
        if found is None:
            room, row = width, len(rows)
            rows.append([])
        else:
            room, row = found
        rows[row].append(piece)
        if room > size:
            open_.add(room - size, row)
    return rows


_SHARD = (
    "doc_ids array<array<long>>, pieces array<array<int>>, n_rows int, width int, "
    "id_bytes int, ids binary, cumulative_lengths array<array<int>>, "
    "position_resets array<array<int>>"
)
_ARROW = pa.schema(
    [
        ("doc_ids", pa.list_(pa.list_(pa.int64()))),
        ("pieces", pa.list_(pa.list_(pa.int32()))),
        ("n_rows", pa.int32()),
        ("width", pa.int32()),
        ("id_bytes", pa.int32()),
        ("ids", pa.binary()),
        ("cumulative_lengths", pa.list_(pa.list_(pa.int32()))),
        ("position_resets", pa.list_(pa.list_(pa.int32()))),
    ]
)


class _Group:
    def __init__(self):
        self.parts: list[np.ndarray] = []
        self.owners: list[tuple[int | None, int]] = []
        self.tokens = 0

    def add(self, doc_id: int | None, ids: np.ndarray, width: int) -> None:
        for number, at in enumerate(range(0, len(ids), width)):
            self.parts.append(ids[at : at + width])
            self.owners.append((doc_id, number))
        self.tokens += len(ids)

    def shards(self, width: int, pad_id: int, dtype: np.dtype) -> Iterator[pa.RecordBatch]:
        sizes = np.array([len(p) for p in self.parts], dtype=np.int64)
        rows = best_fit(sizes, width)
        for at in range(0, len(rows), SHARD_ROWS):
            part = rows[at : at + SHARD_ROWS]
            matrix = np.full((len(part), width), pad_id, dtype=dtype)
            lengths = []
            for line, pieces in zip(matrix, part, strict=True):
                joined = np.concatenate([self.parts[p] for p in pieces])
                line[: len(joined)] = joined
                lengths.append([0, *np.cumsum(sizes[pieces]).tolist()])
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_ids": [[[self.owners[p][0] for p in pieces] for pieces in part]],
                    "pieces": [[[self.owners[p][1] for p in pieces] for pieces in part]],
                    "n_rows": [len(part)],
                    "width": [width],
                    "id_bytes": [dtype.itemsize],
                    "ids": [matrix.tobytes()],
                    "cumulative_lengths": [lengths],
                    "position_resets": [[x[:-1] for x in lengths]],
                },
                schema=_ARROW,
            )


def pack_tokens(
    docs: DataFrame,
    width: int = WIDTH,
    vocabulary: str = VOCABULARY,
    pad_id: int | None = None,
    group_tokens: int = GROUP_TOKENS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Shards of packed ids; ``pad_id`` is by default the first id after the vocabulary."""
    if width < 1:
        raise ValueError("a row takes at least one token")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer(vocabulary)
        pad = tokenizer.encoding.max_token_value + 1 if pad_id is None else pad_id
        group = _Group()
        for batch in text_pieces(batches):
            for doc_id, text in zip(
                batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True
            ):
                if text:
                    group.add(doc_id, tokenizer.encode(text), width)
                if group.tokens >= group_tokens:
                    yield from group.shards(width, pad, tokenizer.dtype)
                    group = _Group()
        yield from group.shards(width, pad, tokenizer.dtype)

    rows = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"),
        F.col(f"`{text_column}`").cast("string").alias("text"),
    )
    return rows.mapInArrow(run, _SHARD)
