"""Merkle manifest of a dataset: a tree of SHA-256 digests that keeps midstates.

Each row is a leaf. The leaves of one key, in order, are hashed in runs of ``arity`` to
their parents, level by level, down to one root for each key; these roots, ordered by key,
give the root of the dataset in the same way. A parent hashes its children's digests in
hex, each of which is one block of the hash, so the state *before* each child can be kept: 32
bytes a child. To see what a changed row does, the parent's kept state before that child is
resumed with the new digest and the siblings to its right; nothing to the left is hashed
again, on any level.

In Spark: leaves are put in order by range partitions, and a leaf's position is its place in
its partition plus the rows of its key in the partitions before. ``LEVELS`` levels are
folded at a time, in chunks of ``arity ** LEVELS`` neighbouring nodes, so a key with any
number of rows is spread over many chunks and no task gathers a key. Parents (children,
kept states, digest) are stored, one row each. Going down again, each chunk gets its path to
the root; a leaf then needs its chunk and that path only. The driver reads the largest
number of leaves of a key, to know how often to fold, and the root.

Defined results: a null in a hashed column is ``-``; empty texts have length 0. A null key
is a key of its own and comes first, a null in ``order`` comes before all values. Rows that
share key and order are put in order of their digests; repeated rows are leaves each. A
key's only leaf is its root, a dataset's only key's root is the root. An empty table gives
no row. Columns that are not named are not looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from skylattice.llm import midstate as sha
from skylattice.llm.common import groups_of, shuffle_width, store, whole_groups

ARITY = 3
#: Levels that are folded between two shuffles.
LEVELS = 6

HASHED = ("doc_id", "source", "lang", "n_chars", "text")


@dataclass(frozen=True)
class Manifest:
    """``leaves`` in their places; ``passes`` and ``top`` hold parents, from below."""

    leaves: DataFrame
    passes: list[DataFrame]
    top: list[DataFrame]
    #: Key and place of each key's root.
    keys: DataFrame
    #: Root in hex; None if there are no rows.
    root: str | None
    arity: int
    levels: int


def row_digest(values: Sequence[Column]) -> Column:
    """Digest of a row: each value as its length in bytes, ``:`` and itself, or ``-``."""
    parts = []
    for value in values:
        text = value.cast("string")
        known = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
        parts.append(F.coalesce(known, F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def build_manifest(
    rows: DataFrame,
    key: str = "source",
    order: str = "doc_id",
    hashed: Sequence[str] = HASHED,
    carry: Mapping[str, Column] | None = None,
    arity: int = ARITY,
    levels: int = LEVELS,
) -> Manifest:
    """Hash all rows and store the tree; ``carry`` adds columns to ``leaves``."""
    if arity < 2 or arity > 255 or levels < 1:
        raise ValueError("arity must be between 2 and 255 and levels at least 1")
    source = F.col(f"`{key}`").cast("string")
    leaves = rows.select(
        # A key that is never null and sorts as wanted.
        F.coalesce(F.concat(F.lit("0"), source), F.lit("")).alias("key"),
        F.col(f"`{order}`").alias("rank"),
        row_digest([F.col(f"`{name}`") for name in hashed]).alias("digest"),
        *(column.alias(name) for name, column in (carry or {}).items()),
        F.monotonically_increasing_id().alias("tie"),
    )
    leaves = _placed(store(leaves, "merkle-leaves"), ("rank", "digest", "tie")).drop("tie")
    passes = _fold_up(leaves, arity, levels)
    roots = _tops(passes[-1], arity, levels).select(
        F.lit("").alias("key"), F.col("key").alias("member"), "digest"
    )
    keys = _placed(roots, ("member",))
    top = _fold_up(keys, arity, levels)
    root = _tops(top[-1], arity, levels).first()
    found = None if root is None else bytes(root.digest).hex()
    return Manifest(leaves, passes, top, keys, found, arity, levels)


def _placed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add ``position`` among the rows of a key, and ``total``, the number of them."""
    names = rows.columns

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, count = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column("key")
            same = pc.equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)
            starts = np.concatenate([[True], ~same])
            begin = np.flatnonzero(starts)
            within = np.arange(batch.num_rows) - np.repeat(
                begin, np.diff(np.concatenate([begin, [batch.num_rows]]))
            )
            if keys[0].as_py() == last:
                first = begin[1] if len(begin) > 1 else batch.num_rows
                within[:first] += count
            last, count = keys[-1].as_py(), int(within[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(name) for name in names),
                    pa.array(np.full(batch.num_rows, part, dtype=np.int32)),
                    pa.array(within.astype(np.int64)),
                ],
                names=[*names, "part", "within"],
            )

    schema = T.StructType([*rows.schema.fields]).add("part", "integer").add("within", "long")
    ordered = rows.repartitionByRange(shuffle_width(rows.sparkSession), "key", *order)
    numbered = store(
        ordered.sortWithinPartitions("key", *order).mapInArrow(number, schema), "merkle-places"
    )
    parts = numbered.groupBy("key", "part").agg(F.count(F.lit(1)).alias("n"))
    before = parts.selectExpr(
        "key",
        "part",
        "sum(n) over (partition by key order by part) - n as earlier",
        "sum(n) over (partition by key) as total",
    )
    placed = numbered.join(before, ["key", "part"])
    return placed.select(*names, F.expr("earlier + within as position"), "total")


# --- up: parents with the states before each child ---------------------------

_PARENT_SQL = (
    "key string, chunk long, total long, level int, place long, children binary, "
    "states binary, digest binary"
)
_PARENT = pa.schema(
    [
        ("key", pa.string()),
        ("chunk", pa.int64()),
        ("total", pa.int64()),
        ("level", pa.int32()),
        ("place", pa.int64()),
        ("children", pa.binary()),
        ("states", pa.binary()),
        ("digest", pa.binary()),
    ]
)


def _fold_up(nodes: DataFrame, arity: int, levels: int) -> list[DataFrame]:
    """Stored parents of each pass; the last has one chunk for each key."""
    size = arity**levels
    largest = nodes.agg(F.max("total")).first()[0] or 0
    passes = []
    while True:
        parents = nodes.select("key", "position", "total", "digest").withColumns(
            {"chunk": F.expr(f"position div {size}"), "place": F.expr(f"position % {size}")}
        )
        parents = _by_chunk(parents, "place").mapInArrow(
            lambda batches: _parents(batches, arity, levels), _PARENT_SQL
        )
        passes.append(store(parents, "merkle-parents"))
        if largest <= size:
            return passes
        largest = -(-largest // size)
        nodes = _tops(passes[-1], arity, levels)


def _by_chunk(rows: DataFrame, *order: str) -> DataFrame:
    """Whole chunks in one partition, next to each other and in order."""
    unit = rows.withColumn("unit", F.xxhash64("key", "chunk"))
    width = shuffle_width(rows.sparkSession)
    return unit.repartition(width, "unit").sortWithinPartitions("unit", "key", "chunk", *order)


def _tops(parents: DataFrame, arity: int, levels: int) -> DataFrame:
    """The node that is left of each chunk, as a node of the next pass."""
    size = arity**levels
    height = f"least({levels}, {_height_sql('total', arity)})"
    return parents.filter(f"level = {height}").select(
        "key",
        F.col("chunk").alias("position"),
        F.expr(f"(total + {size - 1}) div {size}").alias("total"),
        "digest",
    )


def _height(total: int, arity: int) -> int:
    """Levels from so many nodes to one."""
    levels = 0
    while total > 1:
        total, levels = -(-total // arity), levels + 1
    return levels


def _height_sql(total: str, arity: int) -> str:
    powers, power = [], 1
    while power < 1 << 62:
        powers.append(f"{power}L")
        power *= arity
    return f"size(filter(array({', '.join(powers)}), p -> p < {total}))"


def _chunk_starts(table: pa.Table) -> np.ndarray:
    """Row at which each chunk begins."""
    keys, chunks = table.column("key").combine_chunks(), table.column("chunk").to_numpy()
    change = pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)
    change = change | (chunks[1:] != chunks[:-1])
    return np.flatnonzero(np.concatenate([[True], change]))


def _words(column: pa.ChunkedArray) -> np.ndarray:
    """Digests as rows of eight words."""
    return sha.from_bytes(b"".join(column.to_pylist()))


def _parents(
    batches: Iterator[pa.RecordBatch], arity: int, levels: int
) -> Iterator[pa.RecordBatch]:
    for table in whole_groups(batches, "unit"):
        starts = _chunk_starts(table)
        counts = np.diff(np.concatenate([starts, [table.num_rows]]))
        keys = table.column("key").take(pa.array(starts)).to_pylist()
        chunks = table.column("chunk").to_numpy()[starts]
        totals = table.column("total").to_numpy()[starts]
        heights = np.array([min(levels, _height(int(t), arity)) for t in totals])
        chunk = np.repeat(np.arange(len(starts)), counts)
        place = np.arange(table.num_rows) - np.repeat(starts, counts)
        digest = _words(table.column("digest"))

        def batch(level, at, children, states, digest, owner):
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([keys[c] for c in owner], pa.string()),
                    pa.array(chunks[owner]),
                    pa.array(totals[owner]),
                    pa.array(np.full(len(owner), level, dtype=np.int32)),
                    pa.array(at.astype(np.int64)),
                    pa.array(children, pa.binary()),
                    pa.array(states, pa.binary()),
                    pa.array(sha.to_bytes(digest), pa.binary()),
                ],
                schema=_PARENT,
            )

        alone = heights[chunk] == 0
        if alone.any():
            n = int(alone.sum())
            yield batch(0, place[alone], [b""] * n, [b""] * n, digest[alone], chunk[alone])
        for level in range(1, levels + 1):
            going = heights[chunk] >= level
            chunk, place, digest = chunk[going], place[going], digest[going]
            if not len(chunk):
                break
            first, runs = groups_of(chunk * (arity**levels) + place // arity)
            state, kept = sha.started(len(first)), []
            for slot in range(int(runs.max())):
                kept.append(state)
                has = np.flatnonzero(runs > slot)
                state = state.copy()
                state[has] = sha.absorb(state[has], sha.hex_block(digest[first[has] + slot]))
            children = _joined(sha.to_bytes(digest), runs)
            states = np.stack(kept, axis=1)
            flat = states.reshape(-1, 8)[
                (np.arange(len(kept))[None, :] < runs[:, None]).reshape(-1)
            ]
            chunk, place = chunk[first], place[first] // arity
            digest = sha.finish(state, runs)
            yield batch(level, place, children, _joined(sha.to_bytes(flat), runs), digest, chunk)


def _joined(values: list[bytes], runs: np.ndarray) -> list[bytes]:
    ends = np.cumsum(runs).tolist()
    return [b"".join(values[e - n : e]) for e, n in zip(ends, runs.tolist(), strict=True)]


# --- down: paths, and leaves folded along them --------------------------------

_MIXED = {
    "unit": "long",
    "kind": "int",
    "key": "string",
    "chunk": "long",
    "level": "int",
    "place": "long",
    "children": "binary",
    "states": "binary",
    "path": "binary",
    "subroot": "binary",
    "digest": "binary",
    "replacement": "binary",
}
_PATH, _NODE, _LEAF = 0, 1, 2


class _Steps:
    """For some nodes: the kept state before each, its siblings, and how many are left of it."""

    def __init__(self, state, siblings, left, right):
        self.state, self.siblings, self.left, self.right = state, siblings, left, right

    def records(self) -> np.ndarray:
        """One row of bytes for each node."""
        n = len(self.left)
        words = np.concatenate([self.state, self.siblings.reshape(n, -1)], axis=1)
        raw = words.astype(">u4").view(np.uint8).reshape(n, -1)
        counts = np.stack([self.left, self.right], axis=1).astype(np.uint8)
        return np.concatenate([raw, counts], axis=1)

    @classmethod
    def from_records(cls, raw: np.ndarray) -> _Steps:
        words = np.ascontiguousarray(raw[:, :-2]).view(">u4").astype(np.uint32)
        state, siblings = words[:, :8], words[:, 8:].reshape(len(raw), -1, 8)
        return cls(state, siblings, raw[:, -2].astype(np.int64), raw[:, -1].astype(np.int64))


class _Chunks:
    """Paths and parents of the chunks in a sorted table."""

    def __init__(self, table: pa.Table, arity: int):
        self.arity = arity
        self.starts = _chunk_starts(table)
        chunk = np.repeat(
            np.arange(len(self.starts)),
            np.diff(np.concatenate([self.starts, [table.num_rows]])),
        )
        kind = table.column("kind").to_numpy()
        paths = table.filter(pa.array(kind == _PATH))
        self.paths = paths.column("path").to_pylist()
        self.subroots = paths.column("subroot").to_pylist()
        nodes = kind == _NODE
        level = pc.fill_null(table.column("level"), 0).to_numpy()[nodes]
        owner, rows = chunk[nodes], table.filter(pa.array(nodes))
        children, states = (rows.column(n).to_pylist() for n in ("children", "states"))
        self.height = np.zeros(len(self.starts), dtype=np.int64)
        np.maximum.at(self.height, owner, level)
        self.levels = {}
        for number in range(1, int(self.height.max(initial=0)) + 1):
            at = np.flatnonzero(level == number)
            runs = np.array([len(children[i]) // sha.STATE_BYTES for i in at])
            first = np.searchsorted(owner[at], np.arange(len(self.starts)))
            self.levels[number] = (
                first, runs, self._padded(children, at), self._padded(states, at),
            )
        leaves = kind == _LEAF
        self.leaf_chunk, self.leaves = chunk[leaves], table.filter(pa.array(leaves))

    def _padded(self, values: list[bytes], at: np.ndarray) -> np.ndarray:
        width = self.arity * sha.STATE_BYTES
        raw = b"".join([values[i].ljust(width, b"\0") for i in at])
        return sha.from_bytes(raw).reshape(-1, self.arity, 8)

    def steps(self, level: int, chunk: np.ndarray, place: np.ndarray) -> _Steps:
        """Steps of the nodes above such leaves, from ``level - 1`` to ``level``."""
        first, runs, children, states = self.levels[level]
        below = place // self.arity ** (level - 1)
        row, slot = first[chunk] + below // self.arity, below % self.arity
        others = np.arange(self.arity - 1)[None, :]
        others = others + (others >= slot[:, None])
        return _Steps(
            states[row, slot], children[row[:, None], others], slot, runs[row] - 1 - slot
        )


def _mixed(parents: DataFrame, paths: DataFrame, leaves: DataFrame | None = None) -> DataFrame:
    """Paths, parents and leaves of the same chunks, next to each other."""
    types = dict(_MIXED)
    if leaves is not None:
        types["rank"] = leaves.schema["rank"].dataType.simpleString()

    def as_kind(kind: int, rows: DataFrame) -> DataFrame:
        names = {name: "null" for name in types} | {name: name for name in rows.columns}
        names |= {"kind": str(kind), "unit": "xxhash64(key, chunk)"}
        return rows.selectExpr(*(f"cast({names[n]} as {t}) as {n}" for n, t in types.items()))

    nodes = parents.select("key", "chunk", "level", "place", "children", "states")
    rows = as_kind(_PATH, paths).unionByName(as_kind(_NODE, nodes))
    if leaves is not None:
        rows = rows.unionByName(as_kind(_LEAF, leaves))
    return _by_chunk(rows, "kind", "level", "place")


def _fold_down(passes: list[DataFrame], paths: DataFrame, arity: int, levels: int) -> DataFrame:
    """Paths of the chunks of the first pass, from those of the last one's."""
    for parents in reversed(passes[1:]):
        nodes = _node_paths(parents, paths, arity, levels)
        below = nodes.select("key", F.col("position").alias("chunk"), "path", "subroot")
        paths = store(below, "merkle-paths")
    return paths


_NODE_PATH_SQL = "key string, position long, path binary, subroot binary"


def _node_paths(parents: DataFrame, paths: DataFrame, arity: int, levels: int) -> DataFrame:
    """Path to the root of each node at the bottom of a pass."""
    size = arity**levels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "unit"):
            chunks = _Chunks(table, arity)
            owner, place = [], []
            for c, height in enumerate(chunks.height):
                n = 1
                if height:
                    first, runs, *_ = chunks.levels[1]
                    last = first[c + 1] if c + 1 < len(first) else len(runs)
                    n = int(runs[first[c] : last].sum())
                owner.append(np.full(n, c))
                place.append(np.arange(n))
            owner, place = np.concatenate(owner), np.concatenate(place)
            out = [b""] * len(owner)
            for level in chunks.levels:
                going = np.flatnonzero(chunks.height[owner] >= level)
                records = chunks.steps(level, owner[going], place[going]).records()
                for i, record in zip(going.tolist(), records, strict=True):
                    out[i] += record.tobytes()
            keys = table.column("key").take(pa.array(chunks.starts)).to_pylist()
            numbers = table.column("chunk").to_numpy()[chunks.starts]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([keys[c] for c in owner], pa.string()),
                    pa.array(numbers[owner] * size + place),
                    pa.array(
                        [p + chunks.paths[c] for p, c in zip(out, owner, strict=True)], pa.binary()
                    ),
                    pa.array([chunks.subroots[c] for c in owner], pa.binary()),
                ],
                names=["key", "position", "path", "subroot"],
            )

    return _mixed(parents, paths).mapInArrow(run, _NODE_PATH_SQL)


def _chunk_paths(manifest: Manifest) -> DataFrame:
    """Path to the root of each chunk of leaves, with the root of its key."""
    arity, levels = manifest.arity, manifest.levels
    spark = manifest.leaves.sparkSession
    start = spark.range(1).selectExpr(
        "'' as key", "0L as chunk", "cast('' as binary) as path", "cast('' as binary) as subroot"
    )
    above = _fold_down(manifest.top, start, arity, levels)
    roots = _node_paths(manifest.top[0], above, arity, levels).select("position", "path")
    keys = manifest.keys.select("position", F.col("member").alias("key"), "digest")
    of_keys = keys.join(roots, "position").select(
        "key", F.lit(0).cast("long").alias("chunk"), "path", F.col("digest").alias("subroot")
    )
    return _fold_down(manifest.passes, store(of_keys, "merkle-paths"), arity, levels)


def fold_leaves(manifest: Manifest, replacement: Column) -> DataFrame:
    """The root that each leaf alone gives when its digest is replaced.

    ``replacement`` is an expression over ``manifest.leaves``; null stands for the leaf as it
    is. Columns: ``rank`` (the order column), ``digest``, ``subroot``, ``proof`` (digest of
    the siblings on the way up, left to right, level by level) and ``folded``, all binary.
    """
    arity, levels = manifest.arity, manifest.levels
    size = arity**levels
    leaves = manifest.leaves.select(
        "key",
        F.expr(f"position div {size}").alias("chunk"),
        F.expr(f"position % {size}").alias("place"),
        "rank",
        "digest",
        F.coalesce(replacement, F.col("digest")).alias("replacement"),
    )
    kind = leaves.schema["rank"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "unit"):
            chunks = _Chunks(table, arity)
            if not len(chunks.leaf_chunk):
                continue
            fold = _Fold(_words(chunks.leaves.column("replacement")), arity)
            chunk = chunks.leaf_chunk
            place = chunks.leaves.column("place").to_numpy().astype(np.int64)
            for level in chunks.levels:
                going = np.flatnonzero(chunks.height[chunk] >= level)
                fold.climb(going, chunks.steps(level, chunk[going], place[going]))
            width = (8 + (arity - 1) * 8) * 4 + 2
            lengths = np.array([len(p) // width for p in chunks.paths])
            raw = [np.frombuffer(p, dtype=np.uint8).reshape(-1, width) for p in chunks.paths]
            for step in range(int(lengths.max())):
                records = np.stack([r[min(step, len(r) - 1)] if len(r) else _none(width) for r in raw])
                going = np.flatnonzero(lengths[chunk] > step)
                fold.climb(going, _Steps.from_records(records[chunk[going]]))
            yield pa.RecordBatch.from_arrays(
                [
                    chunks.leaves.column("rank").combine_chunks(),
                    chunks.leaves.column("digest").combine_chunks(),
                    pa.array([chunks.subroots[c] for c in chunk], pa.binary()),
                    pa.array(sha.to_bytes(sha.finish(fold.proof, fold.blocks)), pa.binary()),
                    pa.array(sha.to_bytes(fold.digest), pa.binary()),
                ],
                names=["rank", "digest", "subroot", "proof", "folded"],
            )

    schema = T.StructType().add("rank", kind)
    for name in ("digest", "subroot", "proof", "folded"):
        schema.add(name, "binary")
    mixed = _mixed(manifest.passes[0], _chunk_paths(manifest), leaves)
    return mixed.mapInArrow(run, schema)


def _none(width: int) -> np.ndarray:
    return np.zeros(width, dtype=np.uint8)


class _Fold:
    """Digests on their way up, and the hash of the siblings they met."""

    def __init__(self, digest: np.ndarray, arity: int):
        self.digest, self.arity = digest, arity
        self.proof = sha.started(len(digest))
        self.blocks = np.zeros(len(digest), dtype=np.int64)

    def climb(self, going: np.ndarray, steps: _Steps) -> None:
        met = steps.left + steps.right
        state = sha.absorb(steps.state, sha.hex_block(self.digest[going]))
        for k in range(self.arity - 1):
            has = np.flatnonzero(met > k)
            if not len(has):
                break
            block = sha.hex_block(steps.siblings[has, k])
            self.proof[going[has]] = sha.absorb(self.proof[going[has]], block)
            # Siblings to the left are in the kept state already.
            right = np.flatnonzero(steps.left[has] <= k)
            state[has[right]] = sha.absorb(state[has[right]], block[:, right])
        self.blocks[going] += met
        self.digest = self.digest.copy()
        self.digest[going] = sha.finish(state, met + 1)
