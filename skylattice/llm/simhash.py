"""Near-duplicate classes by SimHash fingerprints and Golay-code fuzzy hashing.

A fingerprint is cut into segments of at most 23 bits. The perfect binary Golay code of
length 23 gives every segment its nearest codeword (at most 3 bits away) and, when that
one is 3 bits away, the five codewords at 4 bits. If x and y differ in one bit, the
nearest codeword of x is among the six of y; if they differ in two or three it often is.

For a pair (s, t) of segments a fingerprint gives the keys (nearest codeword of s, any of
t) and (any of s, nearest of t), 24 bits each; ``every`` adds (any of s, any of t). Keys
that share the codeword of s travel in one row with the fingerprint, so the shuffle holds
a fingerprint once for each of them; the task that gets the row unfolds its keys and sorts
them. Candidates are verified by the number of differing bits, and each key's group passes
on the edges of a spanning forest of its links instead of all pairs. Only distinct
fingerprints take part; copies of a text are folded into one beforehand.

``THREE_BITS``: 64 bits, at most 3 of which differ, segments of 22, 21 and 21 bits. Three
errors over three segments leave two with at most one each, so with all three pairs no
link is lost.

``SIMILAR``, which no query uses: 256 bits over the set of distinct five-word shingles, for a Jaccard similarity
of 0.8 or more of these sets, where about 15 % of the bits differ. Nodes are distinct sets.
Pairs of eleven segments, with every key, give candidates of at most 64 differing bits; they
are found with a high probability instead of surely (``tests/llm/test_simhash.py`` has the
recall at 0.8 against brute force). Links are exact: the sets of each component of the
candidates meet and are compared all with all, and only a similarity of 0.8 or more, by
64-bit hashes of the shingles, is a link. A component of over ``BLOCK_SHINGLES`` shingles is
cut into blocks, and each pair of blocks is a unit of its own, so a unit's memory is bounded;
what is shuffled grows with the number of blocks of a component.

Defined results: null texts are empty; a text without words has fingerprint zero and
links like any other. ``component_id`` is the smallest non-null ``doc_id`` of the
component. Repeated rows give repeated rows. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from skylattice.llm.common import (
    encoded,
    groups_of,
    mix,
    shuffle_width,
    store,
    text_pieces,
    whole_groups,
)
from skylattice.llm.components import components


@dataclass(frozen=True)
class Scheme:
    """How texts become fingerprints, keys and links."""

    shingle_words: int
    words: int
    max_bits: int
    segments: tuple[tuple[int, int], ...]
    pairs: tuple[tuple[int, int], ...]
    every: bool = False
    #: Least Jaccard similarity of the sets of shingles; links are verified by it.
    similarity: float | None = None


THREE_BITS = Scheme(
    shingle_words=3,
    words=1,
    max_bits=3,
    segments=((0, 22), (22, 21), (43, 21)),
    pairs=((0, 1), (0, 2), (1, 2)),
)
SIMILAR = Scheme(
    shingle_words=5,
    words=4,
    max_bits=64,
    segments=tuple((23 * i, 23) for i in range(11)),
    pairs=tuple((i, (i + 1) % 11) for i in range(11)),
    every=True,
    similarity=0.8,
)

# x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1 generates the code.
_GENERATOR = 0b110001110101
_HASH_SEED = 42
#: Shingles whose bits are counted at a time.
_BIT_ROWS = 1 << 13
#: Shingles of the sets that one block of a component holds.
BLOCK_SHINGLES = 1 << 20


# --- fingerprints -----------------------------------------------------------------


def shingles(text: bytes, span: int) -> Iterator[np.ndarray]:
    """XXH64 of the runs of ``span`` words, in parts; a shorter text is one run."""
    words = text.lower().split()  # bytes: A-Z only, and ASCII white space
    if not words:
        return
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    span = min(span, len(words))
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - span + 1].tolist()
    ends = ends[span - 1 :].tolist()
    of = xxhash.xxh64_intdigest
    for at in range(0, len(starts), _BIT_ROWS):
        part = slice(at, at + _BIT_ROWS)
        yield np.array(
            [of(joined[a:b], _HASH_SEED) for a, b in zip(starts[part], ends[part], strict=True)],
            dtype="<u8",
        )


def shingle_set(text: bytes, scheme: Scheme) -> np.ndarray:
    """Distinct hashes of the shingles, ascending."""
    parts = list(shingles(text, scheme.shingle_words))
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, dtype="<u8")


def _majority(parts: Iterator[np.ndarray], words: int) -> np.ndarray:
    ones, count = np.zeros(64 * words, dtype=np.int64), 0
    for hashes in parts:
        rows = [hashes]
        for number in range(1, words):
            rows.append(mix(hashes + np.uint64(number)))
        bits = np.unpackbits(np.stack(rows, axis=1).view(np.uint8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
        count += len(hashes)
    return np.packbits(2 * ones > count, bitorder="little").view("<u8")


def _set_print(of: np.ndarray, scheme: Scheme) -> np.ndarray:
    parts = (of[at : at + _BIT_ROWS] for at in range(0, len(of), _BIT_ROWS))
    return _majority(parts, scheme.words)


def fingerprint(text: bytes, scheme: Scheme = THREE_BITS) -> np.ndarray:
    """Bit k is 1 if it is set in over half of the shingles' hashes; 64-bit words.

    The first word is of the shingles' XXH64, the others of its further mixing. Repeated
    shingles count once if the scheme is about sets.
    """
    if scheme.similarity is not None:
        return _set_print(shingle_set(text, scheme), scheme)
    return _majority(shingles(text, scheme.shingle_words), scheme.words)


def _content(of: np.ndarray) -> int:
    """Digest of a set."""
    return xxhash.xxh64_intdigest(of.tobytes(), _HASH_SEED) - (1 << 63)


def fingerprints(
    docs: DataFrame, scheme: Scheme = THREE_BITS, kept: tuple[str, ...] = ()
) -> DataFrame:
    """doc_id and the fingerprint, 8 little-endian bytes for each word.

    If the scheme is about sets, also the set's digest and size. ``kept`` names columns of
    longs that are passed on.
    """
    sets = scheme.similarity is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_pieces(batches):
            texts = encoded(batch.column("text"))
            names = ["doc_id", *kept, "fp"]
            columns = [batch.column(name) for name in names[:-1]]
            if sets:
                prints, contents, sizes = [], [], []
                for text in texts:
                    of = shingle_set(text, scheme)
                    prints.append(_set_print(of, scheme).tobytes())
                    contents.append(_content(of))
                    sizes.append(len(of))
                columns += [pa.array(prints, pa.binary()), pa.array(contents, pa.int64())]
                columns.append(pa.array(sizes, pa.int32()))
                names += ["content", "size"]
            else:
                prints = [fingerprint(x, scheme).tobytes() for x in texts]
                columns.append(pa.array(prints, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *kept)
    passed = "".join(f"{name} long, " for name in kept)
    return rows.mapInArrow(
        run, f"doc_id long, {passed}fp binary" + (", content long, size int" if sets else "")
    )


def _matrix(column: pa.Array | pa.ChunkedArray, words: int) -> np.ndarray:
    """Fingerprints of a column as rows of unsigned 64-bit words."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<u8").reshape(-1, words)


def _segment(prints: np.ndarray, at: int, n: int) -> np.ndarray:
    word, shift = divmod(at, 64)
    out = prints[:, word] >> np.uint64(shift)
    if shift + n > 64:
        out = out | (prints[:, word + 1] << np.uint64(64 - shift))
    return (out & np.uint64((1 << n) - 1)).astype(np.int64)


# --- Golay keys -------------------------------------------------------------------


def _remainder(word: int) -> int:
    for bit in range(22, 10, -1):
        if word >> bit & 1:
            word ^= _GENERATOR << (bit - 11)
    return word


class Golay:
    """Nearby codewords of 23-bit words, as the 12 message bits of a codeword.

    ``near[s]`` has, for the syndrome s, what to add to a word's upper 12 bits to
    get the codewords: first the nearest, then the five at 4 bits if the nearest is
    3 bits away (-1 otherwise). Everything follows from the generator.
    """

    def __init__(self):
        self.upper = np.array([_remainder(x << 11) for x in range(1 << 12)], dtype=np.int64)
        errors = np.zeros(1 << 11, dtype=np.int64)
        for a in range(23):
            for b in range(a, 23):
                for c in range(b, 23):
                    pattern = (1 << a) | (1 << b) | (1 << c)
                    errors[_remainder(pattern)] = pattern
        codewords = (np.arange(1 << 12) << 11) ^ self.upper
        light = codewords[np.bitwise_count(codewords) == 7]
        self.near = np.full((1 << 11, 6), -1, dtype=np.int64)
        for syndrome, error in enumerate(errors):
            self.near[syndrome, 0] = error >> 11
            if int(error).bit_count() == 3:
                around = light[light & error == error]
                self.near[syndrome, 1:] = (error ^ around) >> 11

    def keys(self, words: np.ndarray) -> np.ndarray:
        """Six columns of codeword indices, -1 where there is none."""
        near = self.near[self.upper[words >> 11] ^ (words & 0x7FF)]
        return np.where(near >= 0, near ^ (words >> 11)[:, None], -1)


_GOLAY: list[Golay] = []


def golay() -> Golay:
    if not _GOLAY:
        _GOLAY.append(Golay())
    return _GOLAY[0]


def fuzzy_keys(
    prints: np.ndarray, scheme: Scheme, spread: int = 1
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(index of the fingerprint, pair and first codeword, second codewords), in parts.

    The second codewords are six columns, -1 where there is none; each of them makes a key
    with the first. With ``spread`` they come in so many rows, by remainder.
    """
    segments = [golay().keys(_segment(prints, at, n)) for at, n in scheme.segments]
    for number, (s, t) in enumerate(scheme.pairs):
        first, second = segments[s], segments[t]
        for column in range(6):
            others = second
            if column and not scheme.every:
                others = np.where(np.arange(6) == 0, second, -1)
            for remainder in range(spread):
                of = np.where(others % spread == remainder, others, -1)
                there = np.flatnonzero((first[:, column] >= 0) & (of >= 0).any(axis=1))
                yield there, (number << 12) | first[there, column], of[there]


def _emit_keys(scheme: Scheme, spread: int):
    """Rows (dealt, second, node, fp): all keys of a fingerprint that one task will sort."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4_000):
                part = batch.slice(at, 4_000)
                prints = _matrix(part.column("fp"), scheme.words)
                for owners, first, second in fuzzy_keys(prints, scheme, spread):
                    there = second >= 0
                    ends = np.concatenate([[0], np.cumsum(there.sum(axis=1))])
                    of = pa.array(owners)
                    # All codewords of a row leave the same remainder.
                    dealt = first * spread + second.max(axis=1) % spread
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(dealt),
                            pa.ListArray.from_arrays(
                                pa.array(ends.astype(np.int32)),
                                pa.array(second[there].astype(np.int16)),
                            ),
                            part.column("node").take(of),
                            part.column("fp").take(of),
                        ],
                        ["dealt", "second", "node", "fp"],
                    )

    return run


# --- links ------------------------------------------------------------------------


def _differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


def _forest(prints: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges, as row numbers, of a spanning forest of the links among ``prints``."""
    a, b = [], []
    rest = np.arange(len(prints))
    while len(rest):
        frontier, rest = [rest[0]], rest[1:]
        while frontier and len(rest):
            x = frontier.pop()
            linked = _differing(prints[rest], prints[x]) <= max_bits
            if linked.any():
                reached = rest[linked]
                rest = rest[~linked]
                a.append(np.full(len(reached), x))
                b.append(reached)
                frontier.extend(reached.tolist())
    if not a:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(a), np.concatenate(b)


def _emit_links(scheme: Scheme, small: int = 4):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "key"):
            prints = _matrix(table.column("fp"), scheme.words)
            nodes = table.column("node").to_numpy()
            begins, sizes = groups_of(table.column("key").to_numpy())
            a, b = [], []
            few = begins[(sizes > 1) & (sizes <= small)]
            counts = sizes[(sizes > 1) & (sizes <= small)]
            for i in range(small):
                for j in range(i + 1, small):
                    at = few[counts > j]
                    near = _differing(prints[at + i], prints[at + j]) <= scheme.max_bits
                    a.append(at[near] + i)
                    b.append(at[near] + j)
            for begin, size in zip(begins[sizes > small], sizes[sizes > small], strict=True):
                x, y = _forest(prints[begin : begin + size], scheme.max_bits)
                a.append(x + begin)
                b.append(y + begin)
            pairs = np.stack([nodes[np.concatenate(a)], nodes[np.concatenate(b)]])
            pairs = np.unique(np.sort(pairs[:, pairs[0] != pairs[1]], axis=0), axis=1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"]
            )

    return run


def links(nodes: DataFrame, scheme: Scheme = THREE_BITS) -> DataFrame:
    """Pairs (a, b) of nodes (node, fp) whose components are those of all links found."""
    width = shuffle_width(nodes.sparkSession)
    # Four values to deal by for each task, so that no task gets many more than another.
    spread = -(-4 * width // (len(scheme.pairs) << 12))
    packed = nodes.select("node", "fp").mapInArrow(
        _emit_keys(scheme, spread),
        "dealt long, second array<smallint>, node long, fp binary",
    )
    dealt = (
        packed.repartition(width, "dealt")
        .select("dealt", F.explode("second").alias("second"), "node", "fp")
        .selectExpr(f"cast((dealt div {spread}) * 4096 + second as int) as key", "node", "fp")
        .sortWithinPartitions("key")
    )
    return dealt.mapInArrow(_emit_links(scheme), "a long, b long").distinct()


# --- verification of sets -----------------------------------------------------------


def _sets(scheme: Scheme):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_pieces(batches):
            sets = [shingle_set(x, scheme) for x in encoded(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([_content(x) for x in sets], pa.int64()),
                    pa.array([x.tobytes() for x in sets], pa.binary()),
                ],
                ["doc_id", "digest", "shingles"],
            )

    return run


def _similar(sets: list[np.ndarray], least: float) -> tuple[np.ndarray, np.ndarray]:
    """Edges, as places in ``sets``, of a spanning forest of the pairs at ``least`` or more."""
    sizes = np.array([len(x) for x in sets], dtype=np.int64)
    values, flat = np.unique(np.concatenate(sets), return_inverse=True)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    marked = np.zeros(len(values), dtype=bool)
    a, b = [], []
    rest = np.arange(len(sets))
    while len(rest):
        frontier, rest = [rest[0]], rest[1:]
        while frontier and len(rest):
            x = frontier.pop()
            own = flat[bounds[x] : bounds[x + 1]]
            marked[own] = True
            common = np.concatenate([[0], np.cumsum(marked[flat])])
            common = common[bounds[rest + 1]] - common[bounds[rest]]
            marked[own] = False
            # Decimal bounds like 0.8 are met exactly: 4 of 5 is enough.
            linked = common >= least * (sizes[rest] + sizes[x] - common) - 1e-9
            if linked.any():
                reached = rest[linked]
                rest = rest[~linked]
                a.append(np.full(len(reached), x))
                b.append(reached)
                frontier.extend(reached.tolist())
    if not a:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(a), np.concatenate(b)


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by unit and node without repeated ones."""
    last = None
    for batch in batches:
        if batch.num_rows:
            rows = np.stack([batch.column(x).to_numpy() for x in ("unit", "node")], axis=1)
            new = np.ones(len(rows), dtype=bool)
            new[1:] = (rows[1:] != rows[:-1]).any(axis=1)
            new[0] = last is None or (rows[0] != last).any()
            last = rows[-1].copy()
            yield batch.filter(pa.array(new))


def _emit_similar(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(_once(batches), "unit"):
            nodes = table.column("node").to_numpy()
            column = table.column("shingles")
            begins, sizes = groups_of(table.column("unit").to_numpy())
            for begin, size in zip(begins.tolist(), sizes.tolist(), strict=True):
                if size > 1:
                    own = column.slice(begin, size)
                    sets = [np.frombuffer(x.as_buffer(), dtype="<u8") for x in own]
                    a, b = _similar(sets, least)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(nodes[a + begin]), pa.array(nodes[b + begin])], ["a", "b"]
                    )

    return run


def similar_links(
    docs: DataFrame, nodes: DataFrame, candidates: DataFrame, scheme: Scheme
) -> DataFrame:
    """Pairs (a, b) whose components are those of all similar pairs in ``candidates``.

    ``candidates`` has (node, root) of the components to look into.
    """
    members = candidates.select(F.col("node").alias("own"), "root").join(
        nodes, F.col("own") == F.col("node")
    ).select("node", "root", "content", "least", "size")
    blocks = members.groupBy(F.col("root").alias("of")).agg(
        F.ceil((F.sum("size") + 1) / BLOCK_SHINGLES).alias("blocks")
    )
    placed = store(
        members.join(blocks, F.col("root") == F.col("of")).select(
            "node", "root", "content", "least", "blocks",
            F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block"),
        ),
        "members",
    )
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    sets = rows.mapInArrow(_sets(scheme), "doc_id long, digest long, shingles binary").join(
        placed,
        (F.col("digest") == F.col("content")) & F.col("doc_id").eqNullSafe(F.col("least")),
    )
    # A block meets every block of its component, itself among them.
    paired = sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    units = paired.select(
        F.xxhash64(
            "root", F.least("block", "other"), F.greatest("block", "other")
        ).alias("unit"),
        "node",
        "shingles",
    )
    dealt = units.repartition(shuffle_width(docs.sparkSession), "unit")
    return (
        dealt.sortWithinPartitions("unit", "node")
        .mapInArrow(_emit_similar(scheme.similarity), "a long, b long")
        .distinct()
    )


# --- classes ------------------------------------------------------------------------


def near_duplicate_classes(docs: DataFrame, scheme: Scheme = THREE_BITS) -> DataFrame:
    """One row per document: doc_id, fingerprint in hex, component_id."""
    printed = store(fingerprints(docs, scheme), "fingerprints")
    classes = _classes(docs, printed, scheme)
    # The most significant byte is shown first.
    digits = [F.substring(F.hex("fp"), at, 2) for at in range(16 * scheme.words - 1, 0, -2)]
    return classes.select(
        "doc_id", F.lower(F.concat(*digits)).alias("fingerprint"), "component_id"
    )


def _classes(docs: DataFrame, printed: DataFrame, scheme: Scheme) -> DataFrame:
    """Stored fingerprints with ``component_id`` and ``class``, which is never null."""
    # Distinct fingerprints or sets are the nodes; they are few bytes, and numbered once.
    same = ["fp"] if scheme.similarity is None else ["fp", "content", "size"]
    nodes = store(
        printed.groupBy(*same)
        .agg(F.min("doc_id").alias("least"))
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    stars = components(links(nodes, scheme))
    if scheme.similarity is not None:
        stars = components(similar_links(docs, nodes, stars, scheme))
    rooted = nodes.withColumnRenamed("node", "own").join(
        stars, F.col("own") == F.col("node"), "left"
    ).select(*same, "least", F.coalesce("root", "own").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.join(least, "root").select(
        *same, "component_id", F.col("root").alias("class")
    )
    return printed.join(classes, same)


def drop_near_duplicates(docs: DataFrame, scheme: Scheme = THREE_BITS) -> DataFrame:
    """Of each class the row with the smallest ``doc_id``, with all columns.

    Rows that share that ``doc_id`` are told apart by a digest of all their columns, of
    which the smallest stays; rows that agree in every column are one. Rows without a
    ``doc_id`` stay, all of them. Other columns may have any names.
    """
    # The caller's columns travel in one, so that no name of theirs is met.
    rows = docs.select(
        F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.xxhash64(*(F.col(f"`{name}`") for name in docs.columns)).alias("digest"),
    )
    named = rows.filter(F.col("doc_id").isNotNull())
    printed = store(fingerprints(named, scheme, ("digest",)), "fingerprints")
    classes = _classes(named, printed, scheme)
    stay = classes.groupBy("class").agg(
        F.expr("min(named_struct('id', doc_id, 'digest', digest)) as kept")
    )
    stay = stay.selectExpr("kept.id as doc_id", "kept.digest as digest")
    kept = named.join(stay, ["doc_id", "digest"])
    first = "row_number() over (partition by doc_id, digest order by digest)"
    kept = kept.withColumn("copy", F.expr(first)).filter("copy = 1")
    nameless = rows.filter(F.col("doc_id").isNull())
    return kept.select("row").unionByName(nameless.select("row")).select("row.*")
