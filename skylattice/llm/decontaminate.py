"""Benchmark decontamination by the CGK embedding and bit-sampling LSH.

An item leaks into a document if some stretch of the document is within
``max_edits(item)`` word insertions, deletions and replacements of it. The CGK
embedding walks over a sequence of words: step j gives out the current word, and a
random bit that depends on j and the word tells whether to go on to the next word.
After an edit two walks soon run in step again, so a small edit distance becomes a
small Hamming distance, and sampling positions of the walk is a locality-sensitive
hash for it. Each of at least ``repetitions`` walks, more for longer items, samples ``samples`` positions; the walk
starts at every word of every document and runs over a window of the item's size.
Candidates are verified by the exact edit distance, with both ends of the stretch free.

Items are grouped by length, so that windows are item-sized. Before any walk, a window is
passed over if too few of its words occur in any item of the group, or if no run of q words
of an item occurs in it: k edits leave an item of m words a run of at least
(m - k) / (k + 1) words unedited, so this loses nothing.

The benchmark is read in blocks of at most ``block_items`` items and ``block_words``
words; each block is a pass over the documents with an index of bounded size. There is
no shuffle: a document's windows are hashed where it is read.

Measured recall of the defaults on passages edited at random up to the bound is in
``tests/llm/test_decontaminate.py`` (above 0.9 from 8 to 400 words; unedited passages are always found,
since equal windows walk alike).

Defined results: words are lower-cased and without ASCII punctuation; null texts have no
words, and items without words match nothing. Items of fewer than five words must occur
unchanged. A document matched by an item several times gives one row, with the smallest
distance, then the earliest end. Repeated rows give repeated rows. Other columns are not
looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from skylattice.llm.common import Words, mix, text_pieces

#: Edits allowed for each word of an item.
EDIT_SHARE = 0.2
REPETITIONS = 12
SAMPLES = 2
BLOCK_ITEMS = 2_000
BLOCK_WORDS = 200_000

_SEED = 7919
_PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_GROWTH = 1.35
_FILTER_BITS = 20


def plain(text: str | None) -> bytes:
    return (text or "").lower().encode().translate(None, _PUNCTUATION)


def repetitions_for(size: int, least: int) -> int:
    """Walks for windows of ``size`` words.

    At a fixed share of edits the chance that one walk is found falls with the length, from
    0.28 at 50 words to 0.10 at 400, about as the square root; the number of walks grows so.
    """
    return least if size <= 50 else math.ceil(1.6 * least * math.sqrt(size / 50))


def max_edits(words: int, share: float = EDIT_SHARE) -> int:
    return 0 if words < 5 else int(share * words)


# --- embedding --------------------------------------------------------------------


def walk(
    digest: np.ndarray,
    starts: np.ndarray,
    ends: np.ndarray,
    seed: np.uint64,
    positions: np.ndarray,
) -> np.ndarray:
    """Words at the sampled positions of the walks over ``digest[starts:ends]``.

    A word and the seed give 64 random bits, of which step j takes one. Beyond a window's
    end the walk gives out zero.
    """
    at = starts.copy()
    out = np.zeros((len(positions), len(starts)), dtype=np.uint64)
    row, last = 0, int(positions[-1])
    limit = len(digest) - 1
    for j in range(last + 1):
        inside = at < ends
        here = np.minimum(at, limit)
        while row < len(positions) and positions[row] == j:
            out[row] = np.where(inside, digest[here], np.uint64(0))
            row += 1
        if j < last:
            bits = mix(digest[here] ^ seed)
            at += ((bits >> np.uint64((j * 29) % 64)) & np.uint64(1)).astype(at.dtype)
    return out


@dataclass
class Walks:
    """Seeds and sampled positions of the repetitions for windows of ``size`` words."""

    seeds: np.ndarray
    positions: np.ndarray

    @classmethod
    def draw(cls, size: int, repetitions: int, samples: int) -> Walks:
        rng = np.random.default_rng([_SEED, size])
        reach = max(samples, int(1.6 * size))
        positions = np.stack(
            [np.sort(rng.choice(reach, samples, replace=False)) for _ in range(repetitions)]
        )
        return cls(rng.integers(1, 1 << 62, repetitions).astype(np.uint64), positions)

    def keys(self, number: int, digest: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        sampled = walk(digest, starts, ends, self.seeds[number], self.positions[number])
        key = np.zeros(len(starts), dtype=np.uint64)
        for row in sampled:
            key = mix(key * np.uint64(3) + row + np.uint64(number))
        return key


# --- items ------------------------------------------------------------------------


@dataclass
class Group:
    """Items of similar length and their index."""

    size: int
    longest: int
    numbers: np.ndarray
    vocabulary: np.ndarray
    run: int
    runs: np.ndarray
    walks: Walks
    keys: list[np.ndarray]
    owners: list[np.ndarray]

    def known(self, digest: np.ndarray) -> np.ndarray:
        """Whether each word may be a word of an item."""
        return self._filter("_words", self.vocabulary)[_place(digest)]

    def known_runs(self, digest: np.ndarray) -> np.ndarray:
        """Whether a run of an item may begin at each word."""
        out = np.zeros(len(digest), dtype=bool)
        if len(digest) >= self.run:
            found = self._filter("_runs", self.runs)[_place(run_digests(digest, self.run))]
            out[: len(found)] = found
        return out

    def _filter(self, name: str, values: np.ndarray) -> np.ndarray:
        if not hasattr(self, name):
            there = np.zeros(1 << _FILTER_BITS, dtype=bool)
            there[_place(values)] = True
            setattr(self, name, there)
        return getattr(self, name)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}


def _place(values: np.ndarray) -> np.ndarray:
    return values >> np.uint64(64 - _FILTER_BITS)


def run_digests(digest: np.ndarray, run: int) -> np.ndarray:
    """Digest of the run that begins at each word but the last ``run - 1``."""
    n = len(digest) - run + 1
    out = digest[:n].copy()
    for j in range(1, run):
        out = out * np.uint64(0xD6E8FEB86659FD93) + digest[j : j + n]
    return out


def unedited_run(words: int, share: float) -> int:
    edits = max_edits(words, share)
    return -(-(words - edits) // (edits + 1))


class Index:
    def __init__(
        self, items: list[tuple[int | None, np.ndarray]], share: float, repetitions: int, samples: int
    ):
        self.items, self.share = items, share
        lengths = np.array([len(words) for _, words in items], dtype=np.int64)
        self.groups: list[Group] = []
        size = 1
        while len(lengths) and size <= lengths.max():
            beyond = max(size + 1, int(size * _GROWTH))
            numbers = np.flatnonzero((lengths >= size) & (lengths < beyond))
            if len(numbers):
                own = [items[i][1] for i in numbers]
                least = int(min(len(x) for x in own))
                count = repetitions_for(least, repetitions)
                walks = Walks.draw(least, count, samples)
                digest = np.concatenate(own)
                first = np.concatenate([[0], np.cumsum([len(x) for x in own])])[:-1]
                keys, owners = [], []
                for r in range(count):
                    key = walks.keys(r, digest, first, first + least)
                    order = np.argsort(key, kind="stable")
                    keys.append(key[order])
                    owners.append(numbers[order])
                longest = int(max(len(x) for x in own))
                run = min(4, *(unedited_run(len(x), share) for x in own), least)
                runs = np.concatenate([run_digests(x, run) for x in own])
                self.groups.append(
                    Group(
                        least, longest, numbers, np.unique(digest), run, np.unique(runs),
                        walks, keys, owners,
                    )
                )
            size = beyond

    def candidates(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(window start, item number) pairs, each once."""
        found = []
        text_end = np.repeat(words.first[1:], np.diff(words.first))
        for group in self.groups:
            edits = max_edits(group.longest, self.share)
            runs = np.flatnonzero(group.known_runs(words.digest))
            if not len(runs):
                continue
            # Only starts that have a run not far ahead of them can be a window's.
            ahead = np.zeros(len(words) + 1, dtype=np.int32)
            np.add.at(ahead, np.maximum(runs - group.longest - edits, 0), 1)
            np.add.at(ahead, runs + 1, -1)
            starts = np.flatnonzero(np.cumsum(ahead)[:-1] > 0)
            total = np.zeros(len(words) + 1, dtype=np.int32)
            np.cumsum(group.known(words.digest), out=total[1:])
            ends = np.minimum(starts + group.size, text_end[starts])
            enough = total[ends] - total[starts] >= group.size - edits
            starts, ends = starts[enough], ends[enough]
            if not len(starts):
                continue
            for r in range(len(group.keys)):
                key = group.walks.keys(r, words.digest, starts, ends)
                low = np.searchsorted(group.keys[r], key, side="left")
                low_key = group.keys[r][np.minimum(low, len(group.keys[r]) - 1)]
                hit = np.flatnonzero(low_key == key)
                if len(hit):
                    high = np.searchsorted(group.keys[r], key[hit], side="right")
                    counts = high - low[hit]
                    which = np.repeat(low[hit], counts) + _ranges(counts)
                    found.append((np.repeat(starts[hit], counts), group.owners[r][which]))
        if not found:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        pairs = np.unique(
            np.stack([np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])]),
            axis=1,
        )
        return pairs[0], pairs[1]


def _ranges(counts: np.ndarray) -> np.ndarray:
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


# --- verification -----------------------------------------------------------------


def edit_distances(
    item: np.ndarray, digest: np.ndarray, low: np.ndarray, high: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Least edit distance of ``item`` to a stretch inside each range, and that stretch.

    Both ends of the stretch are free. Ties go to the earliest end; the start is that of
    one best alignment.
    """
    width = int((high - low).max())
    place = low[:, None] + np.arange(width)
    there = place < high[:, None]
    text = np.where(there, digest[np.minimum(place, len(digest) - 1)], np.uint64(0))
    n = len(low)
    # One number holds cost and start, so that the smaller cost, then start, wins.
    unit = width + 2
    steps = unit * np.arange(width + 1)
    state = np.broadcast_to(np.arange(width + 1), (n, width + 1)).copy()
    for i, word in enumerate(item):
        swapped = state[:, :-1] + unit * (text != word)
        dropped = state[:, 1:] + unit
        state[:, 0] = (i + 1) * unit
        np.minimum(swapped, dropped, out=state[:, 1:])
        # A word of the text too many: from any column to the left, one unit a step.
        state -= steps
        np.minimum.accumulate(state, axis=1, out=state)
        state += steps
    cost = state // unit
    cost[:, 1:][~there] = np.iinfo(np.int32).max
    end = cost.argmin(axis=1)
    rows = np.arange(n)
    return cost[rows, end], low + state[rows, end] % unit, low + end


def matches(index: Index, words: Words) -> dict[tuple[int, int], tuple[int, int, int]]:
    """(text, item number) → (distance, start, end) of the best verified match."""
    starts, numbers = index.candidates(words)
    texts = np.searchsorted(words.first, starts, side="right") - 1
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for number in np.unique(numbers):
        item = index.items[number][1]
        edits = max_edits(len(item), index.share)
        own = numbers == number
        at, of = starts[own], texts[own]
        low = np.maximum(at - edits, words.first[of])
        high = np.minimum(at + len(item) + 2 * edits, words.first[of + 1])
        for cut in range(0, len(at), 4096):
            part = slice(cut, cut + 4096)
            distance, begin, end = edit_distances(item, words.digest, low[part], high[part])
            for t, d, b, e in zip(
                of[part].tolist(), distance.tolist(), begin.tolist(), end.tolist(), strict=True
            ):
                if d <= edits:
                    key, origin = (t, int(number)), int(words.first[t])
                    value = (d, e - origin, b - origin)
                    best[key] = min(best.get(key, value), value)
    return {key: (d, b, e) for key, (d, e, b) in best.items()}


_RESULT = (
    "doc_id long, item_id long, edit_distance int, item_words int, start_word int, end_word int"
)


def _find(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_pieces(batches, limit=1 << 20):
            words = Words([plain(x) for x in batch.column("text").to_pylist()])
            found = matches(index, words) if len(words) else {}
            ids = batch.column("doc_id").to_pylist()
            rows = sorted(found.items())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([ids[t] for (t, _), _ in rows], pa.int64()),
                    pa.array([index.items[i][0] for (_, i), _ in rows], pa.int64()),
                    pa.array([v[0] for _, v in rows], pa.int32()),
                    pa.array([len(index.items[i][1]) for (_, i), _ in rows], pa.int32()),
                    pa.array([v[1] for _, v in rows], pa.int32()),
                    pa.array([v[2] for _, v in rows], pa.int32()),
                ],
                ["doc_id", "item_id", "edit_distance", "item_words", "start_word", "end_word"],
            )

    return run


def _blocks(
    benchmark: DataFrame, block_items: int, block_words: int
) -> Iterator[list[tuple[int | None, np.ndarray]]]:
    block, size = [], 0
    rows = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    for item_id, text in rows.toLocalIterator():
        digest = Words([plain(text)]).digest
        if not len(digest):
            continue
        if block and (len(block) >= block_items or size + len(digest) > block_words):
            yield block
            block, size = [], 0
        block.append((item_id, digest))
        size += len(digest)
    if block:
        yield block


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    share: float = EDIT_SHARE,
    repetitions: int = REPETITIONS,
    samples: int = SAMPLES,
    block_items: int = BLOCK_ITEMS,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per document and item that leaks into it, with the stretch in words."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    found = None
    for block in _blocks(benchmark, block_items, block_words):
        index = Index(block, share, repetitions, samples)
        part = rows.mapInArrow(_find(index), _RESULT)
        found = part if found is None else found.unionByName(part)
    return found if found is not None else rows.sparkSession.createDataFrame([], _RESULT)


def _keep_clean(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_pieces(batches, limit=1 << 20):
            words = Words([plain(x) for x in batch.column("text").to_pylist()])
            found = matches(index, words) if len(words) else {}
            clean = np.ones(batch.num_rows, dtype=bool)
            clean[np.array([t for t, _ in found], dtype=np.int64)] = False
            yield batch.filter(pa.array(clean))

    return run


def drop_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    share: float = EDIT_SHARE,
    repetitions: int = REPETITIONS,
    samples: int = SAMPLES,
    block_items: int = BLOCK_ITEMS,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Documents into which no item leaks, with all columns."""
    for block in _blocks(benchmark, block_items, block_words):
        index = Index(block, share, repetitions, samples)
        docs = docs.mapInArrow(_keep_clean(index), docs.schema)
    return docs
