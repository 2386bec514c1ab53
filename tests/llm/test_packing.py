import random

import numpy as np
import pytest

from skylattice.llm.packing import (
    VOCABULARY,
    Capacities,
    Tokenizer,
    best_fit,
    encoding,
    pack_tokens,
)
from skylattice.llm.queries import QUERIES
from tests.llm.helpers import AWKWARD, docs

SF_DIR = "/root/testdata/sf0.001"


def unpacked(rows):
    """Each document's ids, put together again from all shards."""
    pieces = {}
    for r in rows:
        matrix = np.frombuffer(bytes(r.ids), dtype=f"<u{r.id_bytes}").reshape(r.n_rows, r.width)
        assert len(r.doc_ids) == len(r.cumulative_lengths) == r.n_rows
        for line, owners, numbers, ends, resets in zip(
            matrix, r.doc_ids, r.pieces, r.cumulative_lengths, r.position_resets, strict=True
        ):
            assert resets == ends[:-1] and ends[0] == 0 and ends[-1] <= r.width
            for k, (owner, number) in enumerate(zip(owners, numbers, strict=True)):
                pieces.setdefault(owner, []).append((number, line[ends[k] : ends[k + 1]].tolist()))
            assert len(set(line[ends[-1] :].tolist())) <= 1
    return {
        owner: sum((ids for _, ids in sorted(own)), []) for owner, own in pieces.items()
    }


def test_query_round_trip(spark):
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    got = unpacked(QUERIES["op9_packed_token_ids"](spark, SF_DIR).collect())
    bpe = encoding(VOCABULARY)
    for r in table:
        if r.text:
            assert got[r.doc_id] == bpe.encode_ordinary(r.text)
            assert bpe.decode(got[r.doc_id]) == r.text
    assert set(got) == {r.doc_id for r in table if r.text}


@pytest.mark.parametrize("width", [1, 2, 7, 64])
def test_narrow_rows_lose_nothing(spark, width):
    rows = [(i, f"text {'word ' * i} end!") for i in range(40)]
    got = pack_tokens(docs(spark, rows), width=width, group_tokens=500).collect()
    bpe = encoding(VOCABULARY)
    assert unpacked(got) == {i: bpe.encode_ordinary(t) for i, t in rows}


def test_tokens_do_not_depend_on_stretches():
    rng = random.Random(1)
    parts = [" ", "  ", "\n", "\n\n", "\t", " \n", "a", "Wort", "é", "'s", "12", ".", " ",
             "\x1c", "\x85", "<|endoftext|>", "日本"]
    tokenizer = Tokenizer(VOCABULARY)
    for _ in range(2000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 14)))
        assert tokenizer.encode(text).tolist() == tokenizer.encoding.encode_ordinary(text)


def plain_best_fit(sizes, width):
    rooms, rows = [], []
    for piece in sorted(range(len(sizes)), key=lambda p: -sizes[p]):
        fits = [r for r in range(len(rows)) if rooms[r] >= sizes[piece]]
        if fits:
            row = min(fits, key=lambda r: rooms[r])
        else:
            row = len(rows)
            rows.append([])
            rooms.append(width)
        rows[row].append(piece)
        rooms[row] -= sizes[piece]
    return rows, rooms


@pytest.mark.parametrize("width", [1, 5, 16, 100, 2048])
def test_best_fit_against_plain_search(width):
    rng = np.random.default_rng(width)
    for _ in range(20):
        sizes = rng.integers(1, width + 1, rng.integers(0, 200))
        rows = best_fit(sizes, width)
        assert sorted(p for r in rows for p in r) == list(range(len(sizes)))
        plain, rooms = plain_best_fit(sizes.tolist(), width)
        assert sorted(width - sizes[r].sum() for r in rows) == sorted(rooms)
        assert len(rows) == len(plain)


def test_capacity_search():
    tree = Capacities(10)
    assert tree.take(1) is None
    tree.add(4, 1)
    tree.add(10, 2)
    assert tree.take(5) == (10, 2) and tree.take(5) is None and tree.take(4) == (4, 1)


def test_awkward_rows(spark):
    got = unpacked(pack_tokens(docs(spark, [r for r in AWKWARD if r[0] not in (1, None)])).collect())
    bpe = encoding(VOCABULARY)
    assert got == {i: bpe.encode_ordinary(t) for i, t in AWKWARD if i not in (1, None) and t}
    repeated = pack_tokens(docs(spark, AWKWARD)).collect()
    owners = [o for r in repeated for line in r.doc_ids for o in line]
    assert owners.count(1) == 2 and owners.count(None) == 1
    assert pack_tokens(docs(spark, [])).collect() == []
