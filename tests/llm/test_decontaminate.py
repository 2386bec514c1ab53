import random

import numpy as np
import pytest

from skylattice.llm import decontaminate as d
from skylattice.llm.common import Words
from skylattice.llm.queries import QUERIES
from tests.llm.helpers import AWKWARD, docs, words

SF_DIR = "/root/testdata/sf0.01"


def least_distance(item, text):
    """Edit distance of item to the best stretch of text, by the plain recurrence."""
    row = [0] * (len(text) + 1)
    for i, word in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, other in enumerate(text, 1):
            last, row[j] = row[j], min(last + (word != other), row[j] + 1, row[j - 1] + 1)
    return min(row)


def edited(rng, item, edits):
    out = item[:]
    for _ in range(edits):
        kind, at = rng.randrange(3), rng.randrange(len(out))
        if kind == 0:
            out[at] = f"new{rng.randrange(999)}"
        elif kind == 1:
            out.insert(at, f"new{rng.randrange(999)}")
        else:
            del out[at]
    return out


def benchmark(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("block_items", [2000, 7])
def test_recall_against_brute_force(spark, block_items):
    rng = random.Random(block_items)
    items = [words(rng, rng.randint(8, 70), 900) for _ in range(30)]
    texts = []
    for i in range(90):
        item = items[i % 30]
        edits = rng.randint(0, d.max_edits(len(item)))
        text = [*words(rng, rng.randint(0, 60), 900), *edited(rng, item, edits)]
        texts.append(text + words(rng, rng.randint(0, 60), 900))
    texts += [words(rng, 150, 900) for _ in range(20)]
    true = {
        (t, i): least
        for t, text in enumerate(texts)
        for i, item in enumerate(items)
        if (least := least_distance(item, text)) <= d.max_edits(len(item))
    }
    table = docs(spark, [(i, " ".join(t)) for i, t in enumerate(texts)])
    bench = benchmark(spark, [(i, " ".join(x)) for i, x in enumerate(items)])
    got = d.find_leaks(table, bench, block_items=block_items).collect()
    found = {(r.doc_id, r.item_id): r.edit_distance for r in got}
    assert len(found) == len(got)
    assert all(true[key] == distance for key, distance in found.items())
    assert len(found) >= 0.9 * len(true) and len(true) >= 85
    assert all(key in found for key, distance in true.items() if distance == 0)
    clean = {r.doc_id for r in d.drop_leaks(table, bench).select("doc_id").collect()}
    assert clean == set(range(len(texts))) - {doc for doc, _ in found}


def test_query_finds_every_passage_and_nothing_else(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()
    got = QUERIES["op1_cgk_decontamination"](spark, SF_DIR).collect()
    found = {(r.doc_id, r.item_id): r for r in got}
    verbatim = {(r.doc_id, i.item_id) for r in rows for i in items if i.text in r.text}
    assert verbatim and verbatim <= set(found)
    by_id, by_item = {r.doc_id: r.text for r in rows}, {i.item_id: i.text for i in items}
    for (doc_id, item_id), row in found.items():
        item, text = d.plain(by_item[item_id]).split(), d.plain(by_id[doc_id]).split()
        assert row.edit_distance <= d.max_edits(len(item))
        assert least_distance(item, text) == row.edit_distance
        assert least_distance(item, text[row.start_word : row.end_word]) == row.edit_distance


def test_awkward_rows(spark):
    table = docs(spark, [*AWKWARD, (40, "Say: A, b; C! and more"), (41, "a b d"), (42, "u x y")])
    bench = benchmark(spark, [(1, "a b c"), (2, None), (3, ""), (4, "..."), (None, "x y")])
    got = d.find_leaks(table, bench).collect()
    assert sorted(((r.doc_id, r.item_id) for r in got), key=str) == sorted(
        [(1, 1), (1, 1), (None, 1), (40, 1), (42, None)], key=str
    )
    assert d.find_leaks(docs(spark, []), bench).collect() == []
    assert d.find_leaks(table, benchmark(spark, [])).collect() == []
    assert d.drop_leaks(table, benchmark(spark, [])).count() == table.count()


def test_verification_agrees_with_the_recurrence():
    rng = random.Random(4)
    for _ in range(60):
        item, text = words(rng, rng.randint(1, 9), 5), words(rng, rng.randint(1, 30), 5)
        both = Words([" ".join(item).encode(), " ".join(text).encode()])
        low, high = both.first[1:2], both.first[2:3]
        got, begin, end = d.edit_distances(both.digest[: len(item)], both.digest, low, high)
        assert got[0] == least_distance(item, text)
        part = text[begin[0] - len(item) : end[0] - len(item)]
        assert least_distance(item, part) == got[0]
    assert np.all(got >= 0)


@pytest.mark.parametrize("length", [100, 150, 200, 300, 400])
def test_recall_at_the_bound_of_long_items(length):
    rng = random.Random(length)
    items = [words(rng, length, 5000) for _ in range(60)]
    index = d.Index(
        [(i, Words([" ".join(x).encode()]).digest) for i, x in enumerate(items)],
        d.EDIT_SHARE, d.REPETITIONS, d.SAMPLES,
    )
    texts = []
    for item in items:
        text = edited(rng, item, d.max_edits(length))
        texts.append(" ".join([*words(rng, 40, 5000), *text, *words(rng, 40, 5000)]).encode())
    found = d.matches(index, Words(texts))
    assert sum((i, i) in found for i in range(60)) >= 57
