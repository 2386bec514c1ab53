import hashlib
import random
import re

import pytest

from skylattice.llm.queries import QUERIES
from skylattice.llm.substring_dedup import _dealt, remove_repeats
from tests.llm.helpers import AWKWARD, docs, words

SF_DIR = "/root/testdata/sf0.01"


def expected(rows, width=50):
    first, split = {}, []
    for doc_id, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        split.append((doc_id, w))
        rank = (doc_id is None, doc_id or 0)
        for i in range(len(w) - width + 1):
            key = " ".join(w[i : i + width])
            first[key] = min(first.get(key, rank), rank)
    out = []
    for doc_id, w in split:
        gone, rank = [False] * len(w), (doc_id is None, doc_id or 0)
        for i in range(len(w) - width + 1):
            if first[" ".join(w[i : i + width])] < rank:
                gone[i : i + width] = [True] * width
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        sha = hashlib.sha256(kept.encode()).hexdigest()
        out.append((doc_id, len(w), sum(gone), sha))
    return sorted(out, key=str)


def test_query_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op2_anchor_substring_dedup"](spark, SF_DIR).collect()
    assert sorted(map(tuple, got), key=str) == expected(rows)
    assert sum(r.n_removed for r in got) > 0


@pytest.mark.parametrize("width", [1, 2, 7, 50])
def test_planted_passages_at_any_offset(spark, width):
    rng = random.Random(width)
    passages = [words(rng, rng.randint(width, 4 * width), 300) for _ in range(6)]
    rows = []
    for i in range(80):
        text = words(rng, rng.randint(0, 150), 300)
        for passage in rng.sample(passages, 2):
            cut = rng.randint(0, len(passage) // 3)
            text += passage[cut:] + words(rng, rng.randint(0, 9), 300)
        rows.append((rng.randint(0, 60), " ".join(text)))
    rows += AWKWARD
    got = remove_repeats(docs(spark, rows), window=width, unit_bytes=4000).collect()
    assert sorted(map(tuple, got), key=str) == expected(rows, width)


def test_kept_text_and_empty_table(spark):
    passage = " ".join(words(random.Random(1), 60))
    got = remove_repeats(docs(spark, [(2, f"x {passage} y"), (1, passage)]), with_text=True)
    assert {r.doc_id: r.kept_text for r in got.collect()} == {1: passage, 2: "x y"}
    assert remove_repeats(docs(spark, [])).collect() == []


@pytest.mark.parametrize("hot", [None, 5])
def test_rows_of_one_id_are_spread_over_units(spark, hot):
    rng = random.Random(3)
    passage = words(rng, 30, 200)
    rows = [
        (hot if i % 3 else i, " ".join(words(rng, i % 40, 200) + passage * (i % 2) + words(rng, 9, 200)))
        for i in range(150)
    ]
    table = docs(spark, rows).select("doc_id", "text")
    sizes = [r["count"] for r in _dealt(table, 10).groupBy("unit").count().collect()]
    assert len(sizes) == 10 and max(sizes) < 40
    got = remove_repeats(docs(spark, rows), window=20, unit_bytes=500, bucket_bytes=300).collect()
    assert sorted(map(tuple, got), key=str) == expected(rows, 20)
    assert sum(r.n_removed for r in got) > 0
