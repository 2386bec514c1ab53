import random

import pytest

from skylattice.llm.line_dedup import _within_one, repeated_lines
from skylattice.llm.queries import QUERIES
from tests.llm.helpers import AWKWARD, docs, words

SF_DIR = "/root/testdata/sf0.001"


def within_one(a, b):
    """Plain recurrence for word edit distance of at most 1."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(last + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1] <= 1


def expected(rows, least_words):
    """Kept lines, comparing each distinct line with each other of about its length."""
    first, lines = {}, []
    for n, (doc_id, text) in enumerate(rows):
        for number, line in enumerate((text or "").split("\n")):
            key = tuple(line.encode().split())
            if key:
                place = (doc_id is None, doc_id or 0, n, number)
                lines.append((doc_id, number, key, place))
                first[key] = min(first.get(key, place), place)
    by_length = {}
    for key in first:
        by_length.setdefault(len(key), []).append(key)
    leaders = set()
    for key, place in first.items():
        near = [] if len(key) < least_words else [
            other
            for n in (len(key) - 1, len(key), len(key) + 1)
            if n >= least_words
            for other in by_length.get(n, [])
            if first[other] < place and other is not key
        ]
        if not any(_within_one(list(key), list(other)) for other in near):
            leaders.add(key)
    return sorted(
        ((d, n, key in leaders and first[key] == place) for d, n, key, place in lines), key=str
    )


def test_within_one():
    rng = random.Random(1)
    for _ in range(3000):
        a, b = words(rng, rng.randint(0, 5), 2), words(rng, rng.randint(0, 5), 2)
        assert _within_one(a, b) == within_one(a, b)


@pytest.mark.parametrize("least_words", [2, 8])
def test_against_brute_force(spark, least_words):
    rng = random.Random(least_words)
    pool = [words(rng, rng.randint(1, 14), 6 if i % 2 else 400) for i in range(60)]
    rows = []
    for doc_id in range(70):
        lines = []
        for _ in range(rng.randint(0, 6)):
            line = rng.choice(pool)[:]
            at = rng.randrange(len(line))
            kind = rng.randrange(5)
            if kind == 0:
                line[at] = f"v{rng.randrange(4)}"
            elif kind == 1:
                line.insert(at, f"v{rng.randrange(4)}")
            elif kind == 2 and len(line) > 1:
                del line[at]
            lines.append("  ".join(line))
        rows.append((doc_id, "\n".join(lines)))
    got = repeated_lines(docs(spark, rows), least_words).collect()
    assert sorted(map(tuple, got), key=str) == expected(rows, least_words)


def test_query_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op3_deletion_line_dedup"](spark, SF_DIR).collect()
    assert sorted(map(tuple, got), key=str) == expected(
        sorted((r.doc_id, r.text) for r in rows), 8
    )


def test_awkward_rows(spark):
    got = repeated_lines(docs(spark, AWKWARD)).collect()
    kept = [(r.doc_id, r.line) for r in got if r.kept]
    assert sorted(kept) == [(1, 0), (5, 0), (6, 0), (7, 0)]
    assert len(got) == 6
    assert repeated_lines(docs(spark, [])).collect() == []
