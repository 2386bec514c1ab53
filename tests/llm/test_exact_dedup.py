import hashlib
import re
from collections import defaultdict

import pytest

from skylattice.llm.exact_dedup import ContentTable, exact_groups
from skylattice.llm.queries import ORACLE_SQL, QUERIES
from tests.compare import assert_same, connect
from tests.llm.helpers import AWKWARD, docs

SF_DIR = "/root/testdata/sf0.01"


def expected(rows):
    """The rule, row by row: (doc_id, keep_id, size, sha256) and kept rows per content."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((doc_id, text or ""))
    out = []
    for content, own in groups.items():
        keep = min(own, key=lambda r: (-len(r[1]), r[0] is None, r[0] or 0))[0]
        sha = hashlib.sha256(content.encode()).hexdigest()
        out += [(doc_id, keep, len(own), sha) for doc_id, _ in own]
    return out


@pytest.mark.parametrize("table_bytes", [64 << 20, 1000])
def test_rule_on_awkward_rows(spark, table_bytes):
    rows = AWKWARD + [(20, "ab c"), (19, "a bc "), (21, "A B C"), (22, "x" * 200_000)]
    got = exact_groups(docs(spark, rows), table_bytes=table_bytes).collect()
    plain = [(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got]
    assert sorted(plain, key=str) == sorted(expected(rows), key=str)
    kept = [r.text_sha256 for r in got if r.kept]
    assert len(kept) == len(set(kept)) == len({r.text_sha256 for r in got})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_spill_levels_give_the_same(spark):
    rows = [(i, f"text number {i % 150} " * 20) for i in range(400)]
    whole = exact_groups(docs(spark, rows))
    spilled = exact_groups(docs(spark, rows), table_bytes=3000)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, spilled.collect()))


def test_empty_table(spark):
    assert exact_groups(docs(spark, [])).collect() == []


def test_table_compares_contents_not_digests():
    table = ContentTable(1 << 20)
    same = b"\0" * 32
    assert table.put(same, b"one", 1) == 1
    assert table.put(same, b"two", 2) == 2
    assert table.put(same, b"one", 3) == 1
    assert all(table.put(bytes([i]) * 32, b"%d" % i, i) == i for i in range(1, 200))


def test_query_against_sql(spark):
    name = "op6_grace_exact_dedup"
    assert_same(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLE_SQL[name])
