from pathlib import Path

import pytest

from skylattice.llm.licence_scan import scan_licences
from skylattice.llm.licences import TEXTS
from skylattice.llm.queries import ORACLE_SQL, QUERIES
from tests.compare import assert_same, connect
from tests.conftest import plan_of
from tests.llm.helpers import AWKWARD, docs

SF_DIR = "/root/testdata/sf0.01"


def test_query_against_sql(spark):
    name = "op7_licence_digests"
    assert_same(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLE_SQL[name])


def test_equivalent_forms_of_whole_texts(spark):
    mit = dict(TEXTS[:1])["MIT"]
    other = (
        "\t" + mit.upper().replace("MIT LICENSE", "The MIT Licence".upper()[4:])
        .replace(",", " ,").replace("\n", "\r\n  ")
    )
    lines = mit.split("\n", 1)
    held = f"{lines[0]}\n\nCopyright (c) 2020 Some One\n(c) 2021 Others\nAll rights reserved.\n"
    rows = [(1, mit), (2, other), (3, held + lines[1]), (4, mit + " no"), (5, mit[:-30])]
    got = {r.doc_id: r for r in scan_licences(docs(spark, rows)).collect()}
    assert [got[i].licence for i in range(1, 6)] == ["MIT", "MIT", "MIT", None, None]
    assert got[1].text_digest == got[2].text_digest == got[3].text_digest


def test_awkward_rows(spark):
    rows = [*AWKWARD, (50, "x\nReleased under the MIT License\nlicensed under CC0 1.0!\n"),
            (51, "Copyright 2020 X"), (52, "Licensed under CC BY 4.0")]
    got = scan_licences(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[50].notices == "CC0-1.0,MIT" and by[50].licence is None
    assert by[51].text_digest is None and by[2].text_digest is None and by[4].text_digest is None
    assert by[52].licence == by[52].notices == "CC-BY-4.0"
    assert scan_licences(docs(spark, [])).collect() == []


def test_no_python_and_no_shuffle_of_texts(spark):
    plan = plan_of(QUERIES["op7_licence_digests"](spark, SF_DIR))
    assert "Python" not in plan and "Arrow" not in plan and "Scan ExistingRDD" not in plan
    assert "SortMergeJoin" not in plan


LONG = {
    "Apache-2.0": "Apache-2.0", "CC0-1.0": "CC0-1.0", "GFDL-1.2": "GFDL-1.2",
    "GFDL-1.3": "GFDL-1.3", "GPL-1": "GPL-1.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0",
    "LGPL-2": "LGPL-2.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-1.1": "MPL-1.1",
    "MPL-2.0": "MPL-2.0", "Artistic": "Artistic-1.0",
}


def test_long_licences_as_whole_texts(spark):
    folder = Path("/usr/share/common-licenses")
    texts = [(folder / name).read_text() for name in LONG if (folder / name).is_file()]
    if len(texts) < len(LONG):
        pytest.skip("this system has not all the texts")
    rows = list(enumerate(texts))
    rows += [(100 + i, x.upper().replace("\n", "\r\n ")) for i, x in rows]
    end = "END OF TERMS AND CONDITIONS"
    cut = [(200 + i, x[: x.index(end)]) for i, x in rows[: len(texts)] if end in x]
    rows += cut + [(300 + i, x[:-40]) for i, x in rows[: len(texts)]]
    got = {r.doc_id: r.licence for r in scan_licences(docs(spark, rows)).collect()}
    names = list(LONG.values())
    assert len(cut) >= 6
    assert all(got[i] == (None if i >= 300 else names[i % 100]) for i in got)
