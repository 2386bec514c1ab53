import random
import zlib

import numpy as np
import pytest

from skylattice.llm import toxicity as t
from skylattice.llm.queries import QUERIES
from tests.llm.helpers import AWKWARD, docs, words

SF_DIR = "/root/testdata/sf0.1"


def test_held_out_rows_are_told_apart(spark):
    got = {r.doc_id: r for r in QUERIES["op4_conv_toxicity"](spark, SF_DIR).collect()}
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()
    held = [r for r in labels if got[r.doc_id].held_out]
    assert 0.25 < len(held) / len(labels) < 0.42
    assert all(g.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, g in got.items())
    assert all(0 <= g.score <= 1 and g.predicted == (g.score >= 0.7) for g in got.values())
    true = np.array([r.toxic for r in held])
    predicted = np.array([got[r.doc_id].predicted for r in held])
    flagged = np.array([got[r.doc_id].flagged for r in held])
    scores = np.array([got[r.doc_id].score for r in held])
    wins = (scores[true == 1][:, None] > scores[true == 0]).mean()
    assert wins > 0.97
    for choice in (predicted, flagged):
        assert choice[true == 1].mean() > 0.85
        assert choice[true == 0].mean() < 0.02


def small_set(rng, n=600):
    bad = {"en": ["vile", "foul"], "de": ["mies"]}
    rows, labels = [], []
    for i in range(n):
        lang = "en" if i % 3 else "de"
        text, toxic = words(rng, rng.randint(5, 40), 80), int(rng.random() < 0.3)
        if toxic:
            text.insert(rng.randrange(len(text)), rng.choice(bad[lang]) + ".")
        rows.append((i, " ".join(text), lang, "src0"))
        labels.append((i, toxic))
    return rows, labels


def test_score_depends_on_the_text_alone(spark):
    rows, labels = small_set(random.Random(1))
    model = t.fit(docs(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    other = [(i + 5000, text, None, "elsewhere") for i, text, *_ in rows]
    one = {r.doc_id: r.score for r in t.score_toxicity(docs(spark, rows), model).collect()}
    two = {r.doc_id: r.score for r in t.score_toxicity(docs(spark, other), model).collect()}
    assert all(one[i] == pytest.approx(two[i + 5000], abs=1e-6) for i in one)
    truth = dict(labels)
    assert np.mean([(one[i] >= 0.5) == truth[i] for i in one]) > 0.95
    kept = t.drop_toxic(docs(spark, rows), model)
    assert kept.columns == docs(spark, rows).columns
    assert set(model.thresholds) <= {"en", "de"}


def test_awkward_rows_and_labels(spark):
    schema = "doc_id long, toxic int"
    table = docs(spark, AWKWARD)
    for labels in ([], [(1, 1), (5, 1)], [(1, None), (99, 0), (None, 1)]):
        model = t.fit(table, spark.createDataFrame(labels, schema))
        got = t.score_toxicity(table, model).collect()
        assert len(got) == len(AWKWARD)
        assert len({r.score for r in got}) == 1
    rows, labels = small_set(random.Random(2), 200)
    model = t.fit(docs(spark, rows), spark.createDataFrame(labels, schema))
    got = t.score_toxicity(table, model).collect()
    assert len(got) == len(AWKWARD)
    assert len({r.score for r in got if r.doc_id in (2, 3, 4)}) == 1
    assert [r.held_out for r in got if r.doc_id is None] == [None, None]
    assert t.score_toxicity(docs(spark, []), model).collect() == []


def test_pooling_stays_inside_texts():
    rng = np.random.default_rng(1)
    sizes = [0, 1, 2, 5, 0, 3, 1, 7]
    first = np.concatenate([[0], np.cumsum(sizes)])
    rows = rng.integers(0, 20, first[-1])
    for width in (1, 2, 3):
        table = rng.normal(size=(width, 20, 4)).astype(np.float32)
        got = t._pool(rows, first, table)
        for i, (a, b) in enumerate(zip(first[:-1], first[1:], strict=True)):
            if b - a < width:
                assert (got[i] < -1e8).all()
                continue
            want = np.max(
                [sum(table[j][rows[k + j]] for j in range(width)) for k in range(a, b - width + 1)],
                axis=0,
            )
            assert np.allclose(got[i], want, atol=1e-5)
