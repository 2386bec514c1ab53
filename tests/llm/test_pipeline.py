"""The five stages: on the given tables against brute force, and on awkward ones."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from skylattice.llm.packing import VOCABULARY, encoding
from tests.llm.helpers import AWKWARD, docs, words
from tests.llm.test_packing import unpacked
from tests.llm.test_simhash import plain_classes, plain_print

SF_DIR = "/root/testdata/sf0.001"


def of(name):
    return dict(pipeline.STAGES)[name]


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def test_stages_in_order():
    assert [name for name, _ in pipeline.STAGES] == [
        "toxicity", "near_dedup", "decontamination", "mixing", "token_ids",
    ]


def test_near_dedup_against_brute_force(spark):
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rng = random.Random(4)
    base = words(rng, 400)
    copies = [(10_000 + i, " ".join([*base[:-1], f"end{i}"]), "en", "s", 1) for i in range(30)]
    table = table.unionByName(spark.createDataFrame(copies, table.schema))
    rows = table.collect()
    prints = {r.doc_id: plain_print(r.text) for r in rows}
    classes = plain_classes(prints, lambda a, b: (a ^ b).bit_count() <= 3)
    kept = of("near_dedup")(spark, table, SF_DIR)
    assert kept.columns == table.columns
    want = [r for r in rows if classes[r.doc_id] == r.doc_id]
    assert rows_of(kept) == Counter(map(tuple, want)) and len(want) < len(rows) - 20


def test_near_dedup_of_repeated_ids(spark):
    rng = random.Random(5)
    one, other = (" ".join(words(rng, 200)) for _ in range(2))
    rows = [(1, one), (1, one), (1, other), (2, one), (3, other), (None, one), (None, one)]
    kept = of("near_dedup")(spark, docs(spark, rows), SF_DIR)
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(1, one), (1, other), (None, one), (None, one)], key=str
    )


@pytest.mark.parametrize("rows", [[], AWKWARD], ids=["empty", "awkward"])
def test_stages_on_awkward_tables(spark, rows):
    """Every stage takes what the one before kept; other columns pass as they are."""
    table = docs(spark, rows).withColumn("_epoch", F.lit("x"))
    for name, stage in pipeline.STAGES:
        result = stage(spark, table, SF_DIR)
        if name == "token_ids":
            break
        assert result.columns == table.columns, name
        extra = [c for c in table.columns if c not in ("doc_id", "text", "lang", "source", "n_chars")]
        got = result.collect()
        assert all(r[c] == "x" for r in got for c in extra)
        known = {(r.doc_id, r.text) for r in table.collect()}
        assert {(r.doc_id, r.text) for r in got} <= known
        if name == "near_dedup" and rows:
            assert {r.doc_id for r in got if r.doc_id in (1, 2, 3, 4)} == {1, 2}
            assert sum(r.doc_id is None for r in got) == 2
        table = spark.createDataFrame(got, result.schema) if name != "mixing" else result
    ids = unpacked(result.collect())
    bpe = encoding(VOCABULARY)
    want = {}
    for r in table.collect():
        if r.text:
            want[r.doc_id] = want.get(r.doc_id, []) + bpe.encode_ordinary(r.text)
    assert {k: len(v) for k, v in ids.items()} == {k: len(v) for k, v in want.items()}


def test_run(spark):
    shards = pipeline.run(spark, SF_DIR).collect()
    ids = unpacked(shards)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    bpe = encoding(VOCABULARY)
    for doc_id, own in ids.items():
        whole = bpe.encode_ordinary(texts[doc_id])
        # A row that mixing took for several epochs comes as often.
        assert len(own) % len(whole) == 0
    assert 0 < len(ids) < len(texts)


def test_mixing_refuses_a_taken_name(spark):
    from skylattice.llm.mixing import mix_sources

    table = docs(spark, [(1, "a b")], clashing=False).withColumn("_epoch", F.lit("x"))
    with pytest.raises(ValueError):
        mix_sources(table, 1.0, ("lang",), total_is_share=True)
    mixed = mix_sources(table, 1.0, ("lang",), total_is_share=True, epoch_column="e")
    assert [tuple(r)[-2:] for r in mixed.collect()] == [("x", 0)]
