import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from skylattice.llm import midstate as sha
from skylattice.llm.merkle import HASHED, build_manifest, fold_leaves, row_digest
from skylattice.llm.queries import QUERIES
from tests.llm.helpers import AWKWARD, CLASHING, DOCS, docs


def digest(*values):
    return hashlib.sha256("".join(values).encode()).hexdigest()


def leaf(row, text=None):
    values = [row[name] for name in HASHED]
    if text is not None:
        values[-1] = text
    parts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values]
    return digest(*parts)


def tree(leaves, arity):
    """All levels, from the leaves to the root."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([digest(*last[i : i + arity]) for i in range(0, len(last), arity)])
    return levels


def climb(levels, at, node, arity):
    """Root with the leaf at a place replaced, and the siblings on the way."""
    siblings = []
    for level in levels[:-1]:
        first = at - at % arity
        run = level[first : first + arity]
        siblings += run[: at - first] + run[at - first + 1 :]
        run[at - first] = node
        node, at = digest(*run), at // arity
    return node, siblings


def brute_force(rows, replaced, arity=3):
    """(doc_id, leaf, subroot, root, proof, folded) of each row."""
    by_source = {}
    for row in rows:
        by_source.setdefault(row["source"], []).append(row)
    trees = {}
    for source, own in by_source.items():
        own.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[source] = tree([leaf(r) for r in own], arity)
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    top = tree([trees[s][-1][0] for s in order], arity)
    out = []
    for place, source in enumerate(order):
        for at, row in enumerate(by_source[source]):
            node, low = climb(trees[source], at, replaced(row), arity)
            node, high = climb(top, place, node, arity)
            subroot = trees[source][-1][0]
            out.append((row["doc_id"], leaf(row), subroot, top[-1][0], digest(*low, *high), node))
    return out


def tampered(row):
    if row["doc_id"] is None or row["text"] is None:
        return leaf(row)
    if zlib.crc32(str(row["doc_id"]).encode()) % 2:
        return leaf(row)
    return leaf(row, row["text"].replace("\n", ""))


def folded(df, **options):
    changed = [F.replace("text", F.lit("\n"), F.lit("")) if n == "text" else F.col(n) for n in HASHED]
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    manifest = build_manifest(
        df, carry={"tampered": F.when(even, row_digest(changed))}, **options
    )
    rows = fold_leaves(manifest, F.col("tampered")).collect()
    return [
        (r["rank"], *(bytes(r[n]).hex() for n in ("digest", "subroot")), manifest.root,
         *(bytes(r[n]).hex() for n in ("proof", "folded")))
        for r in rows
    ]


def test_constants_and_digests():
    rng = random.Random(1)
    for blocks in range(5):
        parts = [[rng.randbytes(32) for _ in range(blocks)] for _ in range(7)]
        states = sha.started(7)
        for k in range(blocks):
            states = sha.absorb(states, sha.hex_block(sha.from_bytes(b"".join(p[k] for p in parts))))
        got = sha.to_bytes(sha.finish(states, blocks))
        assert [g.hex() for g in got] == [digest(*(x.hex() for x in p)) for p in parts]


def test_a_kept_state_is_resumed():
    left, right = (sha.from_bytes(hashlib.sha256(x).digest()) for x in (b"a", b"b"))
    kept = sha.from_bytes(sha.to_bytes(sha.absorb(sha.started(1), sha.hex_block(left)))[0])
    whole = sha.finish(sha.absorb(kept, sha.hex_block(right)), 2)
    names = [hashlib.sha256(x).hexdigest() for x in (b"a", b"b")]
    assert sha.to_bytes(whole)[0].hex() == digest(*names)


def random_rows(rng, n, sources):
    rows = []
    for i in range(n):
        source = rng.choice(sources)
        text = rng.choice([None, "", "a\nb\n", "ü" * rng.randint(0, 9), f"t{i}\n"])
        rows.append((rng.choice([i, i, None, 7]), text, rng.choice(["en", None]), source, i))
    return rows


@pytest.mark.parametrize("arity, levels", [(3, 1), (3, 2), (2, 2), (5, 1), (3, 6)])
def test_against_plain_trees(spark, arity, levels):
    rng = random.Random(arity * 10 + levels)
    sources = [None, "", "0", "a", "é", "￿", "😀", "lone"] + ["hot"] * 12
    rows = random_rows(rng, 130, sources)
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    got = folded(df, arity=arity, levels=levels)
    want = brute_force([r.asDict() for r in df.collect()], tampered, arity)
    assert Counter(got) == Counter(want)


def test_query(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = QUERIES["op13_midstate_manifest"](spark, "/root/testdata/sf0.001").collect()
    got = [tuple(r)[:6] for r in rows]
    assert Counter(got) == Counter(brute_force([r.asDict() for r in table.collect()], tampered))
    assert all(r.verified == (r.folded_root == r.root) for r in rows)
    assert {r.verified for r in rows} == {True, False}


def test_any_change_shows(spark):
    df = docs(spark, [(i, f"line {i}\n") for i in range(40)], clashing=False)
    manifest = build_manifest(df, levels=2)
    same = fold_leaves(manifest, F.lit(None).cast("binary")).collect()
    assert {bytes(r.folded).hex() for r in same} == {manifest.root}
    other = fold_leaves(manifest, F.unhex(F.sha2(F.lit("x"), 256))).collect()
    assert manifest.root not in {bytes(r.folded).hex() for r in other}
    assert len({bytes(r.folded) for r in other}) == 40


def test_one_key_is_spread_over_chunks(spark):
    df = docs(spark, [(i, "t") for i in range(300)], clashing=False)
    manifest = build_manifest(df, levels=2)
    lowest = manifest.passes[0].groupBy("chunk").count().collect()
    assert len(lowest) == 34 and max(r["count"] for r in lowest) <= 4
    assert len(manifest.passes) == 3


@pytest.mark.parametrize("rows", [[(1, "a")], [(1, "a", "en", "s"), (2, "b", "en", None)]])
def test_lone_leaves_and_keys(spark, rows):
    df = docs(spark, rows)
    want = brute_force([r.asDict() for r in df.collect()], tampered)
    assert Counter(folded(df)) == Counter(want)


def test_awkward_rows(spark):
    clashing = docs(spark, AWKWARD)
    for name in ("rank", "key", "digest", "tie", "position", "total", "part", "within", "tampered"):
        assert name not in CLASHING or name in clashing.columns
        clashing = clashing.withColumn(name, F.lit("x"))
    want = brute_force([r.asDict() for r in clashing.collect()], tampered)
    got = folded(clashing)
    assert Counter(got) == Counter(want) and len(got) == len(AWKWARD)
    nothing = docs(spark, [])
    assert folded(nothing) == [] and build_manifest(nothing).root is None


def test_long_runs_of_keys_in_one_batch(spark):
    rows = [(i, "t", "en", f"s{i % 97}") for i in range(1500)]
    df = docs(spark, rows, clashing=False, parts=2)
    want = brute_force([r.asDict() for r in df.collect()], tampered)
    assert Counter(folded(df)) == Counter(want)


def test_states_are_bytes_of_known_length(spark):
    manifest = build_manifest(docs(spark, [(i, "t") for i in range(10)], clashing=False))
    for r in manifest.passes[0].collect():
        assert len(r.children) == len(r.states) and len(r.digest) == 32
        words = sha.from_bytes(bytes(r.states))
        if len(words):
            assert np.array_equal(words[0], sha.START)
