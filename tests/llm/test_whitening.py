import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from skylattice.llm.queries import QUERIES
from skylattice.llm.whitening import (
    exact_covariance,
    exact_products,
    fit_whitening,
    refined_eigen,
    whiten,
    whitened_components,
)

SF_DIR = "/root/testdata/sf0.001"
VECTORS = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
    ]
)


def grid(vectors):
    return [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors]


def plain(vectors):
    """n, deviations, covariance and centred rows, in Python's whole numbers and float64."""
    x, n = grid(vectors), len(vectors)
    sums = [sum(column) for column in zip(*x, strict=True)]
    deviations = [sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    centred = np.array([[(n * a - s) / n for a, s in zip(r, sums, strict=True)] for r in x])
    return n, deviations, centred.T @ centred / n, centred


def test_query(spark):
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    df = QUERIES["op11_refined_whitening"](spark, SF_DIR)
    assert [f"{n} {t}" for n, t in df.dtypes] == [
        "vec_id bigint", "component int", "n bigint", "deviation bigint", "whitened double",
        "explained double", "identity_error double",
    ]
    rows = df.collect()
    n, deviations, covariance, centred = plain([r.embedding for r in table])
    values, basis = np.linalg.eigh(covariance)
    values, basis = values[::-1], basis[:, ::-1]
    assert len(rows) == n * 32
    got = {(r.vec_id, r.component): r for r in rows}
    whitened = np.array([[got[r.vec_id, k].whitened for k in range(1, 33)] for r in table])
    want = centred @ basis[:, :32] / np.sqrt(values[:32])
    signs = np.sign((whitened * want).sum(axis=0))
    assert np.abs(whitened * signs - want).max() < 1e-9
    assert {r.n for r in rows} == {n} and len({r.identity_error for r in rows}) == 1
    assert rows[0].identity_error < 1e-12
    for r, deviation in zip(table, deviations, strict=True):
        assert got[r.vec_id, 1].deviation == deviation
    for k in range(32):
        share = got[table[0].vec_id, k + 1].explained
        assert abs(share - values[k] / np.trace(covariance)) < 1e-12


def residuals(a, values, x):
    a, scale = a.astype(np.longdouble), np.abs(a).max()
    orthogonal = np.abs(x.T @ x - np.eye(len(a))).max()
    return float(np.abs(a @ x - x * values).max() / scale), float(orthogonal)


def with_values(rng, values):
    d = len(values)
    q, _ = np.linalg.qr(rng.standard_normal((d, d)))
    q = q.astype(np.longdouble)
    for _ in range(2):
        q = q + q @ (np.eye(d) - q.T @ q) / 2
    a = (q * np.array(values, dtype=np.longdouble)) @ q.T
    return (a + a.T) / 2, q


@pytest.mark.parametrize(
    "values",
    [
        [5, 4, 3, 2, 1],
        [1] * 12,
        [1 + 1e-6, 1, 1 - 1e-6, 0.5, 0.5 + 1e-9, 0.1],
        [1, 1, 1, 1e-8, 1e-8, 0],
        list(np.linspace(1, 1 + 1e-5, 20)) + [7.0],
        list(np.geomspace(1, 1e-12, 30)),
        [3.0],
        [0.0, 0.0],
    ],
)
def test_eigenvectors_to_double_precision(values):
    a, q = with_values(np.random.default_rng(len(values)), values)
    found, x = refined_eigen(a)
    assert (np.diff(found) <= 0).all()
    residual, orthogonal = residuals(a, found, x) if np.abs(a).max() else (0, 0)
    assert residual < 1e-16 and orthogonal < 1e-16
    order = np.argsort(-np.array(values), kind="stable")
    for k, at in enumerate(order):
        gap = min((abs(values[at] - v) for i, v in enumerate(values) if i != at), default=1)
        if gap > 1e-10:
            # Right to double precision as far as the matrix itself tells the vector.
            assert np.abs(np.abs(x[:, k] @ q[:, at]) - 1) < 1e-15 + (1e-17 / gap) ** 2
            assert min(np.abs(x[:, k] - s * q[:, at]).max() for s in (1, -1)) < 1e-15 + 1e-17 / gap


def test_clusters_need_the_small_problem():
    values = [1 + 3e-8, 1 + 2e-8, 1 + 1e-8, 1, 0.5]
    a, q = with_values(np.random.default_rng(4), values)
    _, rough = np.linalg.eigh(a.astype(np.float32))
    _, x = refined_eigen(a)
    right = q[:, 0]
    assert min(np.abs(rough[:, -1] - s * right).max() for s in (1, -1)) > 1e-3
    assert min(np.abs(x[:, 0] - s * right).max() for s in (1, -1)) < 1e-8


def test_whole_sums_of_products():
    rng = random.Random(1)
    for top in (3, 1 << 19, 1 << 21, 1 << 45, 1 << 52):
        y = [[rng.randint(-top, top) for _ in range(3)] for _ in range(5000)]
        got = exact_products(np.array(y, dtype=np.int64))
        for i in range(3):
            for j in range(3):
                assert got[i, j] == sum(r[i] * r[j] for r in y)
    covariance = exact_covariance(np.array([[7]], dtype=object), [1], 3)
    assert covariance[0, 0] == (np.longdouble(7 * 3 - 1)) / 9


def table(spark, rows, clashing=False):
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    for name in ("id", "vector", "at", "deviation", "whitened", "n", "total") if clashing else ():
        df = df.withColumn(name, F.lit("x"))
    return df


def test_far_from_zero_and_few_bits(spark):
    rng = random.Random(2)
    rows = [(i, [1e5 + rng.random(), -3e4 + rng.random() / 50, rng.random()]) for i in range(400)]
    got = whitened_components(spark, table(spark, rows)).collect()
    n, deviations, covariance, centred = plain([v for _, v in rows])
    values, basis = np.linalg.eigh(covariance)
    kept = len({r.component for r in got})
    assert kept == (values > values.max() * 1e-14).sum()
    assert {(r.vec_id, r.deviation) for r in got} == set(enumerate(deviations))
    assert got[0].identity_error < 1e-10


def test_same_however_dealt(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(300)]
    one, many = table(spark, rows).coalesce(1), table(spark, rows).repartition(7)
    a, b = fit_whitening(one), fit_whitening(many)
    assert a.sums == b.sums and (a.values == b.values).all() and (a.vectors == b.vectors).all()


def test_awkward_rows(spark):
    rng = random.Random(4)
    good = [(i, [rng.random() for _ in range(4)]) for i in range(30)]
    bad = [
        (100, None), (101, []), (102, [1.0, None, 2.0, 3.0]), (103, [1.0, float("nan"), 0.0, 0.0]),
        (104, [float("inf"), 0.0, 0.0, 0.0]), (105, [1.0, 2.0]), (106, [1e30, 0.0, 0.0, 0.0]),
    ]
    rows = [*good, *bad, (3, good[3][1]), (None, [0.5] * 4)]
    got = whitened_components(spark, table(spark, rows, clashing=True)).collect()
    assert {r.n for r in got} == {32} and len(got) == 32 * 4
    assert {r.vec_id for r in got} == {*range(30), None}
    assert sum(r.vec_id == 3 for r in got) == 8


@pytest.mark.parametrize(
    "rows, components",
    [
        ([], 0),
        ([(1, None), (2, [])], 0),
        ([(1, [1.0, 2.0])], 0),
        ([(1, [1.0, 2.0]), (2, [1.0, 3.0])], 1),
        ([(i, [float(i % 2), 5.0, float(i % 3)]) for i in range(12)], 2),
    ],
)
def test_components_without_variance_are_left_out(spark, rows, components):
    got = whitened_components(spark, table(spark, rows))
    assert len({r.component for r in got.collect()}) == components
    assert len(got.columns) == 7


def test_deviation_beyond_64_bits_is_null(spark):
    rows = [(i, [float(i % 7) * 1e11, 0.25 * i]) for i in range(50)]
    model = fit_whitening(table(spark, rows))
    _, deviations, *_ = plain([v for _, v in rows])
    got = {r.id: r.deviation for r in whiten(table(spark, rows), model).collect()}
    assert got == {i: d if d < 1 << 63 else None for i, d in enumerate(deviations)}
    assert None in got.values()


def test_more_components_can_be_asked_for(spark):
    rows = [(i, np.random.default_rng(i).random(40).tolist()) for i in range(90)]
    assert len(fit_whitening(table(spark, rows), components=40).values) == 40
    assert len(fit_whitening(table(spark, rows)).values) == 32
