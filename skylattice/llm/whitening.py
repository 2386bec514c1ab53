"""Whitening of embeddings by refined eigenvectors.

Entries are put on a grid of whole numbers, so counts, sums and the covariance are exact
and do not depend on how rows are dealt out. Four passes over the table: the number of
vectors and sums by dimension; the products of centred entries; the covariance of the result,
which measures the error; and the result itself. Only sums of at most ``d * d`` numbers are
shuffled or reach the driver.

The eigenvectors come from float32 and are corrected by the matrix multiplications of Ogita
and Aishima: with ``R = I - X'X`` and ``S = X'AX`` the correction of a vector by another is
``(S_ij + l_j R_ij) / (l_j - l_i)``, and half of ``R_ij`` where the two eigenvalues are too
close to be told apart. Each round doubles the number of right digits, first in float64, then
in extended precision. Close eigenvalues are a cluster: their part of the space is found by
the rounds, and the vectors inside it by a small problem of its own, ``Y'(A - m I)Y`` with
``m`` the cluster's mean, whose eigenvalues are far apart in relation to its size.

Centring: ``m``, the nearest whole number to a dimension's mean, is taken off before
multiplying, and what the mean differs from it is taken off the sums in exact arithmetic.

Defined results: a vector that is null or holds a null, NaN or infinite entry is left out,
and so is one with an entry of 2^46 or more, which the grid cannot hold. Vectors of another
length than the commonest (of equally common ones the longest) have no place in the
covariance and are left out. Repeated rows count each; a null id is an id like any other.
Components whose eigenvalue is zero up to rounding, as of constant dimensions or fewer
vectors than dimensions, cannot be scaled to one and are left out. ``deviation`` is null
where it does not fit 64 bits. A table without vectors gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

#: Grid steps in one unit, and the whole number that zero becomes.
STEPS = 64
OFFSET = 1_000_000
COMPONENTS = 32
#: Entries beyond are off the grid.
LARGEST = 2.0**46
#: Products of limbs of so many bits are exact in float64, and so are sums of a block's.
_LIMB_BITS = 20
_BLOCK_ROWS = 4_096
#: Rounds of refinement at most in each precision.
_ROUNDS = 20


@dataclass(frozen=True)
class Whitening:
    """``vectors[:, k]`` is component ``k``; ``values`` are the eigenvalues, falling."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float

    @property
    def centre(self) -> np.ndarray:
        """The nearest whole number to each dimension's mean."""
        return np.array([_nearest(s, self.n) for s in self.sums], dtype=np.int64)

    @property
    def rest(self) -> list[int]:
        """``n`` times what the mean is beyond ``centre``."""
        return [s - self.n * int(c) for s, c in zip(self.sums, self.centre, strict=True)]


def _nearest(total: int, n: int) -> int:
    return (2 * total + n) // (2 * n)


# --- grid ------------------------------------------------------------------------


def _on_grid(column: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that take part and their entries on the grid, as a matrix."""
    starts = column.offsets.to_numpy()[:-1]
    rows = np.flatnonzero(_lengths(column) == length)
    flat = column.values.to_numpy(zero_copy_only=False)  # null becomes NaN
    entries = flat[starts[rows][:, None] + np.arange(length)]
    with np.errstate(invalid="ignore", over="ignore"):
        fine = (np.isfinite(entries) & (np.abs(entries) < LARGEST)).all(axis=1)
    grid = np.floor(entries[fine] * STEPS).astype(np.int64) + OFFSET
    return rows[fine], grid


def _lengths(column: pa.Array) -> np.ndarray:
    """Length of each vector; -1 where it is null."""
    sizes = np.diff(column.offsets.to_numpy())
    return np.where(column.is_null().to_numpy(zero_copy_only=False), -1, sizes)


def _whole_sums(x: np.ndarray) -> list[int]:
    """Exact sums by column, which may be beyond 64 bits."""
    high, low = x >> 26, x & ((1 << 26) - 1)
    return [
        (int(a) << 26) + int(b) for a, b in zip(high.sum(axis=0), low.sum(axis=0), strict=True)
    ]


def exact_products(y: np.ndarray) -> np.ndarray:
    """``y' y`` in whole numbers, by float64 products of limbs."""
    d = y.shape[1]
    total = np.zeros((d, d), dtype=object)
    for at in range(0, len(y), _BLOCK_ROWS):
        limbs, rest = [], y[at : at + _BLOCK_ROWS]
        while rest.any() and len(limbs) < 4:
            # Limbs are between -2^19 and 2^19, so the rest runs out at either sign.
            limb = ((rest + (1 << (_LIMB_BITS - 1))) & ((1 << _LIMB_BITS) - 1)) - (
                1 << (_LIMB_BITS - 1)
            )
            limbs.append(limb.astype(np.float64))
            rest = (rest - limb) >> _LIMB_BITS
        for i, a in enumerate(limbs):
            for j, b in enumerate(limbs):
                product = (a.T @ b).astype(np.int64)
                total += product.astype(object) << (_LIMB_BITS * (i + j))
    return total


# --- eigenvectors ------------------------------------------------------------------


def refined_eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and eigenvectors of a symmetric matrix of any precision."""
    d = len(a)
    if not d:
        return np.zeros(0), np.zeros((0, 0))
    scale = np.abs(a).max()
    if scale == 0:
        return np.zeros(d), np.eye(d)
    a = a / scale
    _, x = np.linalg.eigh(a.astype(np.float32))
    for kind in (np.float64, np.longdouble):
        values, x = _refine(a.astype(kind), x.astype(kind))
    order = np.argsort(-values, kind="stable")
    x = x[:, order]
    # Either sign would do; the largest entry is made positive.
    peak = np.abs(x).argmax(axis=0)
    x = x * np.where(x[peak, np.arange(d)] < 0, -1, 1)
    return (values[order] * scale), x


def _refine(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    best, stalled = np.inf, 0
    for _ in range(_ROUNDS):
        values, x, clusters, error = _round(a, x)
        for cluster in clusters:
            x[:, cluster] = _inside(a, x[:, cluster])
        stalled = stalled + 1 if error >= best / 2 else 0
        if stalled == 2:
            break
        best = min(best, error)
    order = np.argsort(values, kind="stable")
    return _rayleigh(a, x)[order], x[:, order]


def _rayleigh(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->j", x, a @ x) / np.einsum("ij,ij->j", x, x)


def _round(a: np.ndarray, x: np.ndarray):
    """One correction of all vectors; also the clusters, and the error there was before."""
    d = len(a)
    r = np.eye(d, dtype=a.dtype) - x.T @ x
    s = x.T @ (a @ x)
    # Rounding must not tell i, j from j, i: the vectors would lean towards each other.
    r, s = (r + r.T) / 2, (s + s.T) / 2
    values = np.diag(s) / (1 - np.diag(r))
    off = s - np.diag(np.diag(s))
    close = 2 * (_norm(off) + np.abs(values).max() * _norm(r))
    gap = values[None, :] - values[:, None]
    apart = np.abs(gap) > close
    with np.errstate(divide="ignore", invalid="ignore"):
        e = np.where(apart, (s + values[None, :] * r) / gap, r / 2)
    order = np.argsort(values, kind="stable")
    steps = np.diff(values[order]) > close
    clusters = [c for c in np.split(order, np.flatnonzero(steps) + 1) if len(c) > 1]
    x = x + x @ e
    return values, x, clusters, close


def _norm(m: np.ndarray) -> np.floating:
    """An upper bound of the spectral norm of a symmetric matrix."""
    return np.abs(m).sum(axis=0).max()


def _inside(a: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Vectors of a cluster, from the small problem on the space they span."""
    middle = _rayleigh(a, y).mean()
    small = y.T @ (a @ y - middle * y)
    small = (small + small.T) / 2
    scale = np.abs(small).max()
    if scale <= np.finfo(a.dtype).eps:
        return y  # equal eigenvalues: any vectors of the space do
    _, turn = np.linalg.eigh((small / scale).astype(np.float64))
    turn = turn.astype(a.dtype)
    # Orthogonal to the last digit, so that the turn costs nothing of what was gained.
    for _ in range(2):
        turn = turn + turn @ (np.eye(len(turn), dtype=a.dtype) - turn.T @ turn) / 2
    return y @ turn


def exact_covariance(products: np.ndarray, rest: list[int], n: int) -> np.ndarray:
    """Covariance in extended precision from whole products about ``centre``."""
    t = np.array(rest, dtype=object)
    scaled = products * n - np.outer(t, t)
    out = np.empty(scaled.shape, dtype=np.longdouble)
    for at, value in np.ndenumerate(scaled):
        exact = Fraction(int(value), n * n)
        high = float(exact)
        out[at] = np.longdouble(high) + np.longdouble(float(exact - Fraction(high)))
    return out


# --- passes --------------------------------------------------------------------------


def _vectors(table: DataFrame, vector: str, identity: str | None = None) -> DataFrame:
    columns = [F.col(f"`{vector}`").cast("array<double>").alias("vector")]
    if identity is not None:
        columns.append(F.col(f"`{identity}`").alias("id"))
    return table.select(*columns)


def _few_tasks(df: DataFrame) -> DataFrame:
    """Fewer, larger tasks where each gives ``d * d`` sums, whatever its share of rows."""
    return df.coalesce(max(4 * df.sparkSession.sparkContext.defaultParallelism, 8))


def _sums(vectors: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors of the commonest length, and their sums by dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for batch in batches:
            column = batch.column("vector")
            for length in np.unique(_lengths(column)).tolist():
                if length < 0:
                    continue
                rows, x = _on_grid(column, length)
                if not len(rows):
                    continue
                n, sums = found.get(length, (0, [0] * length))
                found[length] = (
                    n + len(rows), [a + b for a, b in zip(sums, _whole_sums(x), strict=True)]
                )
        for length, (n, sums) in found.items():
            yield pa.RecordBatch.from_pydict(
                {
                    "length": pa.array([length] * (length + 1), pa.int32()),
                    "dim": pa.array(range(-1, length), pa.int32()),
                    "total": pa.array([n, *sums], pa.decimal128(38, 0)),
                }
            )

    parts = _few_tasks(vectors).mapInArrow(run, "length int, dim int, total decimal(38,0)")
    by_dim = parts.groupBy("length", "dim").agg(F.sum("total").alias("total"))
    first = by_dim.filter("dim = -1").orderBy(F.desc("total"), F.desc("length")).first()
    if first is None or not first.length:
        return 0, []
    own = by_dim.filter((F.col("length") == first.length) & (F.col("dim") >= 0)).collect()
    return int(first.total), [int(r.total) for r in sorted(own, key=lambda r: r.dim)]


def _products(vectors: DataFrame, centre: np.ndarray) -> np.ndarray:
    """Whole sums of products of centred entries."""
    d = len(centre)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d), dtype=object)
        for batch in batches:
            _, x = _on_grid(batch.column("vector"), d)
            if len(x):
                total += exact_products(x - centre)
        yield from _lower(total, pa.decimal128(38, 0))

    parts = _few_tasks(vectors).mapInArrow(run, "i int, j int, total decimal(38,0)")
    return _symmetric(parts, d, object, int)


def _lower(total: np.ndarray, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """The lower triangle, a batch for each row."""
    for i in range(len(total)):
        yield pa.RecordBatch.from_pydict(
            {
                "i": pa.array([i] * (i + 1), pa.int32()),
                "j": pa.array(range(i + 1), pa.int32()),
                "total": pa.array(total[i, : i + 1].tolist(), kind),
            }
        )


def _symmetric(parts: DataFrame, d: int, kind: type, convert: type) -> np.ndarray:
    out = np.zeros((d, d), dtype=kind)
    for r in parts.groupBy("i", "j").agg(F.sum("total").alias("total")).collect():
        out[r.i, r.j] = out[r.j, r.i] = convert(r.total)
    return out


def _project(x: np.ndarray, model: Whitening) -> np.ndarray:
    """Whitened rows: the exact distance from the centre, less what the mean is beyond it."""
    beyond = np.array([r / model.n for r in model.rest])
    return ((x - model.centre) - beyond) @ (model.vectors / np.sqrt(model.values))


def _identity_error(vectors: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened rows' covariance minus the identity, as measured."""
    d, k = len(model.sums), len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for batch in batches:
            _, x = _on_grid(batch.column("vector"), d)
            w = _project(x, model)
            total += w.T @ w
        yield from _lower(total, pa.float64())

    parts = _few_tasks(vectors).mapInArrow(run, "i int, j int, total double")
    covariance = _symmetric(parts, k, float, float) / model.n
    return float(np.abs(covariance - np.eye(k)).max(initial=0.0))


def fit_whitening(
    table: DataFrame, components: int = COMPONENTS, vector: str = "embedding"
) -> Whitening | None:
    """Fit over all vectors; None if there are none."""
    vectors = _vectors(table, vector)
    n, sums = _sums(vectors)
    if not n:
        return None
    blank = Whitening(n, sums, np.zeros((0, 0)), np.zeros(0), 0.0, 0.0)
    covariance = exact_covariance(_products(vectors, blank.centre), blank.rest, n)
    values, basis = refined_eigen(covariance)
    trace = float(np.trace(covariance))
    # Beyond rounding of the matrix itself, an eigenvalue of zero may come out positive.
    real = values > max(float(values.max(initial=0.0)), 0.0) * len(sums) * 1e-15
    kept = np.flatnonzero(real)[:components]
    model = Whitening(
        n, sums, basis[:, kept].astype(np.float64), values[kept].astype(np.float64), trace, 0.0
    )
    error = _identity_error(vectors, model)
    return Whitening(n, sums, model.vectors, model.values, trace, error)


def _deviations(x: np.ndarray, model: Whitening) -> pa.Array:
    """Exact sums of ``(n x - S)^2``; null beyond 64 bits."""
    y, rest = x - model.centre, np.array(model.rest, dtype=object)
    bound = (model.n * int(np.abs(y).max(initial=0)) + model.n) ** 2 * max(1, y.shape[1])
    if bound < 1 << 63:
        return pa.array(((model.n * y - rest.astype(np.int64)) ** 2).sum(axis=1), pa.int64())
    exact = ((model.n * y.astype(object) - rest) ** 2).sum(axis=1).tolist()
    return pa.array([e if e < 1 << 63 else None for e in exact], pa.int64())


def whiten(
    table: DataFrame, model: Whitening, vector: str = "embedding", identity: str = "vec_id"
) -> DataFrame:
    """``id``, ``deviation`` and the whitened vector of each row that takes part."""
    d = len(model.sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, x = _on_grid(batch.column("vector"), d)
            if not len(rows):
                continue
            flat = _project(x, model)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(flat.reshape(-1)), flat.shape[1])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(rows)),
                    _deviations(x, model),
                    lists.cast(pa.list_(pa.float64())),
                ],
                names=["id", "deviation", "whitened"],
            )

    rows = _vectors(table, vector, identity)
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, deviation long, whitened array<double>")


def whitened_components(
    spark: SparkSession, table: DataFrame, components: int = COMPONENTS
) -> DataFrame:
    """One row for each vector and component, with the share of the variance it explains."""
    model = fit_whitening(table, components)
    if model is None or not len(model.values):
        return spark.createDataFrame([], _LONG)
    shares = F.array(*(F.lit(float(v / model.trace)) for v in model.values))
    rows = whiten(table, model).select(
        F.col("id").cast("long").alias("vec_id"),
        "deviation",
        F.posexplode("whitened").alias("at", "whitened"),
    )
    return rows.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(shares, F.col("at") + 1).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )


_LONG = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, "
    "identity_error double"
)
