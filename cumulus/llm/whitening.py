"""Whitening of embeddings by incremental eigendecomposition.

Entries become integers; each distinct integer vector once is the fit list,
written to the shared folder.  Three distributed steps find the eigenvectors of
its covariance:

1. Every partition keeps a count, a mean and the eigenpairs of its scatter
   matrix.  A vector is a centred rank-one update: with z the deviation from
   the running mean in the current eigenvectors, the new eigenvalues solve the
   secular equation of diag(values) + rho z z'.  Components of z that are
   nearly 0, and one of each pair of nearly equal eigenvalues (after a
   rotation), are deflated: their eigenpairs stay.
2. Spectra are combined in groups of ``FAN_IN``, level by level: each eigenpair
   of one is a rank-one update of the other, as is the difference of means.
3. Rayleigh-Ritz: the fit list, centred by its exact mean before anything is
   multiplied, is projected on the found vectors; the small covariance of the
   projections is summed over the partitions and its eigenvectors turn the
   basis.  The basis is complete, so the result is that of the whole covariance
   to double precision, whatever rounding the updates left.

A task holds one batch and a few dim x dim matrices; the driver sees one
spectrum and sums of dim x dim numbers.

Defined cases: a vector that is null or holds null or non-finite entries is
dropped; vectors of another length than most rows have (ties: the shorter) are
dropped too, as are empty ones; repeated rows are whitened each and fitted
once; a null id is carried; a component whose eigenvalue is nothing but
rounding has no unit variance to give and is left out; fewer dimensions than
components give fewer components; an empty table gives no rows; columns beside
id and vector are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cumulus.llm.common import materialize

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000  # an entry c becomes floor(SCALE * c) + SHIFT
FAN_IN = 16
EPS = np.finfo(float).eps
STEPS = 60  # of the secular equation's root search: a bisection safeguard inside a double's 53 bits


@dataclass
class Spectrum:
    """Count, mean and eigenpairs (values ascending, vectors in columns) of a scatter matrix."""

    n: int
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, dim: int) -> Spectrum:
        return cls(0, np.zeros(dim), np.zeros(dim), np.eye(dim))


def secular_roots(d: np.ndarray, z2: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + rho * sum(z2 / (d - x)) for ascending distinct ``d``, ``z2`` > 0 and ``rho`` > 0.

    Root i lies between d[i] and d[i + 1] (the last one below d[-1] + rho * sum(z2)).  Each is given as the nearer
    of the two poles and the distance from it, so that differences to the poles keep their precision: (pole, offset).
    """
    k = len(d)
    gap = np.append(np.diff(d), rho * z2.sum())
    # the function rises between its poles: its sign in the middle tells which pole is nearer
    middle = 1 + rho * (z2 / (d - (d[:, None] + gap[:, None] / 2))).sum(axis=1)
    pole = np.where((middle >= 0) | (np.arange(k) == k - 1), np.arange(k), np.minimum(np.arange(k) + 1, k - 1))
    left = pole == np.arange(k)
    apart = d - d[pole][:, None]
    low = np.where(left, 0.0, -gap / 2)
    high = np.where(left, np.where(np.arange(k) == k - 1, gap, gap / 2), 0.0)
    x = (low + high) / 2
    own, r = (np.arange(k), pole), rho * z2
    weight = r[pole]
    for _ in range(STEPS):
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            away = apart - x[:, None]
            share = r / away
            value = 1 + share.sum(axis=1)
            exact = np.abs(value) <= 4 * EPS * (1 + np.abs(share).sum(axis=1))  # nothing but rounding is left
            low, high = np.where(value < 0, x, low), np.where(value < 0, high, x)
            # the nearer pole's own term is kept, the others' sum is taken as linear: slope x^2 + a x - weight = 0
            mine = share[own]
            slope = np.maximum(np.einsum("ij,ij->i", share, 1 / away) + mine / x, 0.0)
            a = value - mine - slope * x
            root = np.sqrt(a * a + 4 * slope * weight)
            up = np.where(a >= 0, 2 * weight / (a + root), (root - a) / (2 * slope))
            down = np.where(a >= 0, -(a + root) / (2 * slope), -2 * weight / (root - a))
            new = np.where(left, up, down)
            new = np.where((new > low) & (new < high), new, (low + high) / 2)
        still = exact | (np.abs(new - x) <= 2 * EPS * np.abs(new))
        x = np.where(exact, x, new)
        if still.all():
            break
    return pole, x


def rank_one(values: np.ndarray, vectors: np.ndarray, update: np.ndarray, rho: float = 1.0):
    """Eigenpairs of vectors diag(values) vectors' + rho * update update', values ascending."""
    z = vectors.T @ update
    scale = max(np.abs(values).max(), rho * (z @ z))
    if scale == 0:
        return values, vectors
    small = 8 * EPS * scale
    moving = rho * np.abs(z) * np.sqrt(z @ z) > small  # the others are eigenpairs of the sum already
    rows = np.flatnonzero(moving)
    close = np.diff(values[rows]) <= small
    if close.any():  # of two nearly equal values one takes the whole of z by a rotation, the other stays
        vectors, z, kept = vectors.copy(), z.copy(), []
        for i in rows:
            if kept and values[i] - values[kept[-1]] <= small:
                j = kept.pop()
                r = np.hypot(z[j], z[i])
                c, s = z[i] / r, z[j] / r
                vectors[:, j], vectors[:, i] = c * vectors[:, j] - s * vectors[:, i], s * vectors[:, j] + c * vectors[:, i]
                z[j], z[i] = 0.0, r
            kept.append(i)
        rows = np.array(kept)
    if not len(rows):
        return values, vectors
    d, part = values[rows], z[rows]
    pole, x = secular_roots(d, part * part, rho)
    roots = d[pole] + x
    # differences d[j] - root[i], from the nearer pole
    diff = (d - d[pole][:, None]) - x[:, None]
    # z whose exact update has these roots (Loewner), so that the eigenvectors are orthogonal
    k = len(rows)
    ratio = np.empty((k, k))
    below = d[:, None] - d[None, :]
    np.fill_diagonal(below, 1.0)
    ratio[:] = diff / below.T
    np.fill_diagonal(ratio, diff.diagonal())
    z_new = np.copysign(np.sqrt(np.abs(np.prod(ratio, axis=0)) / rho), part)
    turn = z_new[None, :] / diff
    turn /= np.sqrt((turn * turn).sum(axis=1, keepdims=True))
    new_values, new_vectors = values.copy(), vectors.copy()
    new_values[rows], new_vectors[:, rows] = roots, vectors[:, rows] @ turn.T
    order = np.argsort(new_values, kind="stable")
    return new_values[order], new_vectors[:, order]


def add_vector(s: Spectrum, x: np.ndarray) -> Spectrum:
    """One more vector: a rank-one update by its deviation from the mean so far."""
    away = x - s.mean
    values, vectors = (s.values, s.vectors) if s.n == 0 else rank_one(s.values, s.vectors, away, s.n / (s.n + 1))
    return Spectrum(s.n + 1, s.mean + away / (s.n + 1), values, vectors)


def combine(a: Spectrum, b: Spectrum) -> Spectrum:
    """The spectrum of both lists: each eigenpair of one updates the other, then the difference of means."""
    if not a.n or not b.n:
        return a if a.n else b
    values, vectors = a.values, a.vectors
    for value, vector in zip(b.values, b.vectors.T, strict=True):
        if value > 0:
            values, vectors = rank_one(values, vectors, vector, float(value))
    away, n = b.mean - a.mean, a.n + b.n
    values, vectors = rank_one(values, vectors, away, a.n * b.n / n)
    return Spectrum(n, a.mean + away * (b.n / n), values, vectors)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


_SPECTRUM = "n long, mean array<double>, spectrum array<double>, vectors array<double>"


def _row(s: Spectrum) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([s.n], pa.int64()), *[pa.array([v.ravel()], pa.list_(pa.float64())) for v in (s.mean, s.values, s.vectors)]],
        ["n", "mean", "spectrum", "vectors"])


def _spectra(rows: pa.Table, dim: int):
    for n, *arrays in zip(*(rows[c].to_pylist() for c in ("n", "mean", "spectrum", "vectors")), strict=True):
        mean, values, vectors = map(np.array, arrays)
        yield Spectrum(n, mean, values, vectors.reshape(dim, dim))


def _spectrum_of(fitted: DataFrame, dim: int) -> Spectrum:
    """The combined spectrum of the fit list; at most one row of dim x dim numbers reaches the driver."""
    def update(batches):
        s = Spectrum.empty(dim)
        for b in batches:
            for x in _matrix(b.column("x"), dim).astype(float):
                s = add_vector(s, x)
        if s.n:
            yield _row(s)

    def merge(rows: pa.Table) -> pa.Table:
        s = Spectrum.empty(dim)
        for one in _spectra(rows.sort_by("place"), dim):
            s = combine(s, one)
        return pa.Table.from_batches([_row(s)]).add_column(0, "place", [[rows["place"][0].as_py() // FAN_IN]])

    level = materialize(fitted.select("x").mapInArrow(update, _SPECTRUM)
                        .withColumn("place", F.spark_partition_id().cast("long")), "spectra")
    width = level.agg(F.max("place")).first()[0]
    while width:
        level = materialize(level.groupBy(F.floor(F.col("place") / FAN_IN).alias("to"))
                            .applyInArrow(merge, f"place long, {_SPECTRUM}"), "spectra")
        width //= FAN_IN
    return next(_spectra(level.toArrow(), dim))


def _summed(fitted: DataFrame, dim: int, mean_of, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum and sum of products of the centred fit list in ``basis``, added up over the partitions."""
    size = basis.shape[1]

    def run(batches):
        total, products, any_ = np.zeros(size), np.zeros((size, size)), False
        for b in batches:
            y = mean_of(_matrix(b.column("x"), dim)) @ basis
            total, products, any_ = total + y.sum(axis=0), products + y.T @ y, True
        if any_:
            yield pa.RecordBatch.from_arrays([pa.array([np.vstack([total, products]).ravel()], pa.list_(pa.float64()))], ["v"])

    got = fitted.select("x").mapInArrow(run, "v array<double>").select(F.posexplode("v").alias("at", "v"))
    rows = got.groupBy("at").agg(F.sum("v").alias("v")).orderBy("at").collect()  # (dim + 1) * dim numbers
    both = np.array([r["v"] for r in rows]).reshape(size + 1, size)
    return both[0], both[1:]


def integer_vectors(vectors: DataFrame, id_col="vec_id", vec_col="embedding") -> DataFrame:
    """(id, x) of the rows whose vector is whole and finite."""
    c = F.col(vec_col).cast("array<double>")
    able = vectors.select(F.col(id_col).cast("long").alias("id"), c.alias("c")).where(
        F.coalesce(F.size("c") > 0, F.lit(False))
        & F.forall("c", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))))
    return able.select("id", F.transform("c", lambda e: F.floor(e * SCALE) + SHIFT).cast("array<long>").alias("x"))


def whiten(vectors: DataFrame, id_col="vec_id", vec_col="embedding", components: int = COMPONENTS) -> DataFrame:
    """Per vector and component (from 1, by falling eigenvalue): id, component, n, deviation (a whole decimal),
    whitened, explained, identity_error."""
    rows = materialize(integer_vectors(vectors, id_col, vec_col), "integers")
    sizes = rows.groupBy(F.size("x").alias("dim")).agg(F.count(F.lit(1)).alias("c"))
    dim = sizes.orderBy(F.desc("c"), "dim").limit(1).collect()
    schema = ("id long, component int, n long, deviation decimal(38,0), whitened double, explained double, "
              "identity_error double")
    if not dim:
        return vectors.sparkSession.createDataFrame([], schema).withColumnRenamed("id", id_col)
    dim = dim[0]["dim"]
    rows = rows.where(F.size("x") == dim)
    fitted = materialize(rows.select("x").distinct(), "fitted")
    sums = fitted.select(F.posexplode("x").alias("at", "v")).groupBy("at").agg(
        F.sum(F.col("v").cast("decimal(38,0)")).alias("s"), F.count(F.lit(1)).alias("n")).orderBy("at").collect()
    n, whole = sums[0]["n"], [int(r["s"]) for r in sums]
    # S / n as a whole number and a rest: x less the whole number is exact
    base = np.array([s // n for s in whole], np.int64)
    rest = np.array([s % n / n for s in whole])

    def centred(x: np.ndarray) -> np.ndarray:
        return (x - base).astype(float) - rest

    basis = np.linalg.qr(_spectrum_of(fitted, dim).vectors)[0]  # orthonormal to the last bit
    products = _summed(fitted, dim, centred, basis)[1] / n
    values, turn = np.linalg.eigh((products + products.T) / 2)
    values, vectors_ = values[::-1], (basis @ turn)[:, ::-1]
    trace = float(np.trace(products))
    able = values[:components] > dim * EPS * max(values[0], 0.0) * 16
    chosen = vectors_[:, :components][:, able]
    spread, explained = np.sqrt(values[:components][able]), values[:components][able] / (trace or 1.0)
    if not len(spread):
        return vectors.sparkSession.createDataFrame([], schema).withColumnRenamed("id", id_col)
    weights = chosen / spread
    total, products = _summed(fitted, dim, centred, weights)
    covariance = products / n - np.outer(total / n, total / n)
    error = float(np.abs(covariance - np.eye(len(spread))).max())
    rest_n = np.array([s % n for s in whole], object)

    def project(batches):
        k = len(spread)
        for b in batches:
            x = _matrix(b.column("x"), dim)
            y = centred(x) @ weights
            far = int(np.abs(x - base).max(initial=0)) + 1
            exact = (x - base) if (far * n) ** 2 * dim < 2**63 else (x - base).astype(object)
            away = exact * n - (rest_n.astype(np.int64) if exact.dtype != object else rest_n)
            deviation = pa.array([int(d) for d in (away * away).sum(axis=1)], pa.decimal128(38, 0))
            of = pa.array(np.repeat(np.arange(len(x)), k))
            yield pa.RecordBatch.from_arrays(
                [b.column("id").take(of), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                 pa.array(np.full(len(x) * k, n, np.int64)), deviation.take(of), pa.array(y.ravel()),
                 pa.array(np.tile(explained, len(x))), pa.array(np.full(len(x) * k, error))],
                ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(project, schema).withColumnRenamed("id", id_col)
