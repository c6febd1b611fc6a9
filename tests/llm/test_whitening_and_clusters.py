"""Whitening against a dense eigendecomposition, clusters against plain rounds."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest

from cumulus.llm import laesa, whitening
from cumulus.llm.queries import op12_whitening, op13_laesa_clusters
from tests.conftest import SF_SMALL

VECS = "vec_id long, embedding array<float>, component int, cluster string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "clash") for i, v in rows], VECS)


def whole(rows):
    return [(i, [int(math.floor(64.0 * float(np.float32(c)))) + 1_000_000 for c in v]) for i, v in rows
            if v and None not in v and np.isfinite(np.array(v, np.float32)).all()]


def check_whitened(got, rows, components=16):
    """Every column against exact integers and numpy's dense eigenvectors; either sign."""
    rows = whole(rows)
    fit = sorted({tuple(x) for _, x in rows})
    n, dim = len(fit), len(fit[0])
    sums = [sum(c) for c in zip(*fit, strict=True)]
    centred = (np.array(fit, object) * n - np.array(sums, object)).astype(float) / n
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(components, int((values > 1e-9 * values[0]).sum()))
    assert Counter((r["vec_id"], r["component"]) for r in got) == Counter((i, c + 1) for i, _ in rows for c in range(k))
    of = {i: x for i, x in rows}
    signs = {}
    for r in got:
        x, c = of[r["vec_id"]], r["component"] - 1
        assert r["n"] == n and r["deviation"] == sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
        assert abs(r["explained"] - values[c] / values.sum()) < 1e-9 and r["identity_error"] < 1e-9
        want = float(np.array([(n * a - s) / n for a, s in zip(x, sums, strict=True)]) @ vectors[:, c] / math.sqrt(values[c]))
        if abs(want) > 1e-4:
            signs.setdefault(c, np.sign(want * r["whitened"]))
            assert abs(r["whitened"] * signs[c] - want) < 1e-6
        else:
            assert abs(r["whitened"]) < 2e-4


def test_whitening_query_over_all_embeddings(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    check_whitened(op12_whitening(spark, SF_SMALL).collect(), rows)


@pytest.mark.parametrize("dim,rank,n", [(5, 5, 200), (24, 7, 90), (3, 3, 4), (20, 20, 12)])
def test_whitening_of_any_shape(spark, dim, rank, n):
    """Full rank, low rank, fewer vectors than dimensions; repeated vectors are fitted once."""
    rng = np.random.default_rng(dim)
    x = rng.integers(-40, 40, (n, rank)) @ rng.integers(-3, 4, (rank, dim))
    rows = [(i, (v / 8).astype(np.float32).tolist()) for i, v in enumerate(x)]
    rows += [(1000 + i, rows[i % 2][1]) for i in range(30)]
    check_whitened(whitening.whiten(table(spark, rows).repartition(7)).collect(), rows)


def test_vectors_that_are_not_whitened(spark):
    good = [(i, [float(i % 3), float(i % 5), 1.0 * i]) for i in range(9)]
    odd = [(20, None), (21, [1.0, None, 2.0]), (22, [float("nan"), 1.0, 1.0]), (23, [1.0, float("inf"), 1.0]), (24, []), (25, [1.0])]
    check_whitened(whitening.whiten(table(spark, good + odd)).collect(), good)
    assert whitening.whiten(table(spark, good)).columns == [
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    named_null = whitening.whiten(table(spark, [*good, (None, [9.0, 9.0, 9.0])])).collect()
    assert sum(r["vec_id"] is None for r in named_null) == 3
    assert whitening.whiten(table(spark, [(1, [1.0, 2.0])] * 3)).count() == 0  # one vector has no variance
    assert whitening.whiten(table(spark, odd)).count() == 0 and whitening.whiten(table(spark, [])).count() == 0
    far = [(i, [1e15 * (i + 1), float(i * i)]) for i in range(6)]  # beyond 64-bit squares
    got = {r["vec_id"]: int(r["deviation"]) for r in whitening.whiten(table(spark, far)).where("component = 1").collect()}
    xs = dict(whole(far))
    assert got == {i: sum((6 * a - s) ** 2 for a, s in zip(x, map(sum, zip(*xs.values(), strict=True)), strict=True)) for i, x in xs.items()}


def scatter(rows):
    away = rows - rows.mean(axis=0)
    return away.T @ away


@pytest.mark.parametrize("kind", ["normal", "equal directions", "graded", "integers", "one axis"])
def test_updates_and_combination_give_the_scatter_matrix(kind):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((70, 12))
    if kind == "equal directions":
        x = np.repeat(x[:6], 12, axis=0)
    elif kind == "graded":
        x = x * 10.0 ** -np.arange(12)
    elif kind == "integers":
        x = rng.integers(0, 2, (70, 12)).astype(float)
    elif kind == "one axis":
        x = np.outer(np.arange(70.0), np.eye(12)[4])
    whole_, halves = whitening.Spectrum.empty(12), [whitening.Spectrum.empty(12), whitening.Spectrum.empty(12)]
    for i, v in enumerate(x):
        whole_, halves[i % 3 == 0] = whitening.add_vector(whole_, v), whitening.add_vector(halves[i % 3 == 0], v)
    for s in (whole_, whitening.combine(*halves)):
        assert s.n == len(x) and np.allclose(s.mean, x.mean(axis=0))
        assert np.allclose(s.vectors.T @ s.vectors, np.eye(12), atol=1e-12)
        scale = np.abs(scatter(x)).max()
        assert np.abs(s.vectors @ np.diag(s.values) @ s.vectors.T - scatter(x)).max() < 1e-12 * scale


def test_secular_roots_interlace_and_solve():
    rng = np.random.default_rng(4)
    for gap in (1.0, 1e-6):
        d = np.cumsum(rng.random(20) * gap + gap / 100)
        z = rng.standard_normal(20) * 10.0 ** rng.integers(-5, 1, 20)
        pole, x = whitening.secular_roots(d, z * z, 2.0)
        want = np.linalg.eigvalsh(np.diag(d) + 2.0 * np.outer(z, z))
        assert np.allclose(d[pole] + x, want, rtol=1e-12, atol=1e-13 * want.max())


def plain_clusters(rows, dim, k, rounds):
    x = [(i, [int(math.floor(64.0 * float(np.float32(c)))) for c in v]) for i, v in rows
         if v and len(v) == dim and None not in v and np.isfinite(np.array(v, np.float32)).all()]
    first = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in x if i is not None)
    centres = [v for _, v in first[:k]]
    if not centres:
        return Counter()
    far = lambda a, b: sum((p - q) ** 2 for p, q in zip(a, b, strict=True))
    for r in range(rounds + 1):
        own = [min((far(v, c), j) for j, c in enumerate(centres)) for _, v in x]
        if r < rounds:
            centres = [[sum(col) // len(col) for col in zip(*m, strict=True)] if (m := [v for (_, v), o in zip(x, own, strict=True) if o[1] == j])
                       else c for j, c in enumerate(centres)]
    by = Counter()
    for d, j in own:
        by[j] += d
    return Counter((i, j, d, by[j], sum(by.values()), tuple(centres[j])) for (i, _), (d, j) in zip(x, own, strict=True))


def found(df):
    return Counter((r["vec_id"], r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], tuple(r["centroid"])) for r in df.collect())


def test_cluster_query_over_all_embeddings(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    want = plain_clusters(rows, 64, 16, 3)
    sha = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    got = op13_laesa_clusters(spark, SF_SMALL).collect()
    assert Counter((r["vec_id"], r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"]) for r in got) == Counter(
        {(*key[:5], sha(key[5])): n for key, n in want.items()})


@pytest.mark.parametrize("dim,k,n", [(3, 4, 300), (64, 16, 200), (2, 5, 3)])
def test_clusters_against_plain_rounds(spark, dim, k, n):
    rng = np.random.default_rng(dim)
    rows = [(i, (rng.integers(-9, 9, dim) / 16).astype(np.float32).tolist()) for i in range(n)]  # many ties
    rows += [(7, rows[1][1]), (7, rows[2][1]), (7, rows[1][1]), (None, rows[0][1]), (900, None), (901, [1.0] * (dim + 1)), (902, []),
             (903, [float("nan")] * dim), (904, [None, *[1.0] * (dim - 1)]), *[(1000 + i, rows[0][1]) for i in range(200)]]
    got = laesa.cluster(table(spark, rows).repartition(5), dim=dim, clusters=k)
    assert found(got) == plain_clusters(rows, dim, k, 3)


def test_clusters_of_few_or_no_vectors(spark):
    assert laesa.cluster(table(spark, []), dim=2).count() == 0
    assert laesa.cluster(table(spark, [(None, [1.0, 2.0])]), dim=2).count() == 0
    same = [(1, [0.5, -0.5]), (2, [0.5, -0.5])]
    assert found(laesa.cluster(table(spark, same), dim=2)) == plain_clusters(same, 2, 16, 3)
    far = [(i, [1e12 * i, 1.0]) for i in range(5)]  # squares beyond 64 bits while they are added up
    assert {r["distance"] for r in laesa.cluster(table(spark, far), dim=2).collect()} == {0}


def test_pivot_bounds_spare_exact_distances():
    """Bounds never cost a nearest centroid, and skip most exact distances where vectors lie in groups."""
    rng = np.random.default_rng(8)
    centres = rng.integers(-300, 300, (16, 64))
    x = (centres[rng.integers(0, 16, 3000)] + rng.integers(-20, 20, (3000, 64))).astype(np.int64)
    pivots = laesa.choose_pivots(x[:200])
    to = lambda a: np.sqrt(np.stack([laesa.squared(a, p).astype(float) for p in pivots], axis=1))
    own, best, exact = laesa.nearest(x, to(x), centres, to(centres))
    full = ((x[:, None, :] - centres[None]) ** 2).sum(axis=2)
    assert (own == full.argmin(axis=1)).all() and (best == full.min(axis=1)).all()
    assert exact < 0.5 * full.size
