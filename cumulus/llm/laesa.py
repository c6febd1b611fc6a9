"""Centroid clustering of integer vectors over a pivot table (LAESA).

A few pivots are chosen once; the distance of every vector to every pivot is
stored beside it.  In each round the driver knows the distance of every
centroid to every pivot as well, and by the triangle inequality
``max |d(vector, pivot) - d(centroid, pivot)|`` bounds the distance of a vector
and a centroid from below.  A vector is first compared with the centroid of
the least bound; only centroids whose bound does not exceed that distance get
an exact squared distance in integers, ties to the smaller number.

Pivots are chosen greedily from the ``SAMPLE`` vectors of least hash: the first
of them, then ever the one with the largest sum of distances to those chosen.
They only decide how much work the bounds save, never a result.

A round sends at most k rows (count and sums per cluster) a partition; k
centroids of dim numbers reach the driver.

Defined cases: a vector that is null, of another length, or holds null or
non-finite components takes no part; rows repeating an id are vectors of their
own; a row with a null id is clustered but is no first centroid; fewer than k
vectors give fewer centroids; without any vector with an id there are no
centroids and no rows; an empty table gives no rows; columns beside id and
vector are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cumulus.llm.common import materialize

DIM, CLUSTERS, ROUNDS, SCALE = 64, 16, 3, 64
PIVOTS, SAMPLE = 8, 512
SAFE = 1 << 27  # components below this have squared distances of 64 dimensions inside 64 bits
SLACK = 1e-9  # relative: far above the rounding of a square root, far below any gain


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances along the last axis; big numbers are added up as Python integers."""
    if max(np.abs(a).max(initial=0), np.abs(b).max(initial=0)) >= SAFE:
        a, b = a.astype(object), b.astype(object)
    away = a - b
    return (away * away).sum(axis=-1)


def choose_pivots(sample: np.ndarray, pivots: int = PIVOTS) -> np.ndarray:
    """Greedy: each pivot has the largest sum of distances to those before it."""
    at = [0]
    total = np.zeros(len(sample))
    while len(at) < min(pivots, len(sample)):
        total += np.sqrt(squared(sample, sample[at[-1]]).astype(float))
        total[at] = -1.0
        at.append(int(np.argmax(total)))
    return sample[at]


def nearest(x: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray, centroid_pivots: np.ndarray):
    """Nearest centroid of each vector, its exact squared distance, and how many exact distances were taken."""
    bound = np.abs(to_pivots[:, None, :] - centroid_pivots[None, :, :]).max(axis=2)
    rows = np.arange(len(x))
    first = bound.argmin(axis=1)
    reach = squared(x, centroids[first])
    survives = bound <= (np.sqrt(reach.astype(float)) * (1 + SLACK) + SLACK)[:, None]
    survives[rows, first] = False
    best, own = reach, first.copy()
    for c in range(len(centroids)):
        some = np.flatnonzero(survives[:, c])
        if not len(some):
            continue
        d = squared(x[some], centroids[c])
        better = (d < best[some]) | ((d == best[some]) & (c < own[some]))
        best[some[better]], own[some[better]] = d[better], c
    return own, best, len(x) + int(survives.sum())


def integer_vectors(vectors: DataFrame, id_col: str, vec_col: str, dim: int) -> DataFrame:
    """(id, x) of the vectors that take part."""
    able = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("c")).where(
        F.coalesce(F.size("c") == dim, F.lit(False))
        & F.forall("c", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))))
    return able.select("id", F.transform("c", lambda e: F.floor(e * SCALE)).cast("array<long>").alias("x"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _with_pivots(pivots: np.ndarray, dim: int):
    def run(batches):
        for b in batches:
            x = _matrix(b.column("x"), dim)
            far = np.sqrt(np.stack([squared(x, p).astype(float) for p in pivots], axis=1))
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("x"),
                 pa.FixedSizeListArray.from_arrays(pa.array(far.ravel()), len(pivots)).cast(pa.list_(pa.float64()))],
                ["id", "x", "pivots"])
    return run


def _step(centroids: np.ndarray, pivots: np.ndarray):
    """Assign the vectors of one batch: (x, cluster, distance)."""
    from_pivots = np.sqrt(np.stack([squared(centroids, p).astype(float) for p in pivots], axis=1))

    def run(b: pa.RecordBatch):
        x = _matrix(b.column("x"), centroids.shape[1])
        own, best, _ = nearest(x, _matrix(b.column("pivots"), len(pivots)), centroids, from_pivots)
        return x, own, best
    return run


def _sums(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> list:
    """(cluster, count, sums) of the non-empty clusters, added up exactly over the partitions."""
    step, k = _step(centroids, pivots), len(centroids)

    def run(batches):
        count, sums = np.zeros(k, np.int64), np.zeros(centroids.shape, object)
        for b in batches:
            x, own, _ = step(b)
            exact = x if np.abs(x).max(initial=0) < SAFE else x.astype(object)
            for c in np.unique(own):
                count[c] += int((own == c).sum())
                sums[c] += exact[own == c].sum(axis=0).astype(object)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array(count[some]),
             pa.array([[int(v) for v in sums[c]] for c in some], pa.list_(pa.decimal128(38, 0)))], ["cluster", "n", "sums"])

    parts = table.mapInArrow(run, "cluster int, n long, sums array<decimal(38,0)>")
    each = parts.select("cluster", "n", F.posexplode("sums").alias("at", "v"))
    total = each.groupBy("cluster", "at").agg(F.sum("v").alias("v"), F.sum("n").alias("n"))
    return total.groupBy("cluster").agg(  # clusters * dim rows
        F.max("n").alias("n"), F.transform(F.sort_array(F.collect_list(F.struct("at", "v"))), lambda s: s["v"]).alias("sums")
    ).collect()


def cluster(vectors: DataFrame, id_col="vec_id", vec_col="embedding", dim: int = DIM, clusters: int = CLUSTERS,
            rounds: int = ROUNDS, pivots: int = PIVOTS, sample: int = SAMPLE, salt: str = "1:") -> DataFrame:
    """Per vector: id, cluster, distance (squared), cluster_inertia, inertia, centroid (its final components)."""
    spark = vectors.sparkSession
    schema = ("id long, cluster int, distance long, cluster_inertia decimal(38,0), inertia decimal(38,0), "
              "centroid array<long>")
    rows = integer_vectors(vectors, id_col, vec_col, dim)
    hashed = rows.where("id IS NOT NULL").withColumn("h", F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256))
    # the vectors of least hash, ties by the vector itself; a bounded number of rows
    low = hashed.orderBy("h", "x").limit(max(clusters, sample)).collect()
    if not low:
        return spark.createDataFrame([], schema).withColumnRenamed("id", id_col)
    points = np.array([r["x"] for r in low], np.int64)
    centroids, chosen = points[:clusters], choose_pivots(points[:sample], pivots)
    table = materialize(rows.mapInArrow(_with_pivots(chosen, dim), "id long, x array<long>, pivots array<double>"), "pivots")
    for _ in range(rounds):
        centroids = centroids.copy()
        for r in _sums(table.select("x", "pivots"), centroids, chosen):
            centroids[r["cluster"]] = [int(s) // r["n"] for s in r["sums"]]
    step = _step(centroids, chosen)

    def assign(batches):
        for b in batches:
            _, own, best = step(b)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(own.astype(np.int32)),
                                              pa.array(best.tolist(), pa.int64())], ["id", "cluster", "distance"])

    assigned = materialize(table.mapInArrow(assign, "id long, cluster int, distance long"), "assigned")
    told = {r["cluster"]: r["s"] for r in assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    final = spark.createDataFrame(
        [(c, told[c], sum(told.values()), centroids[c].tolist()) for c in sorted(told)],
        "cluster int, cluster_inertia decimal(38,0), inertia decimal(38,0), centroid array<long>")
    # at most ``clusters`` rows, so the broadcast is bounded
    return assigned.join(F.broadcast(final), "cluster").select(
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid")
