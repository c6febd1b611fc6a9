"""Nearest neighbours by cosine over randomly rotated one-bit codes.

Every unit vector is rotated by one random orthogonal matrix and kept as the
signs of its components (one bit each) plus a correction scalar, the inner
product of the rotated vector with its own code.  A rotated query is rounded
to 8 bits a component; its inner product with a code is the weighted number of
common bits of the query's bit planes and the code.  Divided by the correction
scalar this estimates the cosine; the error bound has a random part
(``EPS`` standard deviations) and the query's rounding, which is known.

Work is dealt out as blocks: data rows by hash into blocks of about
``BLOCK_ROWS``, queries into blocks of about ``QUERY_ROWS``, each pair of
blocks a task of bounded memory.  A task ranks a tile of codes by estimate and
computes the exact cosine (double precision, original vectors) only of rows
whose upper bound reaches the query's k-th best exact value so far.  A task
returns at most ``k`` rows a query; the final ranking prunes on the map side.

Defined cases: a vector that is null, empty, zero or holds null or non-finite
components takes no part, nor does a row without vec_id; vectors are compared
with those of the same length only; rows repeating a vec_id count as one, that
of the smallest embedding; ties go to the smaller vec_id; fewer candidates
than k give fewer rows; an empty table gives none.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 5
BLOCK_ROWS = 8192
QUERY_ROWS = 1024
TILE_ROWS = 2048
EPS = 4.0
SEED = 20240601
QUERY_BITS = 8


@lru_cache(maxsize=8)
def rotation(dim: int) -> np.ndarray:
    """A random orthogonal matrix, the same on every machine."""
    q, r = np.linalg.qr(np.random.default_rng(SEED + dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def pack(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words, zero-padded."""
    padded = np.zeros((len(bits), -(-bits.shape[1] // 64) * 64), bool)
    padded[:, : bits.shape[1]] = bits
    return np.packbits(padded, axis=1).view(np.uint64)


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed sign codes and correction scalars of (non-zero) vectors."""
    unit = vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    turned = unit @ rotation(vectors.shape[1]).T
    return pack(turned > 0), np.abs(turned).sum(axis=1) / math.sqrt(vectors.shape[1])


def estimate(turned: np.ndarray, codes: np.ndarray, corr: np.ndarray, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products of one rotated unit query with the coded unit vectors, and their error bounds."""
    low, high = float(turned.min()), float(turned.max())
    step = (high - low) / (2**QUERY_BITS - 1) or 1.0
    level = np.rint((turned - low) / step).astype(np.int64)
    rounded = low + step * level
    ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
    common = np.zeros(len(codes), np.int64)
    for j in range(QUERY_BITS):
        plane = pack(((level >> j) & 1).astype(bool)[None, :])
        common += np.bitwise_count(codes & plane).sum(axis=1, dtype=np.int64) << j
    with_code = (2 * (low * ones + step * common) - rounded.sum()) / math.sqrt(dim)
    spread = np.sqrt(np.maximum(0.0, 1 - corr * corr) / max(1, dim - 1))
    lost = float(np.sqrt(((turned - rounded) ** 2).sum()))
    return with_code / corr, (EPS * spread + lost) / corr


def cosines(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact cosines in double precision; equal vectors get equal values (components are added in order)."""
    dot, norm = (np.add.accumulate(x, axis=1)[:, -1] for x in (vectors * query, vectors * vectors))
    return dot / np.sqrt(norm * np.add.accumulate(query * query)[-1])


def search_block(q_ids, q_vecs, ids, vecs, codes, corr, k: int):
    """Per query, its ``k`` nearest rows of one block: arrays of query id, id, score."""
    dim = vecs.shape[1]
    turned = (q_vecs / np.sqrt((q_vecs * q_vecs).sum(axis=1, keepdims=True))) @ rotation(dim).T
    out = []
    for q in range(len(q_ids)):
        best_ids, best = np.empty(0, np.int64), np.empty(0)
        for at in range(0, len(ids), TILE_ROWS):
            tile = slice(at, at + TILE_ROWS)
            est, err = estimate(turned[q], codes[tile], corr[tile], dim)
            upper = np.where(ids[tile] == q_ids[q], -np.inf, est + err)
            todo = np.isfinite(upper)
            if len(best) < k:  # the most promising rows first: they set the bar for the others
                first = np.argsort(-upper, kind="stable")[: k + 1]
                first = first[todo[first]]
                todo[first] = False
                best_ids, best = _merge(q_vecs[q], best_ids, best, ids[tile], vecs[tile], first, k)
            if len(best) == k:
                todo &= upper >= best[-1] - 1e-12
            best_ids, best = _merge(q_vecs[q], best_ids, best, ids[tile], vecs[tile], np.flatnonzero(todo), k)
        out.append((np.full(len(best), q_ids[q]), best_ids, best))
    return [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.empty(0, np.int64)] * 2 + [np.empty(0)]


def _merge(query, best_ids, best, ids, vecs, rows, k):
    if not len(rows):
        return best_ids, best
    all_ids = np.concatenate([best_ids, ids[rows]])
    score = np.concatenate([best, cosines(query, vecs[rows])])
    order = np.lexsort((all_ids, -score))[:k]
    return all_ids[order], score[order]


def _encode_batches(batches):
    for b in batches:
        ids, vecs = b.column(0), b.column(1)
        lengths = np.asarray(vecs.value_lengths())
        for dim in np.unique(lengths):
            rows = np.flatnonzero(lengths == dim)
            part = vecs.take(pa.array(rows))
            x = part.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), int(dim))
            ok = np.isfinite(x).all(axis=1) & (x * x).sum(axis=1).astype(bool)
            ok &= np.isfinite((x * x).sum(axis=1))
            if ok.any():
                rows, x = rows[ok], x[ok]
                codes, corr = encode(x)
                yield pa.RecordBatch.from_arrays([
                    ids.take(pa.array(rows)), pa.array(np.full(len(x), dim, np.int32)),
                    pa.array([r.tobytes() for r in codes], pa.binary()), pa.array(corr),
                    pa.array([r.tobytes() for r in x], pa.binary())], ["id", "dim", "code", "corr", "vec"])


def encode_table(vectors: DataFrame, id_col="vec_id", vec_col="embedding") -> DataFrame:
    """(id, dim, code, corr, vec) of every row that takes part."""
    rows = (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
            .where(F.col("id").isNotNull() & (F.size("vec") > 0) & ~F.exists("vec", lambda x: x.isNull()))
            .groupBy("id").agg(F.min("vec").alias("vec")))
    return rows.mapInArrow(_encode_batches, "id long, dim int, code binary, corr double, vec binary")


def nearest(vectors: DataFrame, is_query: Column, id_col="vec_id", vec_col="embedding", k: int = K,
            block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """The ``k`` nearest other rows of every row where ``is_query`` (a condition on ``id``):
    query_id, rank (from 1), vec_id, score."""
    coded = encode_table(vectors, id_col, vec_col)
    ids = vectors.select(F.col(id_col).cast("long").alias("id"))
    n, n_q = ids.select(F.count(F.lit(1)), F.count_if(is_query)).first()
    blocks, q_blocks = max(1, -(-n // block_rows)), max(1, -(-n_q // query_rows))
    block = lambda parts, salt: F.pmod(F.xxhash64(F.lit(salt), "id"), F.lit(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    data = coded.withColumn("b", block(blocks, 1)).withColumn("qb", every(q_blocks))
    queries = (coded.where(is_query).select("id", "dim", "vec")
               .withColumn("qb", block(q_blocks, 2)).withColumn("b", every(blocks)))

    def pair(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(asked):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        stack = lambda col, kind: np.frombuffer(b"".join(col), kind).reshape(len(col), -1)
        found = search_block(asked["id"].to_numpy(), stack(asked["vec"], np.float64), rows["id"].to_numpy(),
                             stack(rows["vec"], np.float64), stack(rows["code"], np.uint64),
                             rows["corr"].to_numpy(), k)
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), found, strict=True)))

    near = (data.groupBy("b", "qb", "dim").cogroup(queries.groupBy("b", "qb", "dim"))
            .applyInPandas(pair, "query_id long, vec_id long, score double"))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (near.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))

