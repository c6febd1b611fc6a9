"""Language-model scores against a plain version."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cumulus.llm import interpolated_lm as lm
from cumulus.llm.queries import op11_deleted_interpolation
from tests.conftest import SF_SMALL

END = None


def tokens_of(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), END]


def grams(tokens, n):
    padded = [*["\t"] * (n - 1), *tokens]
    return [tuple(padded[i:i + n]) for i in range(len(tokens))]


def counted(texts, order):
    count = [Counter() for _ in range(order + 1)]
    for t in texts:
        for n in range(1, order + 1):
            count[n].update(grams(tokens_of(t), n))
    return count, len(texts)


def parts_of(tokens, counts, order):
    """Per token: bucket and estimates, straight from the definition."""
    count, texts = counts
    total = sum(count[1].values())
    out, all_ = [], [grams(tokens, n) for n in range(order + 1)]
    for i in range(len(tokens)):
        bucket, p = (64, [1 / (len(count[1]) + 1)]) if total else (0, [1.0])
        for n in range(1, order + 1):
            gram = all_[n][i]
            before = total if n == 1 else texts if set(gram[:-1]) == {"\t"} else count[n - 1][gram[:-1]]
            if before and n > 1:
                bucket = 64 * n + int(math.log2(before))
            p.append(count[n][gram] / before if before else 0.0)
        out.append((bucket, p))
    return out


def brute(rows, learned, tuning, order):
    """(n_tokens, n_known, train_tokens, base_score, score) of every row."""
    kept = counted([t for i, t in rows if i in learned and i not in tuning], order)
    able = lambda b: b // 64 + 1
    start = {}
    held = [x for i, t in rows if i in tuning for x in parts_of(tokens_of(t), kept, order)]
    now = {b: [1 / able(b)] * able(b) for b, _ in held}
    last = None
    for _ in range(lm.ROUNDS if held else 0):
        expected, fit = {b: [lm.PRIOR] * able(b) for b in now}, 0.0
        for b, p in held:
            shares = [w * x for w, x in zip(now[b], p, strict=False)]
            fit += math.log10(sum(shares)) / len(held)
            for j, s in enumerate(shares):
                expected[b][j] += s / sum(shares)
        now = {b: [e / sum(es) for e in es] for b, es in expected.items()}
        if last is not None and fit - last < lm.STILL:
            break
        last = fit
    every = counted([t for i, t in rows if i in learned], order)
    v, size = len(every[0][1]), sum(every[0][1].values())
    out = []
    for i, t in rows:
        words, score = tokens_of(t), 0.0
        for b, p in parts_of(words, every, order):
            same = [x for x in now if x // 64 == b // 64]
            w = now[min(same, key=lambda x: (x > b, abs(x - b)))] if same else start.setdefault(b, [1 / able(b)] * able(b))
            score += math.log10(sum(a * x for a, x in zip(w, p, strict=False)))
        own = [every[0][1][w,] for w in words]
        out.append((i, len(words), sum(c > 0 for c in own), size,
                    sum(math.log10((c + 1) / (size + v + 1)) for c in own), score))
    return out


def rows_of(df):
    return [(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in df.collect()]


def same(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[5])
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    assert np.allclose([r[4:] for r in got], [r[4:] for r in want], rtol=1e-9, atol=1e-9)


def tuning_ids(spark, ids):
    if not ids:
        return set()
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    return {r["id"] for r in df.where(F.pmod(F.xxhash64(F.lit("tune"), "id"), F.lit(lm.TUNE_EVERY)) == 0).collect()}


def held(i):
    return zlib.crc32(str(i).encode()) % 7 == 2


def test_query_over_whole_documents(spark, texts):
    got = op11_deleted_interpolation(spark, SF_SMALL).collect()
    learned = {i for i in texts if not held(i)}
    assert {r["doc_id"]: r["held_out"] for r in got} == {i: held(i) for i in texts}
    want = brute(list(texts.items()), learned, tuning_ids(spark, learned), lm.ORDER)
    same([(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in got], want)
    of = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in of) > sum(r["base_score"] for r in of)


@pytest.mark.parametrize("order,block_tokens,range_keys", [(1, 50, 400), (2, 200, 300), (4, 1, 1000), (3, 10**6, 200)])
def test_any_order_and_block_size(spark, make_docs, order, block_tokens, range_keys):
    rng = np.random.default_rng(order)
    rows = [(i, " ".join(f"W{w}" for w in rng.zipf(1.4, rng.integers(0, 40)) % 50)) for i in range(160)]
    rows += [(500, None), (501, ""), (502, " \t\n"), (None, "w1 w2 w3"), (3, rows[3][1]), (3, rows[3][1]), (503, "new words only"),
             (504, "É é w1\x1fw2 \x0bw3"), (505, "w1 w2 " * 3000)]
    learned = {i for i, _ in rows if i is not None and i % 3}
    got = lm.score_documents(make_docs(rows).withColumn("score", F.lit("clash")), F.col("id") % 3 != 0, order=order,
                             block_tokens=block_tokens, range_keys=range_keys)
    assert got.columns == ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    same(rows_of(got), brute(rows, learned, tuning_ids(spark, learned), order))


def test_nothing_learned_and_empty_tables(make_docs):
    docs = make_docs([(1, "a b"), (2, None)])
    assert sorted(rows_of(lm.score_documents(docs, F.lit(None)))) == [(1, 3, 0, 0, 0.0, 0.0), (2, 1, 0, 0, 0.0, 0.0)]
    assert lm.score_documents(docs.limit(0), F.lit(True)).count() == 0


def test_number_coding():
    rng = np.random.default_rng(1)
    for a in (rng.integers(0, 2**63, 1000), np.arange(5), np.zeros(0, np.int64)):
        assert (lm.unpack(lm.pack(a), np.int64) == a).all()
        keys = np.sort(a.astype(np.uint64) * np.uint64(2))
        assert (lm.unpack_sorted(lm.pack_sorted(keys)) == keys).all()
    assert lm.weights_of({64 * 2 + 5: [0.2, 0.3, 0.5]}, 64 * 2 + 3, 2) == [0.2, 0.3, 0.5]
    assert lm.weights_of({}, 64 * 2 + 3, 3) == [1 / 3, 1 / 3, 1 / 3, 0.0]
