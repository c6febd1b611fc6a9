"""Nearest neighbours, language identification and packing."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cumulus.llm import langid, packing, rabitq
from cumulus.llm.byte_bpe import ByteBpe
from cumulus.llm.queries import VOCABULARY, op9_langid, op10_best_fit_packing
from tests.conftest import SF_SMALL

VECS = "vec_id long, embedding array<float>, score int"


def brute(rows, k, is_query):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v
          and np.isfinite(np.array(v, float)).all() and any(v)]
    out = set()
    for q, a in ok:
        if is_query(q):
            found = sorted((-(a @ b) / np.sqrt((a @ a) * (b @ b)), i) for i, b in ok if i != q and len(b) == len(a))[:k]
            out |= {(q, r + 1, i) for r, (_, i) in enumerate(found)}
    return out


@pytest.mark.parametrize("dim,n", [(64, 600), (7, 90), (130, 200)])
def test_nearest_against_brute_force(spark, dim, n):
    rng = np.random.default_rng(dim)
    centres = rng.standard_normal((6, dim))
    rows = [(i, (centres[i % 6] + 0.5 * rng.standard_normal(dim)).astype(np.float32).tolist()) for i in range(n)]
    rows += [(n + i, rows[3][1]) for i in range(8)]  # equal vectors: ties go to the smaller id
    df = spark.createDataFrame([(*r, 1) for r in rows], VECS)
    got = rabitq.nearest(df, F.col("id") % 10 == 0, block_rows=100, query_rows=20)
    assert {(r["query_id"], r["rank"], r["vec_id"]) for r in got.collect()} == brute(rows, 5, lambda q: q % 10 == 0)


def test_codes_bound_the_cosine():
    rng = np.random.default_rng(2)
    x, q = rng.standard_normal((4000, 64)), rng.standard_normal((1, 64))
    codes, corr = rabitq.encode(x)
    assert codes.shape == (4000, 1) and codes.dtype == np.uint64
    unit = q[0] / np.linalg.norm(q)
    est, err = rabitq.estimate(rabitq.rotation(64) @ unit, codes, corr, 64)
    true = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ unit
    assert (np.abs(est - true) <= err).mean() > 0.999 and np.abs(est - true).mean() < 0.1


def test_vectors_that_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, None), (3, [float("nan"), 1.0]), (4, [1.0, None]), (5, []),
            (None, [1.0, 1.0]), (6, [1.0, 1.0]), (6, [1.0, 1.0]), (7, [1.0, 2.0, 3.0]), (10, [float("inf"), 1.0]), (50, [2.0, 0.0])]
    df = spark.createDataFrame([(*r, 1) for r in rows], VECS)
    got = rabitq.nearest(df, F.col("id") % 50 == 0).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 6)) for r in got) == [
        (0, 1, 50, 1.0), (0, 2, 6, 0.707107), (50, 1, 0, 1.0), (50, 2, 6, 0.707107)]
    assert rabitq.nearest(df.limit(0), F.col("id") % 50 == 0).count() == 0


def test_language_accuracy_on_held_out_documents(spark):
    sf = SF_SMALL.replace("0.001", "0.01")
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    got = op9_langid(spark, sf).collect()
    assert {r["doc_id"] for r in got} == set(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"]]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.97


def test_language_of_odd_texts(spark):
    schema = "doc_id long, text string, lang string, lang_pred int"
    train = [(i, t, lang, 0) for i, (t, lang) in enumerate([
        ("the cat and the dog were in the house", "en"), ("der hund und die katze waren im haus", "de"),
        ("le chien et le chat dans la maison", "fr"), ("el perro y el gato en la casa", "es"),
        ("собака и кошка в доме", "ru")] * 6)]
    odd = [(None, None, None, 0), (100, "", "en", 0), (101, "123 !?", "en", 0), (102, "the house and the cat", None, 0),
           (102, "the house and the cat", None, 0), (103, "la maison et le chat " * 100_000, None, 0), (104, "кошка", None, 0)]
    df = spark.createDataFrame(train + odd, schema)
    model = langid.fit(df, F.lit(True))
    got = Counter((r["doc_id"], r["lang_pred"]) for r in langid.predict(df, model).collect() if r["doc_id"] is None or r["doc_id"] >= 100)
    assert got == {(None, "und"): 1, (100, "und"): 1, (101, "und"): 1, (102, "en"): 2, (103, "fr"): 1, (104, "ru"): 1}
    none = langid.fit(df.limit(0), F.lit(True))
    assert {(r["lang_pred"], r["score"]) for r in langid.predict(df, none).collect()} == {("und", 0.0)}
    assert langid.predict(df.limit(0), model).count() == 0


def test_noisy_labels_bound_sample_and_model(spark):
    """More labels than are learned: the most frequent, ties by name; a hot id is learned from once, by its smallest text."""
    rows = [(i, f"text number {i} of its own label", f"l{i:04d}") for i in range(300)]
    rows += [(1000 + i, "the cat and the dog", "en") for i in range(9)] + [(2000 + i, "der hund und die katze", "de") for i in range(9)]
    rows += [(5000, f"the house {i}", "en") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df, F.lit(True), sample_rows=40, languages=4)
    assert model.langs == ["de", "en", "l0000", "l0001"]
    assert len(model.pairs) == 1 and len(model.families) == 3
    many = langid.fit(df, F.lit(True), sample_rows=40, languages=1000)
    assert len(many.langs) == 302


def test_features_do_not_depend_on_chunks(monkeypatch):
    whole = langid.features("the cat — and der Hund! " * 50)
    monkeypatch.setattr(langid, "CHUNK", 17)
    assert np.allclose(whole, langid.features("the cat — and der Hund! " * 50))


def naive(lengths, capacities):
    """Best fit with a scan over all open bins."""
    room, out, used, rest = [], {}, [], sum(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        fits = [b for b in range(len(room)) if room[b] >= lengths[i]]
        if fits:
            tight = min(room[b] for b in fits)
            b = [x for x in fits if room[x] == tight]
            b = max(b, key=lambda x: turn[x])
        else:
            b = len(room)
            size = min((c for c in capacities if c >= lengths[i]), key=lambda c: (packing.cost(c) / min(c, rest), c))
            room.append(size)
            used.append(0)
            if b == 0:
                turn = {}
        out[i] = b
        room[b] -= lengths[i]
        used[b] += lengths[i]
        rest -= lengths[i]
        turn[b] = i if False else len(out)
    return [out[i] for i in range(len(lengths))], used


def test_packing_against_a_plain_version():
    rng = np.random.default_rng(6)
    for _ in range(20):
        lengths = rng.integers(1, 8193, rng.integers(1, 120)).tolist()
        bins, offset, sizes = packing.pack(lengths)
        want, used = naive(lengths, packing.CAPACITIES)
        assert bins == want
        assert sizes == [min(c for c in packing.CAPACITIES if c >= u) for u in used]
        for b in range(len(sizes)):
            spans = sorted((offset[i], lengths[i]) for i in range(len(lengths)) if bins[i] == b)
            assert [s for s, _ in spans] == np.cumsum([0] + [n for _, n in spans[:-1]]).tolist()
    assert packing.pack([]) == ([], [], [])


def token_lengths(texts):
    import public_tokenizers as P

    bpe = ByteBpe(P.path(VOCABULARY), P.PATTERN)
    return {i: len(bpe.encode(t or "")) for i, t in texts.items()}


def packed(rows):
    """Length by document; no bin holds more than its capacity."""
    out, filled, ends = Counter(), Counter(), {}
    for r in rows:
        out[r["doc_id"]] += r["length"]
        if r["bin_id"] is not None:
            filled[r["bin_id"]] += r["length"]
            ends[r["bin_id"]] = r["capacity"]
    assert all(filled[b] <= c for b, c in ends.items())
    return dict(out)


def test_packing_query_over_whole_documents(spark, texts):
    words = token_lengths(texts)
    rows = op10_best_fit_packing(spark, SF_SMALL).collect()
    assert packed(rows) == words
    filled, ends = Counter(), {}
    for r in rows:
        if r["bin_id"] is not None:
            filled[r["bin_id"]] += r["length"]
            ends[r["bin_id"]] = r["capacity"]
    assert {i: sum(r["length"] for r in rows if r["doc_id"] == i) for i in words} == words
    assert all(filled[b] <= c and not any(filled[b] <= x < c for x in packing.CAPACITIES) for b, c in ends.items())
    assert sum(filled.values()) / sum(ends.values()) > 0.9
    for r in rows:
        assert r["start"] == r["piece"] * max(packing.CAPACITIES)


def test_packing_cases(spark, make_docs):
    rows = [(None, "a b"), (1, None), (2, ""), (3, "x " * 20_000), (4, "y"), (4, "y")]
    out = packing.pack_documents(make_docs(rows)).collect()
    assert Counter((r["doc_id"], r["piece"], r["length"], r["capacity"] is None) for r in out) == {
        (None, 0, 2, False): 1, (1, 0, 0, True): 1, (2, 0, 0, True): 1, (3, 0, 8192, False): 1, (3, 1, 8192, False): 1,
        (3, 2, 3616, False): 1, (4, 0, 1, False): 2}
    assert packing.pack_documents(make_docs([])).count() == 0
    many = packing.pack_documents(make_docs([(7, "w " * (i % 50 + 1)) for i in range(400)]), shard_rows=100).collect()
    assert len({r["bin_id"] >> 32 for r in many}) > 1 and len(many) == 400
