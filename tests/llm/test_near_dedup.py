"""Near-duplicates against brute force, components, shingle hashing."""

import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from cumulus.llm import minhash
from cumulus.llm import components
from cumulus.llm.common import materialize
from cumulus.llm.components import connected_components
from cumulus.llm.shingles import LONG_WORD, shingle_sets, slices


def word_sets(text, k):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + k]) for i in range(max(len(words) - k + 1, 1))} if words else set()


def brute(rows, k, percent):
    sets = {i: word_sets(t, k) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                ra, rb = root(a), root(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def got(df, k, percent):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"])
            for r in minhash.near_duplicates(df, words=k, percent=percent).collect()}


def planted(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows, n = [], 0
    for size in (1, 2, 3, 4, 7, 12, 30, 80, 200):
        base = rng.choices(words, k=size)
        rows += [(n, " ".join(base)), (n + 1, " \n".join(base).upper())]
        n += 2
        chain = list(base)
        for _ in range(6):  # copies of copies: far ends are not linked directly
            chain[rng.randrange(size)] = rng.choice(words)
            rows.append((n, " ".join(chain)))
            n += 1
        for _ in range(6):  # copies of one text, each near to it, not all to each other
            copy = list(base)
            for _ in range(max(1, size // 40)):
                copy[rng.randrange(size)] = rng.choice(words)
            rows.append((n, " ".join(copy)))
            n += 1
    rng.shuffle(rows)
    ids = rng.sample(range(10_000), len(rows))
    return [(i, t) for i, (_, t) in zip(ids, rows)] + [(20_000, None), (20_001, ""), (20_002, " \t\n"), (20_003, "")]


def test_planted_groups_both_settings(make_docs):
    for seed, k, percent in ((1, 3, 85), (2, 5, 80)):
        rows = planted(seed)
        assert got(make_docs(rows), k, percent) == brute(rows, k, percent)


def test_star_group_whose_centre_is_not_the_smallest(make_docs):
    rng = random.Random(3)
    base = [f"b{i}" for i in range(200)]
    rows = [(500, " ".join(base))]
    for i in range(60):
        copy = list(base)
        for at in rng.sample(range(200), 5):
            copy[at] = f"x{i}_{at}"
        rows.append((i, " ".join(copy)))
    want = brute(rows, 3, 85)
    assert got(make_docs(rows), 3, 85) == want and want[500][1] == 0


def test_null_ids_repeats_and_empty_tables(make_docs):
    assert got(make_docs([]), 3, 85) == {}
    rows = minhash.near_duplicates(make_docs([(None, "a b c d"), (1, "a b c d"), (2, "a b c d"), (2, "a b c d")]),
                                   3, 85).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"], r["kept"]) for r in rows if r["doc_id"]) == [
        (1, 1, True), (2, 1, False), (2, 1, False)]
    assert [(r["component_id"], r["kept"]) for r in rows if r["doc_id"] is None] == [(None, True)]


def test_components_of_chains_and_hubs(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(40)] + [(1000, i) for i in range(900, 1000)] + [(5000, 5000 - i) for i in range(1, 5)]
    rng.shuffle(edges)
    edges = [e if rng.random() < 0.5 else e[::-1] for e in edges] * 2 + [(7, 7)]
    out = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert out == {**{i: 0 for i in range(41)}, **{i: 900 for i in range(900, 1001)}, **{i: 4996 for i in range(4996, 5001)}}


def test_stars_are_written_once(spark, monkeypatch):
    written = []
    monkeypatch.setattr(components, "materialize", lambda df, name: written.append(name) or materialize(df, name))
    stars = [(3, 1), (1, 2), (2, 1), (20, 10), (10, 30), (5, 5)]
    out = {tuple(r) for r in connected_components(spark.createDataFrame(stars, "a long, b long")).collect()}
    assert out == {(1, 1), (2, 1), (3, 1), (10, 10), (20, 10), (30, 10)} and len(written) == 1
    chain = spark.createDataFrame([(1, 2), (2, 3), (4, 3)], "a long, b long")
    assert {tuple(r) for r in connected_components(chain).collect()} == {(i, 1) for i in range(1, 5)} and len(written) > 2


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from("aAbé \t\n\x0b\f\r\x1c\xa0"), max_size=25)), max_size=8),
       st.integers(1, 5))
def test_shingle_sets_have_the_size_of_word_sets(texts, k):
    ends, hashes = shingle_sets(pa.array(texts, pa.string()), k)
    sets = [set(hashes[a:b].tolist()) for a, b in zip(ends[:-1], ends[1:])]
    words = [word_sets(t, k) for t in texts]
    assert [len(s) for s in sets] == [len(w) for w in words] == np.diff(ends).tolist()
    for a, x in zip(sets, words):
        for b, y in zip(sets, words):
            assert len(a & b) == len(x & y)


def test_long_words_and_slices():
    long = "a" * (LONG_WORD + 5)
    texts = pa.array([f"x {long} y", f"{long} y", long, "x " * 100_000, None])
    ends, hashes = shingle_sets(texts, 2)
    assert np.diff(ends).tolist() == [2, 1, 1, 1, 0]
    assert set(hashes[2:3].tolist()) <= set(hashes[:2].tolist())
    one = pa.RecordBatch.from_arrays([pa.array(["ab" * 3_000_000, "c", None, "d" * 5_000_000, "e"])], ["text"])
    assert [b.num_rows for b in slices(one, "text")] and sum(b.num_rows for b in slices(one, "text")) == 5


def test_signature_agreement_estimates_similarity():
    rng = np.random.default_rng(1)
    common = rng.integers(0, 2**64, 800, np.uint64)
    sets = [np.sort(np.concatenate([common, rng.integers(0, 2**64, 100, np.uint64)])) for _ in range(2)]
    sig = minhash.signatures(np.array([0, 900, 1800]), np.concatenate(sets), 1000)
    assert abs((sig[0] == sig[1]).mean() - 0.8) < 0.06
    small = [common[:1], common[:7], common[:7]]
    sig = minhash.signatures(np.array([0, 1, 8, 15]), np.concatenate([np.sort(s) for s in small]), 200)
    assert (sig[1] == sig[2]).all() and (sig[0] == common[0]).all() and (sig != 0).all()


def test_an_id_on_two_texts_is_one_document(make_docs):
    a, b = [f"a{i}" for i in range(60)], [f"b{i}" for i in range(60)]
    near = lambda words, i: " ".join([*words[:-1], f"x{i}"])
    rows = [(5, " ".join(a)), (5, " ".join(b)), (5, " ".join(b)), (3, near(a, 1)), (9, near(b, 2)), (7, near(b, 3)),
            (8, "another text of its own"), (8, "and its other one"), (10, "quite alone"),
            (9, ""), (11, None)]
    got = minhash.near_duplicates(make_docs(rows), 3, 85).collect()
    assert {(r["doc_id"], r["component_id"], r["kept"]) for r in got} == {
        (3, 3, True), (5, 3, False), (9, 3, False), (7, 3, False), (8, 8, True), (10, 10, True), (11, 11, True)}
    assert len(got) == len(rows)
