"""Bottom-k sketches against a Python version over whole documents."""

import random

import xxhash
from pyspark.sql import functions as F

from cumulus.llm import fingerprints as fp
from cumulus.llm.queries import op2_fingerprints
from tests.conftest import SF_SMALL
from tests.llm.conftest import sha

SEED = 42  # Spark's xxhash64


def word_hash(w):
    return xxhash.xxh64_intdigest(w.encode(), SEED)


def shingles(text, k=5):
    words = text.encode().split()
    words = [w.decode() for w in words]
    if not words:
        return set()
    hashes = [word_hash(w) for w in words]
    out = set()
    for i in range(max(len(hashes) - k + 1, 1)):
        h = SEED
        for x in hashes[i:i + k]:
            h = xxhash.xxh64_intdigest(x.to_bytes(8, "little"), h)
        out.add(h - 2**64 if h >= 2**63 else h)
    return out


def sketch(text, k=fp.SKETCH_SIZE):
    return sorted(shingles(text))[:k]


def likeness(a, b, k=fp.SKETCH_SIZE):
    pool = sorted({*a, *b})
    pool = pool if len(a) < k and len(b) < k else pool[:k]
    return len([x for x in pool if x in set(a) and x in set(b)]) / len(pool) if pool else 1.0


def as_text(s):
    return "".join(f"{x % 2**64:016x}" for x in s)


def expected(texts):
    ids = sorted(texts, reverse=True)
    out = {}
    for i, doc in enumerate(ids):
        t, nxt = texts[doc], texts[ids[(i + 1) % len(ids)]]
        take = len(t) // 3
        edited = t[:len(t) - take] + nxt[:take]
        a, b, c = sketch(t), sketch(edited), sketch(nxt)
        out[doc] = (len(t), sha(edited), as_text(a), as_text(b), likeness(a, b), likeness(a, c))
    return out


def rows(df):
    return {r["doc_id"]: tuple(r[c] for c in ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                                              "near_edited", "near_next")) for r in df.collect()}


def test_query_over_whole_documents(spark, texts):
    assert rows(op2_fingerprints(spark, SF_SMALL)) == expected(texts)


def test_estimates_follow_true_resemblance(spark, texts):
    for r in op2_fingerprints(spark, SF_SMALL).collect():
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    rng = random.Random(1)
    words = [f"w{i}" for i in range(3000)]
    for share in (0.2, 0.5, 0.8):
        cut = int(share * 3000)
        other = words[:cut] + [f"x{rng.random()}" for _ in range(3000 - cut)]
        a, b = " ".join(words), " ".join(other)
        true = len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))
        df = spark.createDataFrame([(a, b)], "a string, b string").select(
            fp.sketch(F.col("a")).alias("a"), fp.sketch(F.col("b")).alias("b"))
        got = df.select(fp.resemblance(F.col("a"), F.col("b")), fp.containment(F.col("a"), F.col("b")),
                        fp.distinct_shingles(F.col("a"))).first()
        assert abs(got[0] - true) < 0.15
        assert abs(got[1] - len(shingles(a) & shingles(b)) / len(shingles(a))) < 0.25
        assert abs(got[2] / len(shingles(a)) - 1) < 0.3


def test_null_empty_single_and_tied_rows(spark, make_docs):
    t = {5: "", 3: "one", 2: " \t\n", 1: "a b c d e f g h"}
    assert rows_of(make_docs([(i, x or None) for i, x in t.items()])) == expected(t)
    assert rows_of(make_docs([(7, "only one document here")])) == expected({7: "only one document here"})
    assert rows_of(make_docs([])) == {}
    tied = fp.fingerprint_edits(make_docs([(1, "b b"), (1, "a a"), (None, "c"), (None, None)])).collect()
    assert sorted((r["doc_id"] or -1, r["text"], r["edited"]) for r in tied) == sorted(
        [(1, "a a", "a b"), (1, "b b", "b "), (-1, "", ""), (-1, "c", "c")])


def rows_of(df):
    out = fp.fingerprint_edits(df)
    return rows(out.select(
        "doc_id", F.char_length("text").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        fp.to_text(F.col("sketch")).alias("fingerprint"), fp.to_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        fp.resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        fp.resemblance(F.col("sketch"), F.coalesce("next_sketch", F.array().cast("array<long>"))).alias("near_next")))


def test_merged_sketch_is_that_of_the_union(spark):
    parts = [("x", " ".join(f"w{i}" for i in range(a, a + 200))) for a in range(0, 1000, 150)] + [
        (None, "p q r s t u"), ("y", None)]
    df = spark.createDataFrame(parts, "k string, t string").withColumn("s", fp.sketch(F.col("t"), 16))
    got = {r["k"]: r["s"] for r in fp.merge_sketches(df, ["k"], "s", 16).collect()}
    union = set().union(*(shingles(t) for k, t in parts if k == "x"))
    assert got["x"] == sorted(union)[:16]
    assert got[None] == sorted(shingles("p q r s t u")) and got["y"] == []


def test_plan_has_one_shuffle_of_texts_and_no_python(spark):
    plan = op2_fingerprints(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Python" not in plan and "Arrow" not in plan


def test_fingerprints_of_64_bit_ids(make_docs):
    ids = [h - 2**64 if h >= 2**63 else h for h in (word_hash(f"doc{i}") for i in range(400))]
    t = {d: " ".join(f"w{i}_{j}" for j in range(i % 9 + 3)) for i, d in enumerate(ids)}
    assert rows_of(make_docs(list(t.items()))) == expected(t)
