"""Language-model scores by deleted interpolation.

P(w | context) is a mixture of the maximum-likelihood estimates of the orders
1 to n and of 1 / (V + 1) for any word (V known words, one class of unknown
ones).  The mixture weights depend on the bucket of the context: the longest
part of it that was seen, and the power of two of its count.  They are learned
by expectation-maximisation on a held-out part of the learned documents (one
in ``TUNE_EVERY`` by id hash), whose counts are deleted from the estimates
meanwhile; scores use the counts of all learned documents.

Counts never travel one by one.  Documents are cut into blocks of about
``BLOCK_TOKENS`` tokens (written once, words as numbers in the block's own
vocabulary).  A block asks for the counts of its distinct n-grams: sorted
64-bit keys, cut into key ranges, difference-coded.  Each key range adds up
what the learned blocks hold and answers every block with counts in the order
asked, so an n-gram, however frequent, travels once a block and direction and
no document id travels at all.  Ranges are made as many as the tokens need
(``RANGE_KEYS`` a range), so a task's memory is bounded: a key has at most one
entry a block.  Different n-grams of equal key share a count: words have 64
bits (among 1e10 words three such pairs are expected), longer n-grams
``LONG_BITS`` (one n-gram in 7,000 among 1e13; none is expected among 1e8).

Tokens are the words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, then one end.

Defined cases: a null or empty text is its end alone; a row with a null id is
scored and never learned from; repeated rows are learned from and scored, each;
without any learned document every probability is 1 (V = 0); an empty table
gives no rows; columns beside id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cumulus.llm.common import materialize
from cumulus.llm.shingles import mix, slices, word_hashes

ORDER = 3
BLOCK_TOKENS = 1 << 20
RANGE_KEYS = 1 << 21
TUNE_EVERY = 32
ROUNDS, STILL = 20, 1e-5  # of expectation-maximisation: at most, and the gain a token (log10) below which it ends
PRIOR = 0.5  # added to the expected count of every estimate a bucket can use: no weight becomes 0
SCORED, LEARNED, TUNING = 0, 1, 2  # what a block's documents are for
LONG_BITS = 56
LEVEL = 64  # buckets of one context length
_STEP = np.uint64(0x9E3779B97F4A7C15)
_END, _START = word_hashes(pa.array(["\n"])), word_hashes(pa.array(["\t"]))  # no word holds white space


def pack(numbers: np.ndarray) -> bytes:
    """Integers as compressed byte planes: high bytes that are mostly 0 cost nothing."""
    planes = np.ascontiguousarray(numbers).view(np.uint8).reshape(-1, numbers.itemsize).T
    return zstandard.compress(planes.tobytes(), 1)


def unpack(data: bytes, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)


def token_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts, the end of each included, and the number of tokens of each text."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), "")))
    counts = np.asarray(lists.value_lengths(), np.int64)
    words = lists.flatten()
    real = np.asarray(pc.greater(pc.binary_length(words), 0), bool)  # white space at an end gives an empty word
    counts = np.bincount(np.repeat(np.arange(len(counts)), counts)[real], minlength=len(counts)) + 1
    out = np.full(counts.sum(), _END[0])
    is_word = np.ones(len(out), bool)
    is_word[np.cumsum(counts) - 1] = False
    out[is_word] = word_hashes(words.filter(pa.array(real)))
    return out, counts


def gram_keys(tokens: np.ndarray, counts: np.ndarray, order: int) -> Iterator[np.ndarray]:
    """Order by order, the key of the n-gram that ends at each token; before a text there are start marks."""
    first = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
    whole, start = tokens, _START
    yield tokens
    for n in range(2, order + 1):
        before = np.empty_like(tokens)
        before[1:] = whole[:-1]
        before[first] = start[0]
        whole = mix(before * _STEP + tokens + np.uint64(n))
        yield whole >> np.uint64(64 - LONG_BITS)
        start = mix(start * _STEP + _START + np.uint64(n))


def _block_row(number, role, ids, hashes, counts):
    tokens, counts = np.concatenate(hashes), np.concatenate(counts)
    words, at, often = np.unique(tokens, return_inverse=True, return_counts=True)
    by_use = np.argsort(-often, kind="stable")  # small numbers for frequent words
    place = np.empty(len(words), np.int32)
    place[by_use] = np.arange(len(words), dtype=np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array([number], pa.int64()), pa.array([role], pa.int32()), pa.array([len(tokens)], pa.int64()),
         pa.array([pa.concat_arrays(ids).to_pylist()], pa.list_(pa.int64())), pa.array([pack(counts)], pa.binary()),
         pa.array([pack(words[by_use])], pa.binary()), pa.array([pack(place[at])], pa.binary())],
        ["block", "role", "tokens", "ids", "counts", "words", "sequence"])


def _blocks(block_tokens: int):
    def run(batches):
        made = TaskContext.get().partitionId() << 32
        open_ = {role: ([], [], [], 0) for role in (SCORED, LEARNED, TUNING)}
        for whole in batches:
            for batch in slices(whole, "text"):
                for role in open_:
                    part = batch.filter(pc.equal(batch.column("role"), role))
                    if not part.num_rows:
                        continue
                    tokens, counts = token_hashes(part.column("text"))
                    ids, hashes, sizes, n = open_[role]
                    ids.append(part.column("id"))
                    hashes.append(tokens)
                    sizes.append(counts)
                    open_[role] = ids, hashes, sizes, n + len(tokens)
                    if n + len(tokens) >= block_tokens:
                        yield _block_row(made, role, ids, hashes, sizes)
                        made, open_[role] = made + 1, ([], [], [], 0)
        for role, (ids, hashes, sizes, n) in open_.items():
            if n:
                yield _block_row(made, role, ids, hashes, sizes)
                made += 1
    return run


def _tokens_of(row: dict) -> tuple[np.ndarray, np.ndarray]:
    return unpack(row["words"], np.uint64)[unpack(row["sequence"], np.int32)], unpack(row["counts"], np.int64)


def _asked(order: int, parts: int):
    """A block's questions: per order and key range its distinct keys and how often it holds them."""
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                tokens, counts = _tokens_of(row)
                for n, of_token in enumerate(gram_keys(tokens, counts, order), 1):
                    keys, often = np.unique(of_token, return_counts=True)
                    bits = 64 if n == 1 else LONG_BITS
                    bounds = np.array([(i << bits) // parts for i in range(1, parts)], np.uint64)
                    cuts = [0, *np.searchsorted(keys, bounds).tolist(), len(keys)]
                    some = [(i, a, b) for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if a < b]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([n] * len(some), pa.int32()), pa.array([i for i, _, _ in some], pa.int32()),
                         pa.array([row["block"]] * len(some), pa.int64()),
                         pa.array([row["role"]] * len(some), pa.int32()),
                         pa.array([pack_sorted(keys[a:b]) for _, a, b in some], pa.binary()),
                         pa.array([pack(often[a:b]) for _, a, b in some], pa.binary())],
                        ["n", "part", "block", "role", "keys", "often"])
    return run


def _answer(rows: pa.Table) -> pa.Table:
    """Counts of one key range: per block in the order asked, over all learned documents (``total``) and over those
    not held out for tuning (``kept``, for tuning blocks); one row without a block tells how many keys are learned."""
    block, role = rows["block"].to_pylist(), rows["role"].to_pylist()
    keys = [unpack_sorted(k) for k in rows["keys"].to_pylist()]
    often = [unpack(o, np.int64) for o in rows["often"].to_pylist()]
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    sums = {}
    for which in (LEARNED, TUNING):
        weights = np.concatenate([o if r == which else np.zeros(len(o), np.int64) for o, r in zip(often, role, strict=True)])
        sums[which] = np.zeros(len(distinct), np.int64)
        np.add.at(sums[which], at, weights)
    kept, total = sums[LEARNED], sums[LEARNED] + sums[TUNING]
    ends = np.cumsum([0, *map(len, keys)])
    mine = [at[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
    n, part = rows["n"][0].as_py(), rows["part"][0].as_py()
    size = len(block) + 1
    return pa.table({
        "n": pa.array([n] * size, pa.int32()), "part": pa.array([part] * size, pa.int32()),
        "block": pa.array([*block, None], pa.int64()),
        "total": pa.array([*[pack(total[m]) for m in mine], None], pa.binary()),
        "kept": pa.array([*[pack(kept[m]) if r == TUNING else None for m, r in zip(mine, role, strict=True)], None],
                         pa.binary()),
        "known_total": pa.array([None] * len(block) + [int((total > 0).sum())], pa.int64()),
        "known_kept": pa.array([None] * len(block) + [int((kept > 0).sum())], pa.int64())})


_ANSWER = "n int, part int, block long, total binary, kept binary, known_total long, known_kept long"


def _estimates(row: dict, answers: list[dict], which: str, order: int, size: int, texts: int):
    """Per token of a block: bucket, estimates by order (row 0: order 1) and the count of the token itself.

    ``size`` and ``texts``: learned tokens and documents, of all or of those kept.  A context's count is the count of
    the n-gram that ends before the token; that of start marks is the number of documents.
    """
    tokens, counts = _tokens_of(row)
    first = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
    told = {}
    for a in sorted(answers, key=lambda a: (a["n"], a["part"])):
        told.setdefault(a["n"], []).append(unpack(a[which], np.int64))
    bucket = np.full(len(tokens), LEVEL if size else 0, np.int64)
    before = np.full(len(tokens), size, np.int64)
    shares, own = [], None
    for n, keys in enumerate(gram_keys(tokens, counts, order), 1):
        count = np.concatenate(told[n])[np.unique(keys, return_inverse=True)[1]]
        own = count if own is None else own
        seen = before > 0
        shares.append(np.divide(count, before, out=np.zeros(len(tokens)), where=seen))
        if n > 1:
            bucket[seen] = n * LEVEL + np.frexp(before[seen].astype(float))[1] - 1
        before = np.concatenate([[0], count[:-1]])
        before[first] = texts
    return bucket, np.array(shares), own, counts, first


def _weights(expected: dict[int, list[float]], order: int) -> dict[int, list[float]]:
    """Weights of a bucket from expected counts; a bucket of contexts of length n - 1 can use the orders up to n."""
    out = {}
    for bucket, counts in expected.items():
        rough = [c + PRIOR for c in counts[:bucket // LEVEL + 1]]
        out[bucket] = [c / sum(rough) for c in rough] + [0.0] * (order + 1 - len(rough))
    return out


def weights_of(weights: dict[int, list[float]], bucket: int, order: int) -> list[float]:
    """A bucket without held-out tokens takes the weights of the nearest smaller, then larger, count of its length."""
    known = [b for b in weights if b // LEVEL == bucket // LEVEL]
    if known:
        return weights[min(known, key=lambda b: (b > bucket, abs(b - bucket)))]
    return _weights({bucket: [0.0] * (order + 1)}, order)[bucket]


def learn_weights(tuning: DataFrame, order: int, rounds: int = ROUNDS) -> dict[int, list[float]]:
    """Expectation-maximisation over (bucket, p0 to p<order>, times); only sums by bucket reach the driver."""
    buckets = [r["bucket"] for r in tuning.select("bucket").distinct().collect()]  # at most (order + 1) * LEVEL
    if not buckets:
        return {}
    now = _weights({b: [0.0] * (order + 1) for b in buckets}, order)
    last = None
    for _ in range(rounds):
        table = F.create_map(*[x for b in buckets for x in (F.lit(b), F.array(*map(F.lit, now[b])))])
        held = tuning.withColumn("w", table[F.col("bucket")])
        parts = [F.get("w", F.lit(j)) * F.col(f"p{j}") for j in range(order + 1)]
        whole = parts[0]
        for p in parts[1:]:
            whole = whole + p
        held = held.select("bucket", "times", whole.alias("p"), *[p.alias(f"x{j}") for j, p in enumerate(parts)])
        got = held.groupBy("bucket").agg(
            *[F.sum(F.col("times") * F.col(f"x{j}") / F.col("p")).alias(f"x{j}") for j in range(order + 1)],
            F.sum(F.col("times") * F.log10("p")).alias("fit"), F.sum("times").alias("times")).collect()
        now = _weights({r["bucket"]: [r[f"x{j}"] for j in range(order + 1)] for r in got}, order)
        fit = sum(r["fit"] for r in got) / sum(r["times"] for r in got)
        if last is not None and fit - last < STILL:
            break
        last = fit
    return now


def score_documents(docs: DataFrame, learn: Column, id_col="doc_id", text_col="text", order: int = ORDER,
                    block_tokens: int = BLOCK_TOKENS, range_keys: int = RANGE_KEYS) -> DataFrame:
    """Per row: id, n_tokens, n_known, train_tokens, base_score (add-one unigram), score (log10 probability).

    ``learn``: a condition on ``id``, the documents that are counted; null is false.
    """
    named = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    learned = F.col("id").isNotNull() & F.coalesce(learn, F.lit(False))
    tuning = F.pmod(F.xxhash64(F.lit("tune"), "id"), F.lit(TUNE_EVERY)) == 0
    role = F.when(~learned, SCORED).when(tuning, TUNING).otherwise(LEARNED)
    blocks = materialize(
        named.select("id", "text", role.alias("role")).mapInArrow(
            _blocks(block_tokens),
            "block long, role int, tokens long, ids array<long>, counts binary, words binary, sequence binary"), "blocks")
    of_role = {r["role"]: r for r in blocks.groupBy("role").agg(
        F.sum("tokens").alias("tokens"), F.sum(F.size("ids")).alias("texts")).collect()}
    size = {r: of_role[r]["tokens"] if r in of_role else 0 for r in (SCORED, LEARNED, TUNING)}
    texts = {r: of_role[r]["texts"] if r in of_role else 0 for r in (SCORED, LEARNED, TUNING)}
    parts = max(1, -(-sum(size.values()) // range_keys))
    asked = blocks.select("block", "role", "counts", "words", "sequence").mapInArrow(
        _asked(order, parts),
        "n int, part int, block long, role int, keys binary, often binary")
    answers = materialize(asked.groupBy("n", "part").applyInArrow(_answer, _ANSWER), "answers")
    known = answers.where("block IS NULL AND n = 1").agg(
        F.coalesce(F.sum("known_total"), F.lit(0)).alias("total"), F.coalesce(F.sum("known_kept"), F.lit(0)).alias("kept")).first()
    told = answers.where("block IS NOT NULL").select("block", "n", "part", "total", "kept")
    columns = ["block", "role", "ids", "counts", "words", "sequence"]

    def tune(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        bucket, shares, _, _, _ = _estimates(row, right.to_pylist(), "kept", order, size[LEARNED], texts[LEARNED])
        rows, times = np.unique(np.vstack([bucket, shares]), axis=1, return_counts=True)
        made = {"bucket": pa.array(rows[0].astype(np.int32)), "p0": pa.array(np.full(len(times), 1 / (known["kept"] + 1)))}
        made |= {f"p{n}": pa.array(rows[n]) for n in range(1, order + 1)}
        return pa.table(made | {"times": pa.array(times.astype(np.int64))})

    schema = "bucket int, " + ", ".join(f"p{n} double" for n in range(order + 1)) + ", times long"
    tuned = (blocks.where(F.col("role") == TUNING).select(*columns).groupBy("block")
             .cogroup(told.where("kept IS NOT NULL").groupBy("block")).applyInArrow(tune, schema))
    weights = learn_weights(materialize(tuned, "tuning"), order)
    train_tokens, train_texts, n_words = size[LEARNED] + size[TUNING], texts[LEARNED] + texts[TUNING], known["total"]

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        bucket, shares, own, counts, first = _estimates(
            row, right.drop_columns(["kept"]).to_pylist(), "total", order, train_tokens, train_texts)
        buckets, at = np.unique(bucket, return_inverse=True)
        w = np.array([weights_of(weights, int(b), order) for b in buckets])
        p = w[at, 0] / (n_words + 1)
        for n in range(order):
            p += w[at, n + 1] * shares[n]
        base = np.log10((own + 1) / (train_tokens + n_words + 1))
        return pa.table({
            "id": pa.array(row["ids"], pa.int64()), "n_tokens": pa.array(counts),
            "n_known": pa.array(np.add.reduceat((own > 0).astype(np.int64), first)),
            "train_tokens": pa.array(np.full(len(counts), train_tokens, np.int64)),
            "base_score": pa.array(np.add.reduceat(base, first)), "score": pa.array(np.add.reduceat(np.log10(p), first))})

    got = blocks.select(*columns).groupBy("block").cogroup(told.groupBy("block")).applyInArrow(
        score, "id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return got.withColumnRenamed("id", id_col)
