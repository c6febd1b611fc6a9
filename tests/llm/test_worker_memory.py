"""What a Python worker holds at once follows neither the batch nor the number of distinct words."""

import tracemalloc

import pyarrow as pa
import pytest
import public_tokenizers as P

from cumulus.llm import byte_bpe, langid, minhash, pii, shingles

ROWS = [f"document {i} of many lines, write to a{i}@example.org " * 40 for i in range(4000)]  # some 8 MB


def column_of(batches, name):
    return [x for b in batches for x in b.column(name).to_pylist()]


def test_powers_kept_by_a_worker_are_bounded(monkeypatch):
    words = pa.array([f"some{i}words" for i in range(200_000)] + ["x" * (shingles.LONG_WORD + 1), "", "y" * 500_000, "last"])
    monkeypatch.setattr(shingles, "_POWERS", {})
    got = shingles.word_hashes(words)
    assert all(len(p) <= shingles.HASHED_AT_ONCE + 1 for p in shingles._POWERS.values())
    for at in (0, 1, 99_999, 199_999, 200_000, 200_001, 200_002, 200_003):
        assert shingles.word_hashes(words.slice(at, 1))[0] == got[at]
    assert shingles.word_hashes(pa.array([], pa.string())).tolist() == []


def test_scan_and_signatures_go_through_a_batch_in_slices():
    ids = pa.array(range(len(ROWS)), pa.int64())
    whole = pa.RecordBatch.from_arrays([pa.StructArray.from_arrays([ids], ["doc_id"]), pa.array(ROWS)], ["doc", "text"])
    made = list(pii._scan([whole]))
    assert max(b.num_rows for b in made) < len(ROWS) / 4
    assert [d["doc_id"] for d in column_of(made, "doc")] == list(range(len(ROWS)))
    assert column_of(made, "n_email") == [40] * len(ROWS)
    assert column_of(made, "redacted") == [pii.redact(t, pii.find_spans(t)) for t in ROWS]
    signed = list(minhash._sign(5, 8, 5)([whole.rename_columns(["id", "text"])]))
    assert max(b.num_rows for b in signed) < len(ROWS) / 4


def test_counting_many_new_words_is_bounded():
    bpe = byte_bpe.ByteBpe(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    words = [f"qz{i * 7919:x}.{i}" for i in range(100_000)]
    text = " ".join(words)
    tracemalloc.start()
    n = bpe.counts_of(pa.array([text]))
    kept, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert n[0] == bpe.count(text)
    assert most < kept + 40e6


def test_prediction_sends_a_kept_text_once(make_docs):
    docs = make_docs([(1, "the quick brown fox jumps over the lazy dog"), (2, None), (3, ""), (4, "12 34"),
                      (5, "der schnelle braune Fuchs springt"), (None, "le renard brun saute par-dessus le chien")])
    labelled = docs.selectExpr("doc_id", "text", "CASE doc_id WHEN 1 THEN 'en' WHEN 5 THEN 'de' END AS lang")
    model = langid.fit(labelled, langid.F.lit(True))
    kept = langid.predict(docs, model, keep_text=True)
    into = [f for f in kept._jdf.queryExecution().analyzed().toString().splitlines() if " AS doc#" in f]
    assert len(into) == 1 and " AS text#" not in into[0].split(" AS doc#")[1]
    plain = {(r["doc_id"], r["lang_pred"], r["score"]) for r in langid.predict(docs, model).collect()}
    assert {(r["doc_id"], r["lang_pred"], r["score"]) for r in kept.collect()} == plain and len(plain) == 6
    assert {(r["doc_id"], r["text"]) for r in kept.collect()} == {(r["doc_id"], r["text"]) for r in docs.collect()}


@pytest.mark.parametrize("size", [1, 1 << 10, 1 << 30])
def test_slices_of_any_size_hold_every_row(size):
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 700, None, "", "b" * 5000, "c"])], ["text"])
    parts = list(shingles.slices(batch, "text", size))
    assert column_of(parts, "text") == batch.column("text").to_pylist()
    assert (len(parts) == 1) == (size == 1 << 30)
