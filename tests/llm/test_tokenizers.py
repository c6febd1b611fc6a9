"""Byte-level BPE against tiktoken, token counts against tokenizers."""

import base64

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cumulus.llm import byte_bpe, token_count
from cumulus.llm.queries import VOCABULARY, WORD_VOCABULARY, op6_byte_bpe, op7_token_count
from tests.conftest import SF_SMALL
from tests.llm.conftest import sha

ODD = ["Î\U000323b0 \U000323b0a1", "", " ", "\n", "  a  b\n\n c", "x\t y\t\n z ", "I'll don't 'S 's", "ΑΣ ΣΑΣ σς", "\x1c\x1d a\x85b c d",
       "naïve é ﬁ İstanbul ẞ", "日本語テキスト 123 ４５", "<|endoftext|>a<|startoftext|><|endoftext|>", "a" * 5000,
       "😀👩‍👩‍👧 ok", "▁ Ġ ﻿​", "1234567 ١٢٣ Ⅻ", " " * 300 + "end   ", "the\n\n\nthe", "_a_ %%%&&&"]


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path(VOCABULARY), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def words():
    return Tokenizer.from_file(P.path(WORD_VOCABULARY))


def bpe():
    return byte_bpe.coder(P.path(VOCABULARY), P.PATTERN)


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(reference, words, text):
    ids = reference.encode_ordinary(text)
    assert bpe().encode(text) == ids
    assert bpe().decode(ids) == text.encode()
    assert bpe().digest(text) == (len(ids), sha(",".join(map(str, ids))), sha(text))
    assert token_count.counter(P.path(WORD_VOCABULARY)).count(text) == len(
        words.encode(text, add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t'sstadeΣé<|>")), max_size=60))
def test_any_text(reference, words, text):
    ids = reference.encode_ordinary(text)
    assert bpe().digest(text) == (len(ids), sha(",".join(map(str, ids))), sha(text))
    assert token_count.counter(P.path(WORD_VOCABULARY)).count(text) == len(
        words.encode(text, add_special_tokens=False).ids)


def test_every_vocabulary_token_has_its_rank(reference):
    coder = bpe()
    for rank, token in enumerate(coder.tokens):
        assert coder.encode_piece(token) == [rank] or not _utf8(token)


def _utf8(token):
    try:
        return token.decode()
    except UnicodeDecodeError:
        return ""


def test_queries_over_whole_documents(spark, texts, reference, words):
    got = {r["doc_id"]: r for r in op6_byte_bpe(spark, SF_SMALL).collect()}
    assert set(got) == set(texts)
    for i, t in texts.items():
        ids = reference.encode_ordinary(t)
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == sha(",".join(map(str, ids)))
        assert got[i]["decoded_sha256"] == sha(t)
    counted = {r["doc_id"]: r for r in op7_token_count(spark, SF_SMALL).collect()}
    for i, t in texts.items():
        n = len(words.encode(t, add_special_tokens=False).ids)
        assert (counted[i]["n_bytes"], counted[i]["n_tokens"], counted[i]["over_limit"]) == (len(t.encode()), n, n > 2048)


def test_nulls_repeats_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, None, 7), (None, "a b", 8), (2, "", 9), (2, "", 9)],
                               "doc_id long, text string, n_tokens int")
    path = P.path(VOCABULARY)
    got = byte_bpe.digest_tokens(df, path, P.PATTERN)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted((r["n_tokens"], r["decoded_sha256"]) for r in got.collect()) == sorted(
        [(0, sha(""))] * 3 + [(2, sha("a b"))])
    counted = token_count.count_tokens(df, P.path(WORD_VOCABULARY))
    assert sorted((r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in counted.collect()) == [
        (0, 0, False)] * 3 + [(3, 2, False)]
    assert byte_bpe.digest_tokens(df.limit(0), path, P.PATTERN).count() == 0
    back = byte_bpe.decode_tokens(byte_bpe.encode_texts(df, path, P.PATTERN), path, P.PATTERN)
    assert sorted(bytes(r["decoded"]) for r in back.collect()) == [b"", b"", b"", b"a b"]
