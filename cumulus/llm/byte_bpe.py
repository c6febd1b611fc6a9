"""Byte-level BPE by a sentencepiece model that is written from a rank file.

The model is serialised directly (protobuf wire format): an unknown piece,
then one piece per rank in rank order, its bytes mapped to one printable
character each, its score the negative rank; kind BPE, identity normalisation,
no dummy prefix, blanks left alone.  sentencepiece merges the best-scored
neighbours first, which is the rank order.  Pre-tokens are cut by the pattern
and encoded one by one; a pre-token that is itself a token keeps its own rank,
as the reference library does.  Decoding maps pieces back to bytes.

Texts whose white space is blanks and line breaks alone are cut into stretches
(white space and what follows up to the next white space) first: no pre-token
crosses a stretch, so stretches are looked up in a bounded cache.

Defined cases: a null or empty text has no tokens; repeated rows are answered
alike, each; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cumulus.llm.common import carried
from cumulus.llm.shingles import slices

CACHE_ENTRIES = 1 << 18
NEW_AT_ONCE = 1 << 14  # new words looked at together
STRETCHES = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
# letters (U+00C0 to U+024F are letters but for two signs), then marks that never start a contraction:
# the pattern cuts such a stretch into these two
PLAIN = re.compile(r"( ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([.,;:!?*$&()]*)")
OTHER_SPACE = re.compile(r"[^\S \n]")
# anything but single blanks and line breaks between words
UNEVEN = "[ \n][ \n]|^[ \n]|[ \n]$|[" + "".join(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n") + "]"


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself if printable Latin-1, else the next of U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value) -> bytes:
    """One protobuf field: an int as varint, a float as 32 bits, bytes with their length."""
    import struct

    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by rank; ranks must be 0, 1, 2 ..."""
    with open(path, "rb") as f:
        pairs = sorted((int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, f))
    assert [r for r, _ in pairs] == list(range(len(pairs))), "ranks have gaps"
    return [t for _, t in pairs]


def model_bytes(tokens: list[bytes]) -> bytes:
    """A sentencepiece model of the tokens; piece ``rank + 1`` is the token of that rank."""
    chars = byte_characters()
    unknown, normal, bpe = 2, 1, 2  # the format's codes of piece and model kinds
    out = [_field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, unknown))]
    for rank, token in enumerate(tokens):
        piece = "".join(chars[b] for b in token).encode()
        out.append(_field(1, _field(1, piece) + _field(2, float(-rank)) + _field(3, normal)))
    trainer = _field(3, bpe) + _field(4, len(tokens) + 1) + _field(40, 0)
    trainer += b"".join(_varint(n << 3) + b"\xff" * 9 + b"\x01" for n in (41, 42, 43))  # no <s>, </s>, <pad>: -1
    normalizer = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(out) + _field(2, trainer) + _field(3, normalizer)


class ByteBpe:
    def __init__(self, path: str, pattern: str):
        import regex
        import sentencepiece

        self.tokens = read_ranks(path)
        self.rank = {t: i for i, t in enumerate(self.tokens)}
        self.split = regex.compile(pattern).findall
        self.chars = {i: c for i, c in enumerate(byte_characters())}
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(self.tokens))
        self.cache: dict[str, tuple[int, str, bytes]] = {}
        self.counts: dict[str, int] = {}

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.rank.get(piece)
        if whole is not None:
            return [whole]
        return [i - 1 for i in self.model.encode(piece.decode("latin-1").translate(self.chars))]

    def encode(self, text: str) -> list[int]:
        return [i for p in self.split(text) for i in self.encode_piece(p.encode())]

    def decode(self, ids) -> bytes:
        return b"".join([self.tokens[i] for i in ids])

    def _entry(self, stretch: str) -> tuple[int, str, bytes]:
        ids = self.encode(stretch)
        entry = len(ids), ",".join(map(str, ids)), self.decode(ids)
        if len(stretch) < 64:  # bounds the cache in bytes too
            if len(self.cache) >= CACHE_ENTRIES:
                self.cache.clear()
            self.cache[stretch] = entry
        return entry

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of tokens, hash of the comma-joined ids, hash of the decoded bytes."""
        n, ids, decoded = 0, hashlib.sha256(), hashlib.sha256()
        get, entry = self.cache.get, self._entry
        parts = [get(s) or entry(s) for s in ([text] if OTHER_SPACE.search(text) else STRETCHES.findall(text))]
        if parts and parts[0][0]:
            counts, csv, raw = zip(*parts, strict=True)
            n = sum(counts)
            ids.update(",".join(csv).encode())
            decoded.update(b"".join(raw))
        return n, ids.hexdigest(), decoded.hexdigest()

    def counts_of(self, texts: pa.Array) -> np.ndarray:
        """Number of tokens of each text (none of them null): every distinct stretch of all texts is counted once."""
        uneven = np.asarray(pc.match_substring_regex(texts, UNEVEN), bool)
        out = np.zeros(len(texts), np.int64)
        out[uneven] = [self.count(t.as_py()) for t in texts.filter(pa.array(uneven))]
        # a line break in front of every line, so that a word with one is the first of its line
        lines = pc.binary_join_element_wise("\n", pc.replace_substring(texts.filter(pa.array(~uneven)), "\n", " \n"), "")
        if len(lines):
            words = pc.split_pattern(lines, " ")
            coded = pc.dictionary_encode(words.flatten())
            each = np.array(self._sizes(coded.dictionary.to_pylist()), np.int64)[np.asarray(coded.indices)]
            first = np.cumsum(np.asarray(words.value_lengths(), np.int64))[:-1]
            out[~uneven] = np.add.reduceat(each, [0, *first]) - len(self.encode("\n"))
        return out

    def count(self, text: str) -> int:
        """Number of tokens of any text."""
        return len(self.encode(text)) if OTHER_SPACE.search(text) else sum(map(len, map(self.encode, STRETCHES.findall(text))))

    def _sizes(self, words: list[str]) -> list[int]:
        """Tokens of each of these distinct words, a blank before it if it does not begin a line."""
        new = [w for w in words if w not in self.counts]
        for at in range(0, len(new), NEW_AT_ONCE):
            self._count_new(new[at:at + NEW_AT_ONCE])
        out = list(map(self.counts.__getitem__, words))
        if len(self.counts) > CACHE_ENTRIES:  # short words of the latest texts stay
            self.counts = {w: n for w, n in zip(words, out, strict=True) if len(w) < 64}
        else:
            for w in new:
                if len(w) >= 64:
                    del self.counts[w]
        return out

    def _count_new(self, new: list[str]) -> None:
        stretches = [w if w[0] == "\n" else " " + w for w in new]
        plain = [PLAIN.fullmatch(s) for s in stretches]
        pieces = [self.split(s) if m is None else m.groups() if m[2] else (s,) for s, m in zip(stretches, plain, strict=True)]
        size = dict.fromkeys(chain.from_iterable(pieces), 1)
        unknown = [p for p in size if p.encode() not in self.rank]  # no tokens themselves
        ids = self.model.encode([p.encode().decode("latin-1").translate(self.chars) for p in unknown], num_threads=1)
        size.update(zip(unknown, map(len, ids), strict=True))
        self.counts.update(zip(new, [size[p[0]] if len(p) == 1 else sum(map(size.__getitem__, p)) for p in pieces], strict=True))


@lru_cache(maxsize=2)
def coder(path: str, pattern: str) -> ByteBpe:
    """One coder per Python worker and vocabulary."""
    return ByteBpe(path, pattern)


OWN = ["n_tokens", "ids_sha256", "decoded_sha256"]


def _rows(docs: DataFrame, text_col: str, own: list[str]):
    keep = carried(docs, [text_col, *own])
    rows = docs.select(F.struct(*[F.col(c) for c in keep] or [F.lit(0).alias("_")]).alias("doc"),
                       F.col(text_col).cast("string").alias("text"))
    return rows, keep, rows.schema["doc"].dataType.simpleString()


def digest_tokens(docs: DataFrame, path: str, pattern: str, text_col="text") -> DataFrame:
    """Columns of ``docs`` but the text, and n_tokens, ids_sha256, decoded_sha256 (replaced if they exist)."""
    rows, keep, kind = _rows(docs, text_col, OWN)

    def run(batches):
        bpe = coder(path, pattern)
        for b in batches:
            out = [bpe.digest(t.as_py() or "") for t in b.column("text")]
            n, ids, decoded = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                ["doc", *OWN])

    got = rows.mapInArrow(run, f"doc {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return got.select(*[F.col("doc")[c].alias(c) for c in keep], *OWN)


def count_tokens(docs: DataFrame, path: str, pattern: str, text_col="text") -> DataFrame:
    """Columns of ``docs`` but the text, and n_tokens (replaced if it exists)."""
    rows, keep, kind = _rows(docs, text_col, ["n_tokens"])

    def run(batches):
        bpe = coder(path, pattern)
        for whole in batches:
            for b in slices(whole, "text"):  # bounds the distinct stretches held at once
                n = bpe.counts_of(pc.fill_null(b.column("text"), ""))
                yield pa.RecordBatch.from_arrays([b.column("doc"), pa.array(n, pa.int64())], ["doc", "n_tokens"])

    got = rows.mapInArrow(run, f"doc {kind}, n_tokens long")
    return got.select(*[F.col("doc")[c].alias(c) for c in keep], "n_tokens")


def encode_texts(docs: DataFrame, path: str, pattern: str, text_col="text") -> DataFrame:
    """Columns of ``docs`` but the text, and token_ids (array of int)."""
    rows, keep, kind = _rows(docs, text_col, ["token_ids"])

    def run(batches):
        bpe = coder(path, pattern)
        for b in batches:
            ids = [bpe.encode(t.as_py() or "") for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("doc"), pa.array(ids, pa.list_(pa.int32()))], ["doc", "token_ids"])

    got = rows.mapInArrow(run, f"doc {kind}, token_ids array<int>")
    return got.select(*[F.col("doc")[c].alias(c) for c in keep], "token_ids")


def decode_tokens(coded: DataFrame, path: str, pattern: str, ids_col="token_ids") -> DataFrame:
    """Columns of ``coded`` but the ids, and decoded (binary): the inverse mapping."""
    keep = carried(coded, [ids_col, "decoded"])
    rows = coded.select(F.struct(*[F.col(c) for c in keep] or [F.lit(0).alias("_")]).alias("doc"),
                        F.col(ids_col).cast("array<int>").alias("ids"))
    kind = rows.schema["doc"].dataType.simpleString()

    def run(batches):
        bpe = coder(path, pattern)
        for b in batches:
            raw = [bpe.decode(i.as_py() or []) for i in b.column("ids")]
            yield pa.RecordBatch.from_arrays([b.column("doc"), pa.array(raw, pa.binary())], ["doc", "decoded"])

    got = rows.mapInArrow(run, f"doc {kind}, decoded binary")
    return got.select(*[F.col("doc")[c].alias(c) for c in keep], "decoded")
