"""Token counts by heap-and-linked-list byte-pair merging, without identifiers.

A word's symbols form a doubly linked list; a heap holds the adjacent pairs
that can merge, by rank, then place.  The lowest is popped; if both symbols
are still what they were, they merge and the two new neighbouring pairs are
pushed.  The count is the number of initial symbols minus the merges.

The vocabulary file (``word_bpe_49k.json``) names the steps before: special
strings count as one token each and cut the text; each part is composed (NFC),
its white space made blanks, lower-cased letter by letter; words are the
matches of the file's pattern; a word's bytes are its symbols, the last one
with the word-end mark.  No pattern match holds white space, so counts of
blank-separated stretches are kept in a bounded cache.

Defined cases: a null or empty text has no tokens; repeated rows are answered
alike, each; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cumulus.llm.byte_bpe import byte_characters
from cumulus.llm.common import carried

LIMIT = 2048
CACHE_ENTRIES = 1 << 18
SEPARATORS = re.compile("[\x1c-\x1f]")  # white space to str.split, not to the pattern


def count_merges(symbols: list, ranks: dict) -> int:
    """Tokens left of ``symbols`` when pairs merge by ``ranks``: (left, right) -> (rank, merged)."""
    n = len(symbols)
    if n < 2:
        return n
    symbols = list(symbols)
    prev, after = list(range(-1, n - 1)), list(range(1, n + 1))
    heap = []
    for i in range(n - 1):
        found = ranks.get((symbols[i], symbols[i + 1]))
        if found:
            heap.append((found[0], i, symbols[i], symbols[i + 1], found[1]))
    heapq.heapify(heap)
    left = n
    while heap:
        _, i, a, b, merged = heapq.heappop(heap)
        j = after[i]
        if symbols[i] != a or j >= n or symbols[j] != b:
            continue  # one of the two has merged since
        symbols[i], symbols[j] = merged, None
        k = after[i] = after[j]
        left -= 1
        if k < n:
            prev[k] = i
            found = ranks.get((merged, symbols[k]))
            if found:
                heapq.heappush(heap, (found[0], i, merged, symbols[k], found[1]))
        h = prev[i]
        if h >= 0:
            found = ranks.get((symbols[h], merged))
            if found:
                heapq.heappush(heap, (found[0], h, symbols[h], merged, found[1]))
    return left


def newer_characters() -> frozenset[str]:
    """Letters and digits of a later Unicode version than the vocabulary's library knows: to it they are neither.

    Only characters that are unassigned to ``unicodedata`` are asked for.
    """
    import regex
    from tokenizers import Regex, pre_tokenizers

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    out = []
    for kind in (r"\p{L}", r"\p{N}"):
        known = pre_tokenizers.Split(Regex(kind), "removed").pre_tokenize_str
        out += [c for c in regex.findall(kind, every)
                if unicodedata.category(c) == "Cn" and known("." + c)[0][0] != "."]
    return frozenset(out)


class TokenCounter:
    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, steps = spec["model"], [s["type"] for s in spec["normalizer"]["normalizers"]]
        cut = spec["pre_tokenizer"]["pretokenizers"]
        if steps != ["NFC", "Replace", "Lowercase"] or [c["type"] for c in cut] != ["Split", "ByteLevel"]:
            raise ValueError(f"{path}: unknown steps before the merges")
        pattern = cut[0]["pattern"]["Regex"]
        self.words = regex.compile(pattern).findall
        self.newer = newer_characters()
        if self.newer:  # the same pattern for words that hold one: it is no letter or digit there
            newer = "".join(map(regex.escape, sorted(self.newer)))
            for kind in (r"\p{L}", r"\p{N}"):
                pattern = pattern.replace(kind, f"[{kind}--[{newer}]]")
            self.words_with_newer = regex.compile(pattern, regex.V1).findall
        self.end = model["end_of_word_suffix"] or ""
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.ranks = {(a, b): (i, a + b) for i, (a, b) in enumerate(merges)}
        self.chars = byte_characters()
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.cache: dict[str, int] = {}

    def word(self, word: str) -> int:
        symbols = [self.chars[b] for b in word.encode()]
        symbols[-1] += self.end
        return count_merges(symbols, self.ranks)

    def _stretch(self, stretch: str) -> int:
        plain = stretch.isascii() or self.newer.isdisjoint(stretch)
        n = sum(map(self.word, (self.words if plain else self.words_with_newer)(stretch)))
        if len(stretch) < 64:
            if len(self.cache) >= CACHE_ENTRIES:
                self.cache.clear()
            self.cache[stretch] = n
        return n

    def count(self, text: str) -> int:
        parts = self.special.split(text) if self.special else [text]
        total, get, fill = len(parts) - 1, self.cache.get, self._stretch
        for part in parts:
            # a capital sigma lower-cases by its neighbours in str.lower, not in a letter-by-letter step
            part = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
            for s in [part] if SEPARATORS.search(part) else part.split():
                n = get(s)
                total += fill(s) if n is None else n
        return total


@lru_cache(maxsize=2)
def counter(path: str) -> TokenCounter:
    """One counter per Python worker and vocabulary."""
    return TokenCounter(path)


OWN = ["n_bytes", "n_tokens", "over_limit"]


def count_tokens(docs: DataFrame, path: str, text_col="text", limit: int = LIMIT) -> DataFrame:
    """Columns of ``docs`` but the text, and n_bytes, n_tokens, over_limit (replaced if they exist)."""
    keep = carried(docs, [text_col, *OWN])
    rows = docs.select(F.struct(*[F.col(c) for c in keep] or [F.lit(0).alias("_")]).alias("doc"),
                       F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc"].dataType.simpleString()

    def run(batches):
        tokens = counter(path)
        for b in batches:
            n = pa.array([tokens.count(t.as_py() or "") for t in b.column("text")], pa.int64())
            size = pc.fill_null(pc.binary_length(b.column("text")), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("doc"), size, n, pc.greater(n, limit)], ["doc", *OWN])

    got = rows.mapInArrow(run, f"doc {kind}, n_bytes long, n_tokens long, over_limit boolean")
    return got.select(*[F.col("doc")[c].alias(c) for c in keep], *OWN)
