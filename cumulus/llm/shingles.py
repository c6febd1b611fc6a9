"""Word shingles of whole Arrow batches as 64-bit hashes, in numpy.

Words are runs outside ``[\\x20\\x09-\\x0D]`` with A-Z lower-cased; shingles are
runs of ``k`` words (a shorter text: all its words as one).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

LONG_WORD = 1024  # longer words are hashed one by one
HASHED_AT_ONCE = 1 << 18  # bytes of words; also bounds the powers that a worker keeps
TEXT_AT_ONCE = 4 << 20
SMALL_TEXT = 1 << 20  # for functions that hold many times the text
_RNG = np.random.default_rng(7)
_BYTE = _RNG.integers(0, 2**64, 256, np.uint64, endpoint=False)
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_POWERS = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, HASHED_AT_ONCE + 1), base, np.uint64)
        steps[0] = 1
        have = _POWERS[base] = np.multiply.accumulate(steps)
    return have[:n]


def word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash per word: a polynomial of random byte values, taken from prefix sums."""
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    out = np.empty(len(words), np.uint64)
    size = np.diff(ends)
    stop = 0
    while stop < len(words):
        at, stop = stop, max(stop + 1, int(np.searchsorted(ends, ends[stop] + HASHED_AT_ONCE, "right")) - 1)
        part = slice(at, stop)
        long = np.flatnonzero(size[part] > LONG_WORD) + at
        cuts = [at, *[x for i in long.tolist() for x in (i, i + 1)], part.stop]
        for a, b in zip(cuts[::2], cuts[1::2], strict=True):  # the stretches between long words
            if a == b:
                continue
            start = ends[a]
            chunk = data[start:ends[b]]
            sums = np.zeros(len(chunk) + 1, np.uint64)
            np.cumsum(_BYTE[chunk] * _powers(_BASE, len(chunk)), out=sums[1:])
            first, last = ends[a:b] - start, ends[a + 1:b + 1] - start
            out[a:b] = (sums[last] - sums[first]) * _powers(_INVERSE, len(chunk) + 1)[first]
        for i in long.tolist():
            out[i] = xxhash.xxh64_intdigest(data[ends[i]:ends[i + 1]].tobytes(), 1)
    return mix(out + size.astype(np.uint64))


def shingle_sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text: (ends, hashes), text i at ends[i]:ends[i + 1]."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), "")))
    counts = np.asarray(lists.value_lengths(), np.int64)
    words = lists.flatten()
    real = np.asarray(pc.greater(pc.binary_length(words), 0))
    if not real.all():  # white space at an end gives an empty word
        text_of = np.repeat(np.arange(len(counts)), counts)
        counts = np.bincount(text_of[real], minlength=len(counts))
        words = words.filter(pa.array(real))
    hashes = word_hashes(words)
    first = np.concatenate([[0], np.cumsum(counts)])
    n_runs = np.where(counts > 0, np.maximum(counts - k + 1, 1), 0)
    text_of = np.repeat(np.arange(len(counts)), n_runs)
    runs_at = np.concatenate([[0], np.cumsum(n_runs)])
    start = first[text_of] + np.arange(len(text_of)) - runs_at[text_of]
    length = np.minimum(counts, k)[text_of]
    acc = length.astype(np.uint64)
    for j in range(k):
        inside = length > j
        step = mix(acc * _BASE + hashes[np.where(inside, start + j, 0)]) if len(hashes) else acc
        acc = step if inside.all() else np.where(inside, step, acc)
    sets, ends = [], [0]
    for i in range(len(counts)):
        one = np.sort(acc[runs_at[i]:runs_at[i + 1]])
        if len(one) > 1:
            one = one[np.concatenate([[True], one[1:] != one[:-1]])]
        sets.append(one)
        ends.append(ends[-1] + len(one))
    return np.array(ends), np.concatenate(sets) if sets else np.empty(0, np.uint64)


def slices(batch: pa.RecordBatch, text_col: str, size: int = TEXT_AT_ONCE):
    """Parts of a batch of about ``size`` bytes of text, so that memory follows neither batch size nor count."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(text_col)), 0), np.int64)
    group = np.cumsum(sizes) // size
    at = 0
    for end in [*(np.flatnonzero(np.diff(group)) + 1).tolist(), len(sizes)]:
        if end > at:
            yield batch.slice(at, end - at)
        at = end
