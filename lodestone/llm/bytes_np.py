"""Vectorised work on the UTF-8 bytes of whole texts: word bounds, word hashes, shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Words `[^\x20\x09-\x0D]+`.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: Words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` of lower-cased text.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: Lower-cases A-Z only.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS = {}


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(n: int, base: np.uint64 = _BASE) -> np.ndarray:
    """base, base^2, ..."""
    if n > len(_POWERS.get(base, ())):
        _POWERS[base] = np.cumprod(np.full(max(n, 1 << 10), base, np.uint64))
    return _POWERS[base][:n]


def slices(texts: pa.Array, size: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string array into runs of rows of about ``size`` bytes: first row, end row, bytes, offsets from 0. Null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + size, "right")) - 1)
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b


def word_bounds(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and for each row the index of its first word (with one more at the end)."""
    is_word = kind[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate(([False], is_word[:-1])) if len(data) else is_word
    starts = np.flatnonzero(is_word & (~before | edge[:-1]))
    after = np.concatenate((is_word[1:], [False])) if len(data) else is_word
    ends = np.flatnonzero(is_word & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hashes of the words, by differences of one running sum over all bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers(len(data)), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * powers(len(data), _INVERSE)[starts] + (ends - starts).astype(np.uint64))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int = 5) -> list[np.ndarray]:
    """For each row its sorted distinct k-word shingle hashes; fewer words: the whole sequence as one; no words: none."""
    data = LOWER[data]
    starts, ends, first = word_bounds(data, offsets, NOT_SPACE)
    words = word_hashes(data, starts, ends)
    factors = powers(k + 1)
    n = len(words) - k + 1
    grams = np.zeros(0, np.uint64)
    if n > 0:
        grams = np.zeros(n, np.uint64)
        for j in range(k):
            grams += words[j : j + n] * factors[j]
        grams = mix(grams)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= k:
            own = np.sort(grams[a : b - k + 1])
            out.append(own[np.concatenate(([True], own[1:] != own[:-1]))])
        elif b > a:
            own = words[a:b]
            out.append(mix(np.array([(own * factors[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
