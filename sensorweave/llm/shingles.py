"""Hashes of the words and word shingles of whole texts, computed over Arrow buffers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from sensorweave.llm.common import string_buffers

#: Bytes hashed at a time; longer texts go through in parts cut between words.
CHUNK = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2^64
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, up to n."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, CHUNK + 1)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        _powers[:] = [np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, b, np.uint64)]), dtype=np.uint64) for b in (_BASE, inverse)]
    return _powers[0], _powers[1]


def _space(raw: np.ndarray) -> np.ndarray:
    return (raw == 32) | ((raw >= 9) & (raw <= 13))


def _hash_part(raw: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words of ``raw``; a word ends at ``breaks`` too."""
    word = ~_space(raw)
    before = np.empty(len(raw), bool)
    before[0] = False
    before[1:] = word[:-1]
    before[breaks[breaks < len(raw)]] = False
    starts = np.flatnonzero(word & ~before)
    after = np.empty(len(raw), bool)
    after[-1] = False
    after[:-1] = word[1:]
    inner = breaks[(breaks > 0) & (breaks < len(raw))]
    after[inner - 1] = False
    ends = np.flatnonzero(word & ~after) + 1
    power, inverse = _power_tables(len(raw) + 1)
    lowered = raw + (((raw >= 65) & (raw <= 90)) * np.uint8(32))
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((lowered.astype(np.uint64) + np.uint64(1)) * power[: len(raw)], out=total[1:])
    return starts, mix((total[ends] - total[starts]) * inverse[starts] ^ (ends - starts).astype(np.uint64))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ASCII-lower-cased words ``[^\\x20\\x09-\\x0D]+`` of all
    texts in order, and the n + 1 places where the texts' words begin."""
    raw, offsets = string_buffers(texts)
    starts, hashes, at = [], [], 0
    while at < len(raw):
        end = min(at + CHUNK, len(raw))
        while end < len(raw):  # not within a word
            gap = np.flatnonzero(_space(raw[end : end + CHUNK]))
            if len(gap):
                end += int(gap[0])
                break
            end = min(end + CHUNK, len(raw))
        breaks = offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, end, "right")] - at
        s, h = _hash_part(raw[at:end], breaks)
        starts.append(s + at)
        hashes.append(h)
        at = end
    if not starts:
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), offsets)


def shingle_sets(texts: pa.Array, size: int = 5) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its shingles of ``size`` words;
    with fewer words one shingle of them all, without words none."""
    words, bounds = word_hashes(texts)
    n = len(words) - size + 1
    if n > 0:
        windows = np.zeros(n, np.uint64)
        for k in range(size):
            windows = mix(windows + words[k : k + n] + np.uint64(k + 1))
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= size:
            out.append(np.unique(windows[a : b - size + 1]))
        elif b > a:
            whole = np.uint64(0xA5A5A5A5 + b - a) + np.zeros(1, np.uint64)
            for w in words[a:b]:
                whole = mix(whole * _BASE + w)
            out.append(whole)
        else:
            out.append(np.empty(0, np.uint64))
    return out
