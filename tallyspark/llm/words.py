"""Words and word shingles of many texts at once, as 64-bit hashes over their bytes."""

from __future__ import annotations

import numpy as np

_ODD = 0x9E3779B97F4A7C15
_BYTES = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) ^ (np.arange(1, 257, dtype=np.uint64) << np.uint64(17))
_POWERS = np.array([pow(0xC2B2AE3D27D4EB4F, k, 1 << 64) for k in range(256)], np.uint64)
#: A word is a run of ASCII letters, digits and bytes of characters outside ASCII.
WORD_BYTE = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])


def mix(value: np.ndarray) -> np.ndarray:
    value = value ^ (value >> np.uint64(31))
    value = value * np.uint64(0x7FB5D329728EA185)
    return value ^ (value >> np.uint64(29))


def word_hashes(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the n + 1 offsets of the texts into them. Texts are expected in lower case."""
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(len(ends), np.int64)
    inside = WORD_BYTE[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = ends[:-1][ends[:-1] < len(raw)]
    first[edges] = inside[edges]  # words never cross texts
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(ends), np.int64)
    at = np.arange(len(raw), dtype=np.int64) - np.repeat(np.concatenate(([0], starts)), np.diff(np.concatenate(([0], starts, [len(raw)]))))
    value = _BYTES[raw] * _POWERS[at & 255]
    value[~inside] = 0
    return mix(np.add.reduceat(value, starts)), np.searchsorted(starts, ends)


def shingle_hashes(words: np.ndarray, ends: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` words, and the offsets of the texts into them; a shorter text has one shingle, all its words."""
    counts = np.diff(ends)
    number = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    out_ends = np.concatenate(([0], np.cumsum(number)))
    if not out_ends[-1]:
        return np.zeros(0, np.uint64), out_ends
    factors = [np.uint64(pow(_ODD, 2 * k + 3, 1 << 64)) for k in range(size)]
    padded = np.concatenate((words, np.zeros(size - 1, np.uint64)))
    total = np.zeros(len(words), np.uint64)
    for k, factor in enumerate(factors):
        total += padded[k : k + len(words)] * factor
    # starts of runs that stay inside their text
    left = np.repeat(ends[1:], counts) - np.arange(len(words))
    whole = left >= size
    out = np.zeros(out_ends[-1], np.uint64)
    long_text = np.repeat(counts >= size, number)
    out[long_text] = mix(total[whole])
    for text in np.flatnonzero((counts > 0) & (counts < size)):
        own = words[ends[text] : ends[text + 1]]
        value = sum(int(w) * int(f) for w, f in zip(own, factors)) + 0x5851F42D * len(own)
        out[out_ends[text]] = mix(np.array([value % (1 << 64)], np.uint64))[0]
    return out, out_ends
