"""Word hashes and shingle hashes of many texts at once, in numpy."""

from __future__ import annotations

import numpy as np

ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xA24BAED4963EE407)
    return x ^ (x >> np.uint64(32))


def words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the number of words of each text. Words stand between space, tab to return."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)  # a space ends every text
    if not len(data):
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    starts = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
    if not len(starts):
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    letters = np.flatnonzero(~blank)
    word = np.repeat(np.arange(len(starts)), np.diff(np.append(np.searchsorted(letters, starts), len(letters))))
    place = (letters - starts[word]).astype(np.uint64)
    value = mix((data[letters].astype(np.uint64) + np.uint64(1)) * ODD + place * np.uint64(0xC2B2AE3D27D4EB4F))
    hashes = mix(np.add.reduceat(value, np.searchsorted(letters, starts)))
    ends = np.cumsum(sizes + 1)
    counts = np.diff(np.concatenate([[0], np.searchsorted(starts, ends)]))
    return hashes, counts


def runs(hashes: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words within a text, and their number for each text.

    A text with fewer words, but one at least, has one run: all its words.
    """
    n = len(hashes)
    firsts = np.concatenate([[0], np.cumsum(counts)[:-1]]) if len(counts) else np.empty(0, np.int64)
    out_counts = np.where(counts >= k, counts - k + 1, (counts > 0).astype(np.int64))
    total = int(out_counts.sum())
    at = np.repeat(firsts - np.concatenate([[0], np.cumsum(out_counts)[:-1]]) if len(counts) else firsts, out_counts) + np.arange(total)
    short = np.repeat(counts, out_counts)
    value = np.zeros(total, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            there = short > j
            part = hashes[np.minimum(at + j, n - 1)] if n else np.zeros(total, np.uint64)
            value = np.where(there, mix(value * ODD + part + np.uint64(j + 1)), value)
    return value, out_counts
