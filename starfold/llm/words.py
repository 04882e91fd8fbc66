"""Words of texts as bytes, and hashes of words and word windows, for use inside tasks.

A word is a run of characters other than blank and the controls 0x09 to 0x0D; those are
exactly the bytes at which ``bytes.split`` cuts, and ``bytes.lower`` changes A-Z alone.
"""

from __future__ import annotations

import numpy as np
import xxhash

_MULTIPLIERS = np.random.default_rng(7).integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def words_of(text: str | None, lower: bool = False) -> list[bytes]:
    raw = (text or "").encode("utf-8", "replace")
    return (raw.lower() if lower else raw).split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hash of each word, the same in every process."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread sums of products over all 64 bits."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every window of ``size`` neighbouring words; none if there are fewer words."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(size):
        total += hashes[i:i + n] * _MULTIPLIERS[i]
    return mixed(total)


def shingles(words: list[bytes], size: int) -> np.ndarray:
    """Distinct window hashes, sorted; a shorter text is one shingle, no words are none."""
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(windows(word_hashes(words), min(size, len(words))))
