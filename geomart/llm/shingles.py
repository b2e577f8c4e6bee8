"""Word shingles and b-bit MinHash signatures of texts."""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash

from geomart.llm.common import words_of

SIZE = 5
SYMBOLS = 64
CACHE_WORDS = 200_000
PART = 4096

_random = np.random.RandomState(20)
_PLACES = _random.randint(1, 1 << 62, SIZE, dtype=np.int64).astype(np.uint64) | np.uint64(1)
_FLIPS = _random.randint(1, 1 << 62, SYMBOLS, dtype=np.int64).astype(np.uint64)
_FACTORS = _random.randint(1, 1 << 62, SYMBOLS, dtype=np.int64).astype(np.uint64) | np.uint64(1)


class WordHashes(dict):
    """64-bit hash of each word; forgets all beyond ``CACHE_WORDS``."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(33)) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ h >> np.uint64(33)) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ h >> np.uint64(33)


def shingle_set(text: str, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of all runs of five words; of the whole sequence if it is shorter."""
    words = words_of(text)
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    if len(h) < SIZE:
        return mix((h * _PLACES[: len(h)]).sum(keepdims=True) + np.uint64(len(h)))
    n = len(h) - SIZE + 1
    total = np.zeros(n, np.uint64)
    for i in range(SIZE):
        total += mix(h[i : i + n] + np.uint64(i)) * _PLACES[i]
    return np.unique(mix(total))


def set_digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def signature(shingles: np.ndarray) -> np.ndarray:
    """The low 16 bits of the smallest value of the set under each of 64 hash functions."""
    least = np.full(SYMBOLS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), PART):
        part = shingles[i : i + PART]
        np.minimum(least, ((part[None, :] ^ _FLIPS[:, None]) * _FACTORS[:, None]).min(1), out=least)
    return (mix(least) & np.uint64(0xFFFF)).astype("<u2")
