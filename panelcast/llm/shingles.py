"""Word shingles of whole texts as sets of 64-bit hashes, and MinHash signatures over them."""

from __future__ import annotations

import numpy as np
import xxhash

from panelcast.llm.common import own_memory

WORDS = 5
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_KNOWN: dict[bytes, int] = {}
_LIMIT = 500_000


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    own_memory("shingles", _KNOWN.clear)
    if len(_KNOWN) > _LIMIT:
        _KNOWN.clear()
    known = _KNOWN
    for w in set(words).difference(known):
        known[w] = xxhash.xxh3_64_intdigest(w)
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def shingle_set(text: str | None, width: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the windows of ``width`` words, A-Z lowered; the whole sequence is
    one shingle if it has fewer words; empty without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = word_hashes(words)
    k = min(width, len(words))
    n = len(h) - k + 1
    out = np.full(n, np.uint64(k))
    for j in range(k):
        out = mixed(out * _BASE + h[j:j + n])
    return np.unique(out)


class MinHash:
    """``size`` minima of linear permutations of the upper 32 bits of the shingle hashes."""

    def __init__(self, size: int, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.mul = (rng.integers(0, 1 << 31, size, np.uint32) << np.uint32(1)) | np.uint32(1)
        self.add = rng.integers(0, 1 << 32, size, np.uint32)

    def __call__(self, shingles: np.ndarray) -> np.ndarray:
        x = (shingles >> np.uint64(32)).astype(np.uint32)
        best = np.full(len(self.mul), np.uint32(0xFFFFFFFF))
        for at in range(0, len(x), 4096):
            v = np.multiply.outer(self.mul, x[at:at + 4096])
            v += self.add[:, None]
            np.minimum(best, v.min(axis=1), out=best)
        return best
