"""CGK random-walk embedding of word sequences, bit-sampling LSH tables, exact edit distance."""

from __future__ import annotations

import numpy as np

from panelcast.llm.shingles import mixed

WALKS, TABLES, SAMPLED = 8, 12, 4
_ODD = 0x9E3779B97F4A7C15


def embed(words: np.ndarray, starts: np.ndarray, steps: int, walk: int) -> np.ndarray:
    """CGK embedding of the windows that begin at ``starts``: row t holds the word under the walk at step
    t.  At every step the walk copies its word and moves on if a random bit of (step, word) is 1, so
    strings that differ by insertions and deletions fall into step again.  ``words`` must extend
    ``steps`` beyond the last start.  The bit is the highest of the word's hash times an odd number of the step."""
    out = np.empty((steps, len(starts)), np.uint64)
    odd = mixed(np.arange(steps, dtype=np.uint64) + np.uint64((walk * 100_003 + 1) * (_ODD >> 1) % (1 << 64))) | np.uint64(1)
    at = starts.astype(np.int64)
    for t in range(steps):
        w = words[at]
        out[t] = w
        at += (w * odd[t] >> np.uint64(63)).view(np.int64)
    return out


def sampled(steps: int, seed: int = 3) -> np.ndarray:
    """Coordinates of every table: (WALKS, TABLES, SAMPLED) step numbers."""
    rng = np.random.default_rng(seed + steps)
    return np.array([[rng.choice(steps, min(SAMPLED, steps), replace=False) for _ in range(TABLES)] for _ in range(WALKS)])


def chained(words: np.ndarray, start: int | np.ndarray) -> np.ndarray:
    """One hash of the rows of ``words``, from first to last."""
    out = np.full(words.shape[1:], start, np.uint64) if np.isscalar(start) else start
    for w in words:
        out = out * np.uint64(_ODD) + w
    return mixed(out)


def bucket_keys(embedded: np.ndarray, coords: np.ndarray, walk: int) -> np.ndarray:
    """Bit sampling: a key per table of the walk and window, (TABLES, windows), from its sampled words."""
    tables = np.arange(walk * len(coords), (walk + 1) * len(coords), dtype=np.uint64)
    return chained(embedded[coords.T], np.repeat(tables[:, None], embedded.shape[1], axis=1))


def edit_distance(item: np.ndarray, text: np.ndarray, most: int) -> tuple[int, int]:
    """Least word edit distance of ``item`` to a prefix of ``text`` and the length of that prefix."""
    text = text[:len(item) + most]
    n = len(text)
    place = np.arange(n + 1)
    row = place.copy()
    for i, w in enumerate(item, 1):
        best = np.empty(n + 1, np.int64)
        best[0] = i
        best[1:] = np.minimum(row[1:] + 1, row[:-1] + (text != w))
        row = np.minimum.accumulate(best - place) + place
        if row.min() > most:
            return most + 1, 0
    k = int(row.argmin())
    return int(row[k]), k
