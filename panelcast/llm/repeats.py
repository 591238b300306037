"""Byte-level pieces of the suffix-array dedup: content-defined anchors and the interval tree.

Two equal strings of ``span`` bytes contain the same anchor at the same place: the anchor of a window
of ``span`` bytes is the leftmost position in it whose ``gram``-byte string has the smallest hash, which
depends on the window's content alone.  The windows of a text fall into runs with one anchor; a run with
the bytes that its windows cover is a *segment*.  Equal windows therefore lie in segments whose anchors
have equal grams, at equal distance from the anchor.
"""

from __future__ import annotations

import numpy as np

SPAN = 400
_BLOCK = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BYTES = np.random.default_rng(5).integers(1, 1 << 63, 256, np.uint64) | np.uint64(1)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, grown on demand to a power of two."""
    size = 1 << max(12, (n - 1).bit_length())
    if size not in _POWERS:
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        _POWERS[size] = tuple(np.cumprod(np.r_[np.uint64(1), np.full(size - 1, b, np.uint64)], dtype=np.uint64) for b in (_BASE, inverse))
    return _POWERS[size]


def gram_hashes(raw: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of the ``gram`` bytes from each position."""
    from panelcast.llm.shingles import mixed

    up, down = _powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTES[raw] * up[:len(raw)], out=sums[1:])
    n = len(raw) - gram + 1
    return mixed((sums[gram:] - sums[:n]) * down[:n])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values: block-wise minima from both sides."""
    n = len(x) - width + 1
    blocks = -(-len(x) // width)
    padded = np.full(blocks * width, np.iinfo(x.dtype).max, x.dtype)
    padded[:len(x)] = x
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def gram_length(span: int) -> int:
    """Bytes of an anchor's gram: 3/8 of a window, so that a text has about one anchor per 5/16 of a window."""
    return max(1, 3 * span // 8)


def anchors(raw: bytes, span: int = SPAN) -> tuple[np.ndarray, ...]:
    """(gram hash, anchor, first window, last window) of the segments of a text; texts shorter than
    ``span`` have none.  Long texts are read in blocks; a run cut by a block's end makes two segments."""
    if len(raw) < span:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    gram = gram_length(span)
    whole, width, out = np.frombuffer(raw, np.uint8), span - gram + 1, []
    for lo in range(0, len(raw) - span + 1, _BLOCK):
        part = whole[lo:lo + _BLOCK + span - 1]
        h = gram_hashes(part, gram)
        at = np.arange(len(h), dtype=np.uint64)
        low = sliding_min((h & np.uint64(0xFFFFFFFF00000000)) | at, width)
        place = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first = np.r_[0, np.flatnonzero(np.diff(place)) + 1]
        last = np.r_[first[1:] - 1, len(place) - 1]
        a = place[first]
        out.append((h[a].view(np.int64), a + lo, first + lo, last + lo))
    return tuple(np.concatenate(c) for c in zip(*out))


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if not n:
        return 0
    differ = a[:n] != b[:n]
    k = int(differ.argmax())
    return k if differ[k] else n


def interval_tree(lcp: list[int]) -> list[tuple[int, int, int]]:
    """Intervals (length, first, last) of a suffix array with ``lcp[i]`` common to suffixes i-1 and i,
    found by one scan with a stack; children come before their parents."""
    out, stack = [], [(0, 0)]
    for i in range(1, len(lcp) + 1):
        left, value = i - 1, lcp[i] if i < len(lcp) else -1
        while stack and value < stack[-1][0]:
            length, left = stack.pop()
            if i - 1 > left and length > 0:
                out.append((length, left, i - 1))
        if not stack or value > stack[-1][0]:
            stack.append((value, left))
    return out


def maximal_repeats(rights: list[bytes], lefts: list[bytes], least: int) -> list[tuple[int, int, list[int]]]:
    """Maximal repeats through the anchor: (left length, right length, occurrences).

    ``rights`` are the suffixes from the anchor on, sorted: a sparse suffix array.  ``lefts`` are the
    bytes before the anchor, reversed.  Every interval of the common-prefix tree is one right length.
    Its occurrences are put in the order of their left contexts; where neighbours agree on at least
    ``least - right`` bytes they form a group, and the group's left extensions are tested: a group is
    reported at every left length at which its occurrences begin to differ.  All occurrences of a
    repeat are listed, not only neighbouring ones.
    """
    m = len(rights)
    r = [np.frombuffer(x, np.uint8) for x in rights]
    left = [np.frombuffer(x, np.uint8) for x in lefts]
    lcp = [0] + [common(r[i - 1], r[i]) for i in range(1, m)]
    order = sorted(range(m), key=lefts.__getitem__)
    rank = [0] * m
    for k, i in enumerate(order):
        rank[i] = k
    out = []
    for length, lo, hi in interval_tree(lcp):
        need = max(0, least - length)
        members = order if hi - lo + 1 == m else sorted(range(lo, hi + 1), key=rank.__getitem__)
        agree = [0] + [common(left[a], left[b]) for a, b in zip(members, members[1:])]
        start = 0
        for k in range(1, len(members) + 1):
            if k < len(members) and agree[k] >= need:
                continue
            if k - start > 1:
                # left-extension tree of the group: the shortest common length and every longer one
                for more, x, y in [(min(agree[start + 1:k]), 0, k - start - 1), *interval_tree([0, *agree[start + 1:k]])]:
                    out.append((more, length, members[start + x:start + y + 1]))
            start = k
    return out


def repeated_windows(segments: list[tuple[bytes, int, int]], span: int = SPAN) -> list[list[tuple[int, int]]]:
    """For each segment (text, anchor offset, copies) of one gram the runs of windows (first, last), by
    place in the segment, that also start elsewhere."""
    m = len(segments)
    out: list[list[tuple[int, int]]] = [[] for _ in segments]
    for i, (text, _, n) in enumerate(segments):
        if n > 1:
            out[i] = [(0, len(text) - span)]
    if m > 1:
        order = sorted(range(m), key=lambda i: segments[i][0][segments[i][1]:])
        rights = [segments[i][0][segments[i][1]:] for i in order]
        lefts = [segments[i][0][:segments[i][1]][::-1] for i in order]
        for before, after, places in maximal_repeats(rights, lefts, span):
            if before + after < span:
                continue
            for k in places:
                text, off, n = segments[order[k]]
                # windows [off - o, off - o + span) with span - after <= o <= before, inside the segment
                lo, hi = max(0, off - before), min(len(text) - span, off - max(0, span - after))
                if n < 2 and lo <= hi:
                    out[order[k]].append((lo, hi))
    return [joined(x) for x in out]


def joined(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted runs (first, last) with touching ones joined."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(runs):
        if out and lo <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out
