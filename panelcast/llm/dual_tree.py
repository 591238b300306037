"""Nearest entries for many points at once by a pair of trees, in whole numbers.

``positions`` independent problems of one shape run side by side: points (positions, n, w) and entries
(positions, k, w).  Both sides get a balanced tree of boxes; a level of a tree is one array.  Pairs of
nodes (points box, entries box) are opened level by level: the farthest corner of a pair bounds the
nearest distance of the points from above, the gap between the boxes bounds it from below, and a pair
whose gap is beyond another pair's farthest corner goes.  A points node that is left with one entry
takes it whole, with the node's cached sum and count; leaves that stay uncertain compare whole numbers.
Equal distances always stay uncertain until the leaf, where the lower index wins.
"""

from __future__ import annotations

import numpy as np

LEAF = 16
#: Point-entry distances that a leaf step holds at once.
STEP = 1 << 20


class Tree:
    """Boxes and sums of every level; level l has 2^l nodes, node j holds points cuts[l][j]..cuts[l][j+1]."""

    def __init__(self, points: np.ndarray, depth: int):
        p, n, _ = points.shape
        self.order = np.broadcast_to(np.arange(n), (p, n)).copy()
        self.cuts = [(np.arange((1 << d) + 1) * n) >> d for d in range(depth + 1)]
        x = points
        for d in range(depth):
            node = np.repeat(np.arange(1 << d), np.diff(self.cuts[d]))
            lo, hi = self._boxes(x, d)
            wide = (hi - lo).argmax(axis=2)[:, node]
            key = np.take_along_axis(x, wide[:, :, None], axis=2)[:, :, 0]
            by = np.lexsort((key, np.broadcast_to(node, key.shape)), axis=-1)
            x, self.order = np.take_along_axis(x, by[:, :, None], axis=1), np.take_along_axis(self.order, by, axis=1)
        self.points = x
        self.lo, self.hi = zip(*(self._boxes(x, d) for d in range(depth + 1)))
        self.sums = [np.add.reduceat(x, c[:-1], axis=1) for c in self.cuts]

    def _boxes(self, x: np.ndarray, d: int) -> tuple[np.ndarray, np.ndarray]:
        at = self.cuts[d][:-1]
        return np.minimum.reduceat(x, at, axis=1), np.maximum.reduceat(x, at, axis=1)


def depth_of(n: int, leaf: int) -> int:
    d = 0
    while n >> (d + 1) >= leaf:
        d += 1
    return d


def safe(points: np.ndarray, entries: np.ndarray) -> bool:
    """True if every squared distance, times the number of entries, fits an int64."""
    top = max(int(points.max(initial=0)), int(entries.max(initial=0))) - min(int(points.min(initial=0)), int(entries.min(initial=0)))
    return top * top * max(1, points.shape[2]) * max(1, entries.shape[1]) < 1 << 62


def nearest(points: np.ndarray, entries: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict]:
    """For int64 points (P, n, w) and entries (P, k, w): the index of the nearest entry of every point
    (P, n), the entries' counts (P, k) and sums (P, k, w), and figures of the pruning.

    Ties go to the lower index, so an entry that repeats an earlier one is never chosen."""
    p, n, w = points.shape
    k = entries.shape[1]
    full = 1 << max(0, (k - 1).bit_length())
    padded = np.concatenate([entries, np.broadcast_to(entries[:, :1], (p, full - k, w))], axis=1) if full > k else entries
    tree, near = Tree(points, depth_of(n, leaf)), Tree(padded, full.bit_length() - 1)
    last, single = len(tree.cuts) - 1, len(near.cuts) - 1
    # an entry that repeats an earlier one, padding included, can't win
    spare = np.zeros((p, full), bool)
    for i in range(p):
        _, first = np.unique(padded[i], axis=0, return_index=True)
        spare[i] = True
        spare[i, first] = False
    code = np.zeros((p, n), np.int64)                     # in tree order
    count, total = np.zeros((p, k), np.int64), np.zeros((p, k, w), np.int64)
    stats = {"pairs": 0, "whole": 0, "leaf": 0}
    pos, a, b = np.arange(p), np.zeros(p, np.int64), np.zeros(p, np.int64)
    la = lb = 0
    while len(pos):
        if lb == single:
            keep = ~spare[pos, near.order[pos, b]]
            pos, a, b = pos[keep], a[keep], b[keep]
        stats["pairs"] += len(pos)
        alo, ahi, blo, bhi = tree.lo[la][pos, a], tree.hi[la][pos, a], near.lo[lb][pos, b], near.hi[lb][pos, b]
        gap = np.maximum(0, np.maximum(blo - ahi, alo - bhi))
        far = np.maximum(np.abs(ahi - blo), np.abs(bhi - alo))
        gap, far = (gap * gap).sum(axis=1), (far * far).sum(axis=1)
        node = pos * (1 << la) + a
        heads = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
        least = np.minimum.reduceat(far, heads)
        keep = gap <= np.repeat(least, np.diff([*heads, len(node)]))
        pos, a, b, node = pos[keep], a[keep], b[keep], node[keep]
        if lb == single:
            heads = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
            held = np.diff([*heads, len(node)])
            one = heads[held == 1]                        # one entry left: the whole node takes it
            if len(one):
                e = near.order[pos[one], b[one]]
                start, end = tree.cuts[la][a[one]], tree.cuts[la][a[one] + 1]
                size = end - start
                spread = np.repeat(start, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                code[np.repeat(pos[one], size), spread] = np.repeat(e, size)
                np.add.at(count, (pos[one], e), size)
                np.add.at(total, (pos[one], e), tree.sums[la][pos[one], a[one]])
                stats["whole"] += int(size.sum())
            many = np.repeat(held > 1, held)
            pos, a, b, node = pos[many], a[many], b[many], node[many]
            if la == last:
                stats["leaf"] += _leaves(tree, near, pos, a, b, node, code, count, total)
                break
        # open one level on each side that still has one
        da, db = la < last, lb < single
        if da:
            pos, a, b, la = np.repeat(pos, 2), np.stack([2 * a, 2 * a + 1], axis=1).ravel(), np.repeat(b, 2), la + 1
        if db:
            pos, a, b, lb = np.repeat(pos, 2), np.repeat(a, 2), np.stack([2 * b, 2 * b + 1], axis=1).ravel(), lb + 1
        by = np.argsort((pos * (1 << la) + a) * full + b, kind="stable")
        pos, a, b = pos[by], a[by], b[by]
    back = np.empty_like(code)
    np.put_along_axis(back, tree.order, code, axis=1)
    return back, count, total, stats


def _leaves(tree: Tree, near: Tree, pos, a, b, node, code, count, total) -> int:
    """Exact distances of every point of an uncertain leaf to the leaf's remaining entries."""
    if not len(pos):
        return 0
    last, k = len(tree.cuts) - 1, near.order.shape[1]
    p, n, w = tree.points.shape
    size = np.diff(tree.cuts[last])[a]
    done, done_points, at = 0, 0, 0
    heads = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
    ends = np.cumsum(size)
    while at < len(pos):
        # whole leaves only, about STEP distances at a time
        stop = np.searchsorted(ends, done + STEP, side="right")
        stop = max(heads[min(np.searchsorted(heads, stop, side="right") - 1, len(heads) - 1)] if stop < len(pos) else len(pos), 0)
        if stop <= at:
            later = heads[heads > at]
            stop = later[0] if len(later) else len(pos)
        s, q, e = size[at:stop], pos[at:stop], near.order[pos[at:stop], b[at:stop]]
        point = np.repeat(tree.cuts[last][a[at:stop]], s) + np.arange(s.sum()) - np.repeat(np.cumsum(s) - s, s)
        q, e = np.repeat(q, s), np.repeat(e, s)
        gap = tree.points[q, point] - np.repeat(near.points[pos[at:stop], b[at:stop]], s, axis=0)
        key = (gap * gap).sum(axis=1) * k + e
        flat = q * n + point
        by = np.lexsort((key, flat))
        first = by[np.concatenate([[True], flat[by][1:] != flat[by][:-1]])]
        q, point, e = q[first], point[first], e[first]
        code[q, point] = e
        np.add.at(count, (q, e), 1)
        np.add.at(total, (q, e), tree.points[q, point])
        done_points += len(first)
        done, at = ends[stop - 1], stop
    return done_points
