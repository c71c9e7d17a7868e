"""Signature trees: the in-memory part of the n-gram Jaccard join.

A leaf is one distinct token set: its size, its component so far and a bitmap
with a bit set for every token hash.  A node above holds the OR of the bitmaps
below it, the range of sizes and of components, and the largest number of
tokens a leaf lost to shared bits (its slack).  For leaves x, y below nodes A, B

    |x n y| <= min(popcount(A & B) + min(slack A, slack B), max size A, max size B)

so a node pair whose bound is under the overlap that its smallest sizes need is
dropped with everything below it.  So is a pair whose sizes are too far apart,
and one whose leaves all lie in one component already.

Two more bounds tighten it.  Every bit set in one of x, y alone is a token that
only one of them has (leaves).  And a tree hangs on a token of the common order:
if that is the first token x and y share, all they share lies from its place on,
so |x n y| <= min(rest x, rest y); if it is not, the tree of the first one finds
the pair (all nodes, ``rest`` being the largest below).
"""

from __future__ import annotations

import numpy as np

FAN = 16
#: Node pairs looked at in one step; each depth of a traversal holds no more.
STEP = 16_384


class Level:
    def __init__(self, low, high, comp_low, comp_high, rest, slack, bits, leaf=False):
        self.low, self.high, self.comp_low, self.comp_high = low, high, comp_low, comp_high
        self.rest, self.slack, self.bits, self.leaf = rest, slack, bits, leaf

    def __len__(self):
        return len(self.low)


def leaves(size: np.ndarray, comp: np.ndarray, rest: np.ndarray, bits: np.ndarray) -> Level:
    """``rest``: tokens of the set from the tree's token on, in the common order."""
    slack = size - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
    return Level(size, size, comp, comp, rest, slack, bits, True)


def grow(level: Level, height: int = 0) -> list[Level]:
    """Levels from the leaves to a single root, at least ``height`` of them.
    Leaves are expected in size order, so that nodes have narrow size ranges."""
    out = [level]
    while len(out[-1]) > 1 or len(out) < height:
        x = out[-1]
        at = np.arange(0, len(x), FAN)
        out.append(Level(np.minimum.reduceat(x.low, at), np.maximum.reduceat(x.high, at),
                         np.minimum.reduceat(x.comp_low, at), np.maximum.reduceat(x.comp_high, at),
                         np.maximum.reduceat(x.rest, at), np.maximum.reduceat(x.slack, at), np.bitwise_or.reduceat(x.bits, at, axis=0)))
    return out


def possible(a: Level, b: Level, i: np.ndarray, j: np.ndarray, pct: int) -> np.ndarray:
    """Which pairs (i of a, j of b) may hold a link of at least ``pct`` percent."""
    ok = (100 * a.high[i] >= pct * b.low[j]) & (100 * b.high[j] >= pct * a.low[i])
    ok &= (a.comp_low[i] != a.comp_high[i]) | (b.comp_low[j] != b.comp_high[j]) | (a.comp_low[i] != b.comp_low[j])
    need = pct * (a.low[i] + b.low[j])
    ok &= (100 + pct) * np.minimum(a.rest[i], b.rest[j]) >= need
    at = np.flatnonzero(ok)
    i, j, need = i[at], j[at], need[at]
    x, y = a.bits[i], b.bits[j]
    shared = np.bitwise_count(x & y).sum(axis=1, dtype=np.int64)
    most = shared + np.minimum(a.slack[i], b.slack[j])
    if a.leaf:
        apart = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
        most = np.minimum(most, (a.low[i] + b.low[j] - apart) // 2)
    ok[at] = (100 + pct) * most >= need
    return ok


def traverse(left: list[Level], right: list[Level], pct: int):
    """Dual traversal from the two roots: yields arrays of leaf pairs (i, j)
    that may link; ``right is left`` gives each pair once, i < j.  Pairs that
    passed wait on the stack, and their children are made a step at a time."""
    same = right is left
    di, dj = np.divmod(np.arange(FAN * FAN), FAN)
    parents = STEP // (FAN * FAN)

    def passed(depth, i, j):
        ok = possible(left[depth], right[depth], i, j, pct)
        if same and depth == 0:
            ok &= i < j
        return depth, i[ok], j[ok]

    stack = [passed(len(left) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        depth, i, j = stack.pop()
        if not len(i):
            continue
        if depth == 0:
            yield i, j
            continue
        stack.append((depth, i[parents:], j[parents:]))
        ci = (i[:parents, None] * FAN + di).ravel()
        cj = (j[:parents, None] * FAN + dj).ravel()
        there = (ci < len(left[depth - 1])) & (cj < len(right[depth - 1]))
        if same:
            there &= ci <= cj
        stack.append(passed(depth - 1, ci[there], cj[there]))
