"""A run-length index of short texts: run-compressed Burrows-Wheeler transform with run samples.

Built over a list of fragments by prefix doubling (a fragment's suffixes end at its own
end; equal suffixes stand in the order of their fragments). The transform is cut into runs
of one symbol that do not cross a border of contexts of ``depth`` bytes, and every run keeps
three numbers: its first row, the row its first symbol maps to, and a sample, the first text
position at which its context occurs. Text and suffix array are dropped.

``first_seen`` streams fragments backwards through the runs and gives, for every position
with at least ``depth`` bytes to follow, the first position at which these bytes occur: the
matching statistics, cut at ``depth``, with their leftmost witness.
"""

from __future__ import annotations

import numpy as np


def _dense(key: np.ndarray) -> np.ndarray:
    """Ranks from 1 of the values of ``key``."""
    order = np.argsort(key)
    s = key[order]
    new = np.zeros(len(s), np.int64)
    new[1:] = s[1:] != s[:-1]
    out = np.empty(len(s), np.int64)
    out[order] = np.cumsum(new) + 1
    return out


class RunIndex:
    def __init__(self, data: np.ndarray, off: np.ndarray, depth: int) -> None:
        """``data`` holds the fragments one after the other, ``off`` their borders."""
        m, depth = len(off) - 1, int(depth)
        size = np.diff(off)
        n = len(data) + m  # a terminator after each fragment
        frag = np.repeat(np.arange(m), size + 1)
        begin = off[:-1] + np.arange(m)
        left = (begin + size)[frag] - np.arange(n)  # bytes to the fragment's end
        sym = np.zeros(n + 8, np.int64)
        sym[np.flatnonzero(left)] = data.astype(np.int64) + 1
        key = np.zeros(n, np.int64)
        for k in range(min(7, depth)):  # up to seven symbols of nine bits, blank past the end
            key = (key << 9) | np.where(left > k, sym[k:n + k], 0)
        rank, have = _dense(key), min(7, depth)
        pair = lambda r, h: _dense((r << 32) | np.where(left > h, r[np.minimum(np.arange(n) + h, n - 1)], 0))
        context = None
        longest = int(size.max(initial=0))
        while have < max(longest, depth):
            if context is None and 2 * have >= depth:  # exactly depth symbols, from two that overlap
                context = pair(rank, depth - have)
            rank, have = pair(rank, have), 2 * have
        if context is None:
            context = pair(rank, depth - have)
        rows = np.argsort(rank, kind="stable")  # the suffix array
        before = np.where(np.arange(n) == begin[frag], 0, np.concatenate([[0], sym[:n - 1]]))
        bwt, ctx = before[rows], context[rows]
        new = np.ones(n, bool)
        new[1:] = (bwt[1:] != bwt[:-1]) | (ctx[1:] != ctx[:-1])
        head = np.flatnonzero(new)
        edge = np.flatnonzero(np.concatenate([[True], ctx[1:] != ctx[:-1]]))
        # first position of each context, given to its runs
        leftmost = np.minimum.reduceat(rows, edge)
        self.start = head
        self.sample = leftmost[np.searchsorted(edge, head, "right") - 1]
        order = np.argsort(bwt[head], kind="stable")
        width = np.diff(np.append(head, n))
        target = np.empty(len(head), np.int64)
        target[order] = np.cumsum(width[order]) - width[order]
        self.target = target
        self.size, self.begin, self.depth, self.n = size, begin, depth, n

    def first_seen(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(fragment, offset, first position) of all windows of ``depth`` bytes, by streaming every fragment.

        Positions count bytes with one terminator per fragment, as ``begin`` does.
        """
        out = []
        active = np.flatnonzero(self.size >= self.depth)
        row = active.copy()  # the empty suffixes come first, in the order of the fragments
        run = np.searchsorted(self.start, row, "right") - 1
        step = 0
        while len(active):
            step += 1
            row = self.target[run] + row - self.start[run]
            run = np.searchsorted(self.start, row, "right") - 1
            if step >= self.depth:
                out.append((active, self.size[active] - step, self.sample[run]))
                go = self.size[active] > step
                if not go.all():
                    active, row, run = active[go], row[go], run[go]
        if not out:
            z = np.zeros(0, np.int64)
            return z, z, z
        return tuple(np.concatenate(x) for x in zip(*out))
