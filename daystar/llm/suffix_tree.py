"""Suffix tree of a word sequence and the longest common extension of two of its positions.

Ukkonen's construction, an Euler tour of the depths, and range minima over the tour: the
deepest node above two leaves is the least depth between their visits, found in constant
time, and its depth is how far the two suffixes agree.
"""

from __future__ import annotations

import numpy as np

#: Entries of the tour in a block of the range minima.
BLOCK = 16


def ukkonen(words, alphabet):
    """Nodes of the suffix tree of `words`, numbers from 1 below `alphabet`.

    The sequence is closed by a 0 that occurs nowhere else. Returns (start, end, edges): the
    words of the edge into a node lie at start:end, and edges maps parent * alphabet + first
    word to the node. Node 0 is the root; leaves come in the order of their suffixes.
    """
    text = [*words, 0]
    size = len(text)
    start, end, link, edges = [0], [0], [0], {}
    node = edge = depth = waiting = 0
    for at, word in enumerate(text):
        waiting += 1
        before = 0
        while waiting:
            if not depth:
                edge = at
            key = node * alphabet + text[edge]
            child = edges.get(key)
            if child is None:
                edges[key] = len(start)
                start.append(at)
                end.append(size)
                link.append(0)
                if before:
                    link[before] = node
                    before = 0
            else:
                first = start[child]
                length = min(end[child], at + 1) - first
                if depth >= length:
                    edge += length
                    depth -= length
                    node = child
                    continue
                if text[first + depth] == word:
                    if before:
                        link[before] = node
                    depth += 1
                    break
                middle = len(start)
                edges[key] = middle
                edges[middle * alphabet + word] = middle + 1
                edges[middle * alphabet + text[first + depth]] = child
                start += (first, at)
                end += (first + depth, size)
                link += (0, 0)
                start[child] = first + depth
                if before:
                    link[before] = middle
                before = middle
            waiting -= 1
            if node:
                node = link[node]
            elif depth:
                depth -= 1
                edge = at - waiting + 1
    return start, end, edges


class SuffixTree:
    """Suffix order and longest common extensions of a sequence of numbers from 1 on.

    About 300 bytes a word while it is built, some 60 after.
    """

    def __init__(self, words, alphabet):
        self.size = len(words)
        start, end, edges = ukkonen(words, alphabet)
        keys = np.fromiter(edges.keys(), np.int64, len(edges))
        nodes = np.fromiter(edges.values(), np.int64, len(edges))
        # Ascending keys: the children of a node lie together, in the order of their first words.
        order = np.argsort(keys)
        keys = keys[order]
        self._children = nodes[order].tolist()
        bounds = np.searchsorted(keys // alphabet, np.arange(len(start) + 1))
        self._bounds = bounds.tolist()
        self._closing = (keys % alphabet == 0).tolist()
        # Leaves were made in the order of their suffixes.
        self._suffix = (np.cumsum(np.diff(bounds) == 0) - 1).tolist()
        self._tour((np.array(end) - np.array(start)).tolist())

    def _tour(self, length):
        """Depths along the Euler tour, and where in it every suffix stands first."""
        children, bounds, suffix = self._children, self._bounds, self._suffix
        depths, first = [], [0] * (self.size + 1)
        # Below every child waits a -1: there its parent, whose depth is beside it, is visited again.
        stack, above = [0], [0]
        while stack:
            node, depth = stack.pop(), above.pop()
            if node < 0:
                depths.append(depth)
                continue
            low, high = bounds[node], bounds[node + 1]
            if low == high:
                first[suffix[node]] = len(depths)
                depths.append(self.size - suffix[node])
                continue
            depth += length[node]
            depths.append(depth)
            for child in reversed(children[low:high]):
                stack += (-1, child)
                above += (depth, depth)
        self._first = np.array(first)
        self._minima(np.array(depths, dtype=np.int32))

    def _minima(self, depths):
        """Minima of the tour from block starts, to block ends, and of 2^k whole blocks."""
        padded = np.full(-(-len(depths) // BLOCK) * BLOCK + BLOCK, np.iinfo(np.int32).max, np.int32)
        padded[: len(depths)] = depths
        blocks = padded.reshape(-1, BLOCK)
        self._depths = padded
        self._from_start = np.minimum.accumulate(blocks, axis=1).ravel()
        self._to_end = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        self._powers = [blocks.min(axis=1)]
        while (step := 1 << len(self._powers)) <= len(blocks):
            last = self._powers[-1]
            self._powers.append(np.minimum(last[: len(last) - step // 2], last[step // 2 :]))

    def common(self, one, two):
        """Words that the suffixes at `one` and `two` (arrays) have in common at their start.

        A position may be the size of the sequence: its suffix is empty.
        """
        low, high = self._first[one], self._first[two]
        low, high = np.minimum(low, high), np.maximum(low, high)
        left, right = low // BLOCK, high // BLOCK
        found = np.minimum(self._to_end[low], self._from_start[high])
        between = right - left - 1
        for power in range(int(between.max(initial=0)).bit_length()):
            at = np.flatnonzero((between > 0) & (between >> power == 1))
            if len(at):
                table = self._powers[power]
                least = np.minimum(table[left[at] + 1], table[right[at] - (1 << power)])
                found[at] = np.minimum(found[at], least)
        at = np.flatnonzero(between < 0)
        if len(at):
            inside = low[at][:, None] + np.arange(BLOCK)
            values = self._depths[inside]
            values[inside > high[at][:, None]] = np.iinfo(np.int32).max
            found[at] = values.min(axis=1)
        return found.astype(np.int64)

    def ranks(self, descending=False):
        """Rank of every suffix, the empty one included; a proper prefix comes first in both orders."""
        if descending:
            order = self._leaves_descending()
        else:
            order = np.argsort(self._first)
        ranks = np.empty(self.size + 1, dtype=np.int64)
        ranks[order] = np.arange(self.size + 1)
        return ranks

    def _leaves_descending(self):
        children, bounds, suffix, closing = self._children, self._bounds, self._suffix, self._closing
        order, stack = [], [0]
        while stack:
            node = stack.pop()
            low, high = bounds[node], bounds[node + 1]
            if low == high:
                order.append(suffix[node])
            elif closing[low]:
                stack += children[low + 1 : high]
                stack.append(children[low])
            else:
                stack += children[low:high]
        return np.array(order)
