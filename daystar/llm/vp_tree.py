"""Vantage-point trees for the largest inner products, searched for blocks of queries at once.

Vectors are lifted to one length by a further component, so the largest inner product is the
least distance: |q - x|^2 = |q|^2 + M^2 - 2 q.x, M the length of the longest vector. A node
holds a vantage point and, by their distance from it, a near and a far half, with the least
and greatest distance in each.
"""

from __future__ import annotations

import numpy as np

#: Vectors below which a node is not split.
LEAF = 128
#: Candidates for a vantage point, and vectors that their spread is measured on.
CANDIDATES, PROBES = 5, 64
SEED = 20240711


def splits(size, leaf=LEAF):
    """(start, middle, end) of every inner node in preorder; its point is at start, halves meet at middle."""
    out, stack = [], [(0, size)]
    while stack:
        start, end = stack.pop()
        if end - start > leaf:
            middle = (start + 1 + end) // 2
            out.append((start, middle, end))
            stack += [(middle, end), (start + 1, middle)]
    return out


def build(vectors, leaf=LEAF):
    """(order, bounds) of a tree: rows of `vectors` in the order of the tree, and four distances per inner node.

    Halves are equal in number whatever the distances, so equal vectors make no deep tree.
    """
    size = len(vectors)
    squares = np.einsum("ij,ij->i", vectors, vectors)
    lifted = np.column_stack([vectors, np.sqrt(np.maximum(squares.max() - squares, 0))])
    order, bounds = np.arange(size), []
    draw = np.random.default_rng(SEED)
    for start, middle, end in splits(size, leaf):
        tried = order[draw.integers(start, end, CANDIDATES)]
        probes = lifted[order[draw.integers(start, end, PROBES)]]
        spread = [np.var(np.linalg.norm(probes - lifted[one], axis=1)) for one in tried]
        point = tried[int(np.argmax(spread))]
        own = order[start:end]
        at = int(np.flatnonzero(own == point)[0])
        own[0], own[at] = own[at], own[0]
        rest = own[1:]
        distance = np.linalg.norm(lifted[rest] - lifted[point], axis=1)
        by = np.argsort(distance, kind="stable")
        own[1:] = rest[by]
        distance, half = distance[by], middle - start - 1
        bounds.append((distance[0], distance[half - 1], distance[half], distance[-1]))
    return order, np.array(bounds, dtype=np.float64).reshape(-1, 4)


class Nearest:
    """The k best (score, id, row) of every query so far; a null id is the greatest."""

    def __init__(self, queries, rows, k):
        self.queries, self.rows, self.k = queries, rows, k
        self.scores = np.full((len(queries), k), -np.inf)
        self.ids = np.full((len(queries), k), np.iinfo(np.int64).max)
        self.nulls = np.ones((len(queries), k), dtype=bool)
        self.found = np.full((len(queries), k), -1)
        # Products from a matrix multiplication may differ in their last digits.
        self.slack = 1e-12 * np.linalg.norm(queries, axis=1)

    def offer(self, active, tree, start, end):
        """Takes the vectors start:end of a tree into account for the queries `active`."""
        rough = self.queries[active] @ tree.vectors[start:end].T
        least = self.scores[active, -1]
        if end - start > self.k:
            # Beyond the own row, the best k + 1 of the part are enough.
            cut = end - start - self.k - 1
            least = np.maximum(least, np.partition(rough, cut, axis=1)[:, cut])
        least = least - self.slack[active] * tree.longest
        one, two = np.nonzero(rough >= least[:, None])
        own = active[one]
        two = two + start
        other = self.rows[own] != tree.rows[two]
        own, two = own[other], two[other]
        if not len(own):
            return
        # Summed in one order whatever the shape of the block, so equal vectors have equal scores.
        scores = np.einsum("ij,ij->i", self.queries[own], tree.vectors[two])
        better = scores >= self.scores[own, -1]
        own, two, scores = own[better], two[better], scores[better]
        touched = np.unique(own)
        queries = np.concatenate([np.repeat(touched, self.k), own])
        scores = np.concatenate([self.scores[touched].ravel(), scores])
        ids = np.concatenate([self.ids[touched].ravel(), tree.ids[two]])
        nulls = np.concatenate([self.nulls[touched].ravel(), tree.nulls[two]])
        found = np.concatenate([self.found[touched].ravel(), tree.rows[two]])
        order = np.lexsort((found, ids, nulls, found < 0, -scores, queries))
        first = np.searchsorted(queries[order], touched)
        take = order[(first[:, None] + np.arange(self.k)).ravel()]
        shape = (len(touched), self.k)
        self.scores[touched] = scores[take].reshape(shape)
        self.ids[touched] = ids[take].reshape(shape)
        self.nulls[touched] = nulls[take].reshape(shape)
        self.found[touched] = found[take].reshape(shape)


class Tree:
    """A built tree: `vectors`, `ids` (null where `nulls`) and `rows` in its order, and its `bounds`."""

    def __init__(self, vectors, ids, nulls, rows, bounds, leaf=LEAF):
        self.vectors, self.ids, self.nulls, self.rows = vectors, ids, nulls, rows
        self.leaf = leaf
        squares = np.einsum("ij,ij->i", vectors, vectors)
        self.longest = float(np.sqrt(squares.max(initial=0)))
        self.bounds = {
            (start, end): (middle, *own)
            for (start, middle, end), own in zip(splits(len(vectors), leaf), bounds.tolist(), strict=True)
        }
        #: (query, vector) products taken so far.
        self.compared = 0

    def search(self, nearest, factor):
        """Offers to `nearest` what the triangle inequality, relaxed by `factor`, does not rule out.

        A part whose distance from a query is at least b is left out when b * factor exceeds the distance
        of the query's k-th best: with factor one nothing better can be in it, and results are exact.
        """
        squares = np.einsum("ij,ij->i", nearest.queries, nearest.queries)
        top = self.longest**2
        reach = squares + top

        def visit(start, end, active, bound):
            kth = np.sqrt(np.maximum(reach[active] - 2 * nearest.scores[active, -1], 0))
            stay = ~(bound * factor > kth * (1 + 1e-9) + 1e-9 * self.longest)
            active, bound = active[stay], bound[stay]
            if not len(active):
                return
            if (start, end) not in self.bounds:
                if end > start:
                    self.compared += len(active) * (end - start)
                    nearest.offer(active, self, start, end)
                return
            middle, near_least, near_most, far_least, far_most = self.bounds[start, end]
            self.compared += len(active)
            products = nearest.queries[active] @ self.vectors[start]
            distance = np.sqrt(np.maximum(reach[active] - 2 * products, 0))
            nearest.offer(active, self, start, start + 1)
            near = np.maximum(bound, np.maximum(distance - near_most, near_least - distance))
            far = np.maximum(bound, np.maximum(distance - far_most, far_least - distance))
            inside = distance < (near_most + far_least) / 2
            visit(start + 1, middle, active[inside], near[inside])
            visit(middle, end, active[~inside], far[~inside])
            visit(middle, end, active[inside], far[inside])
            visit(start + 1, middle, active[~inside], near[~inside])

        everyone = np.arange(len(nearest.queries))
        visit(0, len(self.vectors), everyone, np.zeros(len(everyone)))


def fitted_factor(tree, k, factors, wanted, checked=256):
    """The greatest of `factors` that finds at least a share `wanted` of the k best, or one.

    Measured against the exact search of this tree, for up to `checked` of its own vectors.
    """
    step = max(1, len(tree.vectors) // checked)
    queries, rows = tree.vectors[::step], tree.rows[::step]

    def found(factor):
        nearest = Nearest(queries, rows, k)
        tree.search(nearest, factor)
        return nearest.scores

    exact = found(1.0)
    there = np.isfinite(exact)
    least = exact.min(axis=1, keepdims=True)
    for factor in sorted(factors, reverse=True):
        scores = found(factor)
        if (np.isfinite(scores) & (scores >= least)).sum() >= wanted * there.sum():
            return factor
    return 1.0
