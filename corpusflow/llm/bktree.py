"""BK-trees over 64-bit fingerprints, many at once, in array operations.

A forest holds one tree for each group of fingerprints. A node's children are
keyed by their integer Hamming distance to it; no two children share a key. All
trees grow level by level, and all queries descend level by level, following
only the edges whose key lies within the radius of the query's distance.
"""

from __future__ import annotations

import numpy as np

#: Query-node pairs held at once while queries descend.
FRONTIER = 1 << 20


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of fingerprints of one 64-bit word, or of a row of words, each."""
    bits = np.bitwise_count(a ^ b)
    return bits.astype(np.int64) if bits.ndim == 1 else bits.sum(1, dtype=np.int64)


class Forest:
    """One BK-tree for each value of ``group`` over ``prints``."""

    def __init__(self, prints: np.ndarray, group: np.ndarray):
        n = len(prints)
        self.prints = prints
        self.keys = prints.itemsize * 8 * (prints.shape[1] if prints.ndim == 2 else 1) + 1  # distances there are
        edges = []  # (parent, key, child)
        _, first, inverse = np.unique(group, return_index=True, return_inverse=True)
        self.roots = first  # one for each distinct group, in their order
        node = first[inverse]  # the node at which each item now stands
        rest = np.flatnonzero(node != np.arange(n))
        while len(rest):
            slot = node[rest] * self.keys + distance(prints[rest], prints[node[rest]])
            taken, lead, inverse = np.unique(slot, return_index=True, return_inverse=True)
            child = rest[lead]  # the first to come becomes the child under its key
            edges.append(np.stack([taken, child]))
            node[rest] = child[inverse]
            rest = rest[child[inverse] != rest]
        slots = np.concatenate(edges, axis=1) if edges else np.zeros((2, 0), np.int64)
        order = np.argsort(slots[0], kind="stable")
        self.slots, self.children = slots[0][order], slots[1][order]

    def search(self, queries: np.ndarray, root: np.ndarray, radius: int):
        """Yield ``(query number, node)`` arrays of all pairs within ``radius``."""
        stack = [(np.arange(a, min(a + FRONTIER // 8, len(queries))), root[a : a + FRONTIER // 8]) for a in range(0, len(queries), FRONTIER // 8)]
        while stack:
            who, node = stack.pop()
            d = distance(queries[who], self.prints[node])
            hit = d <= radius
            if hit.any():
                yield who[hit], node[hit]
            base = node * self.keys
            a = np.searchsorted(self.slots, base + np.maximum(d - radius, 0))
            b = np.searchsorted(self.slots, base + np.minimum(d + radius, self.keys - 1), "right")
            size = b - a
            open_ = size > 0
            who, a, size = who[open_], a[open_], size[open_]
            total = np.cumsum(size)
            at = 0
            while at < len(who):
                done = total[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(total, done + FRONTIER, "right")))
                n = size[at:to]
                where = np.arange(int(n.sum())) + np.repeat(a[at:to] - (np.cumsum(n) - n), n)
                stack.append((np.repeat(who[at:to], n), self.children[where]))
                at = to


class Union:
    """Sets of items joined by links, in array operations; the least item names its set."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        label = self.label
        while True:
            x, y = label[a], label[b]
            differ = x != y
            if not differ.any():
                return
            a, b, x, y = a[differ], b[differ], x[differ], y[differ]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label[:] = up
