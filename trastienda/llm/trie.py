"""Binary tries over fingerprints of several words, traversed in pairs of nodes.

Many tries are taken at once: the fingerprints of each lie next to each other and sorted, so a node is a range. A frontier
holds the node pairs of one depth. Each level splits all of them by the next bit, adds the bits that differ and
drops pairs beyond the budget with all that lies below them; small pairs are compared at the leaves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

WORD_BITS = 64
#: Fingerprints compared at once: of a node pair, left times right, and of all node pairs.
LEAF, AT_ONCE = 4096, 1 << 16

Pairs = tuple[np.ndarray, np.ndarray]


def order(fp: np.ndarray, *groups: np.ndarray) -> np.ndarray:
    """The order of rows in which each group (the first counts most) is a trie: sorted by its fingerprints."""
    return np.lexsort((*(fp[:, k] for k in reversed(range(fp.shape[1]))), *reversed(groups)))


def linked(fp: np.ndarray, left: Pairs, right: Pairs, budget: int, wanted: Callable[[np.ndarray, np.ndarray], np.ndarray], leaf: int = LEAF, at_once: int = AT_ONCE) -> Iterator[Pairs]:
    """Positions (i, j) of the pairs within the budget that are wanted.

    `left` and `right` are the (begin, end) of the tries that meet each other; a trie that meets itself gives each pair once.
    """
    nodes = np.stack([*left, *right, np.zeros(len(left[0]), "i8")]).astype("i8")
    for depth in range(fp.shape[1] * WORD_BITS + 1):
        a0, a1, b0, b1, _ = nodes
        size = (a1 - a0) * (b1 - b0)
        small = size <= (leaf if depth < fp.shape[1] * WORD_BITS else np.inf)
        yield from _compared(fp, nodes[:, small & (size > 0)], budget, wanted, at_once)
        nodes = nodes[:, ~small]
        if not nodes.shape[1]:
            return
        nodes = _children(nodes, fp[:, depth // WORD_BITS] >> np.uint64(WORD_BITS - 1 - depth % WORD_BITS) & np.uint64(1), budget)


def _children(nodes: np.ndarray, bit: np.ndarray, budget: int) -> np.ndarray:
    """The pairs of children of node pairs, by the rows' next bit."""
    a0, a1, b0, b1, spent = nodes
    ones = np.concatenate([[0], np.cumsum(bit.astype("i8"))])
    am, bm = a1 - (ones[a1] - ones[a0]), b1 - (ones[b1] - ones[b0])
    two = a0 != b0  # a node with itself gives the pair of its children once
    apart = spent + 1
    children = [[a0, am, b0, bm, spent], [am, a1, bm, b1, spent], [a0, am, bm, b1, apart], [x[two] for x in (am, a1, b0, bm, apart)]]
    found = np.concatenate([np.stack(x) for x in children], axis=1)
    return found[:, (found[0] < found[1]) & (found[2] < found[3]) & (found[4] <= budget)]


def _compared(fp: np.ndarray, nodes: np.ndarray, budget: int, wanted: Callable[[np.ndarray, np.ndarray], np.ndarray], at_once: int) -> Iterator[Pairs]:
    """The pairs within the budget of small node pairs, whose fingerprints are compared whole."""
    size = (nodes[1] - nodes[0]) * (nodes[3] - nodes[2])
    edge = np.concatenate([[0], np.cumsum(size)])
    lo = 0
    while lo < len(size):
        hi = max(lo + 1, int(np.searchsorted(edge, edge[lo] + at_once, "right")) - 1)
        a0, _, b0, b1, _ = (np.repeat(x, size[lo:hi]) for x in nodes[:, lo:hi])
        at = np.arange(edge[hi] - edge[lo]) - np.repeat(edge[lo:hi] - edge[lo], size[lo:hi])
        i, j = a0 + at // (b1 - b0), b0 + at % (b1 - b0)
        good = (a0 != b0) | (i < j)
        i, j = i[good], j[good]
        good = wanted(i, j)
        i, j = i[good], j[good]
        near = np.bitwise_count(fp[i] ^ fp[j]).sum(axis=1, dtype="i8") <= budget
        if near.any():
            yield i[near], j[near]
        lo = hi
