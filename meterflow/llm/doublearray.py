"""Double-array tries over phrases of whole numbers, walked for all positions of a text at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

WIDE = 256


@dataclass
class Trie:
    """All phrases have ``depth`` symbols. ``alphabet`` is sorted; a state is a place in the arrays, 0 the root; ``accepted`` has the phrase's row, or -1."""

    alphabet: np.ndarray
    depth: int
    base: np.ndarray
    check: np.ndarray
    accepted: np.ndarray

    def codes(self, symbols: np.ndarray) -> np.ndarray:
        """Each symbol's place in the alphabet, -1 for others."""
        at = np.minimum(np.searchsorted(self.alphabet, symbols), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == symbols, at, -1)

    def walk(self, codes: np.ndarray, left: np.ndarray) -> np.ndarray:
        """For each position the phrase (its row) that begins there, or -1. ``left``: symbols from there on that may belong to one phrase.

        All positions go down one level together; those that fall out of the trie are left behind.
        """
        out = np.full(len(codes), -1, np.int64)
        at = np.flatnonzero(left >= self.depth)
        states = np.zeros(len(at), np.int64)
        for level in range(self.depth):
            step = codes[at + level]
            there = np.where(step >= 0, self.base[states] + step, 0)
            on = (step >= 0) & (self.check[there] == states)
            at, states = at[on], there[on]
        out[at] = self.accepted[states]
        return out


def _bases(counts: np.ndarray, codes: np.ndarray, width: int) -> tuple[np.ndarray, int]:
    """A base for each node (its children are ``counts`` of ``codes`` in a row), so that no two children share a place; and how many places there are.

    Wide nodes are placed one by one, the others all at once at random places, again and again for those that clash. Place 0 is the root's.
    """
    rng = np.random.default_rng(1)
    firsts = np.concatenate([[0], np.cumsum(counts)])
    used = np.zeros(4 * len(codes) + 2 * width + 2, bool)
    used[0] = True
    bases = np.zeros(len(counts), np.int64)
    order = np.argsort(-counts, kind="stable")
    top = 1
    for node in order[counts[order] >= WIDE]:
        own = codes[firsts[node] : firsts[node + 1]]
        for base in [*rng.integers(1, top + 1, 16).tolist(), top]:
            if not used[base + own].any():
                break
        bases[node] = base
        used[base + own] = True
        top = max(top, base + int(own[-1]) + 1)
        if top + width + 1 > len(used):
            used = np.concatenate([used, np.zeros(len(used), bool)])
    for low, high in ((64, WIDE), (16, 64), (4, 16), (1, 4)):
        open_ = np.flatnonzero((counts >= low) & (counts < high))
        while len(open_):
            n = counts[open_]
            heads = np.concatenate([[0], np.cumsum(n)[:-1]])
            own = codes[np.repeat(firsts[open_] - heads, n) + np.arange(n.sum())]
            tried = rng.integers(1, len(used) - width, len(open_))
            places = np.repeat(tried, n) + own
            alone = np.zeros(len(places), bool)
            alone[np.unique(places, return_index=True)[1]] = True
            fits = np.logical_and.reduceat(alone & ~used[places], heads)
            bases[open_[fits]] = tried[fits]
            used[places[np.repeat(fits, n)]] = True
            if fits.mean() < 0.2:
                used = np.concatenate([used, np.zeros(len(used) // 2, bool)])
            open_ = open_[~fits]
    return bases, len(used)


def build(phrases: np.ndarray) -> Trie:
    """A trie of the rows of ``phrases`` (distinct rows of symbols, at least one row)."""
    depth = phrases.shape[1]
    alphabet, codes = np.unique(phrases, return_inverse=True)
    codes = codes.reshape(phrases.shape)
    order = np.lexsort(codes.T[::-1])
    codes = codes[order]
    changed = np.zeros(len(codes), bool)
    changed[0] = True
    parents, edges, node_of = [], [], np.zeros(len(codes), np.int64)  # node 0 is the root
    nodes = 1
    for level in range(depth):
        changed[1:] |= codes[1:, level] != codes[:-1, level]
        new = np.flatnonzero(changed)
        parents.append(node_of[new])
        edges.append(codes[new, level])
        node_of = nodes + np.cumsum(changed) - 1
        nodes += len(new)
    parent, edge = np.concatenate(parents), np.concatenate(edges)  # of node 1, 2, ...; parents in order
    counts = np.bincount(parent, minlength=nodes)
    inner = np.flatnonzero(counts)
    inner_bases, size = _bases(counts[inner], edge, len(alphabet))
    bases = np.zeros(nodes, np.int64)
    bases[inner] = inner_bases
    place = np.zeros(nodes, np.int64)
    place[1:] = bases[parent] + edge
    base, check, accepted = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    base[place] = bases
    check[place[1:]] = place[parent]
    accepted[place[node_of]] = order
    return Trie(alphabet, depth, base, check, accepted)
