"""A bidirectional FM-index over a delimited vocabulary, searched for words at one error.

Words are bytes (Latin-1) and stand between delimiters. The index of one direction is the FM-index of the vocabulary read backwards, so that a backward
step appends a byte to the right of what was matched; the index of the other direction is the same over reversed words, so that a step appends to the left.
A pattern's state is its interval of suffix ranks; all patterns take a step together, two binary searches each.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# rows of the index that are looked at in one go for the bytes that may follow
ROWS_AT_ONCE = 1 << 21
STATES_AT_ONCE = 1 << 14
END, DELIMITER = b"\0", b"\1"


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Places of all suffixes in order, by doubling the prefixes they are sorted by."""
    ranks = np.unique(text, return_inverse=True)[1].astype(np.int64)
    width = 1
    while True:
        after = np.zeros(len(text), np.int64)
        after[:-width or None] = ranks[width:] + 1
        keys = ranks * (len(text) + 2) + after
        order = np.argsort(keys, kind="stable")
        new = np.ones(len(text), np.int64)
        new[1:] = keys[order][1:] != keys[order][:-1]
        ranks[order] = np.cumsum(new) - 1
        if ranks[order[-1]] == len(text) - 1:
            return order
        width *= 2


@dataclass
class FMIndex:
    """``steps`` holds, sorted, byte * size + row for each row's byte before its suffix: a step of an interval is the place of two numbers in it."""

    size: int
    before: np.ndarray
    steps: np.ndarray
    suffixes: np.ndarray
    delimiters: np.ndarray

    @classmethod
    def of(cls, words: list[bytes]) -> FMIndex:
        text = np.frombuffer((DELIMITER + DELIMITER.join(words) + DELIMITER)[::-1] + END, np.uint8)
        suffixes = suffix_array(text)
        before = text[suffixes - 1]
        order = np.argsort(before, kind="stable")
        return cls(len(text), before, before[order].astype(np.int64) * len(text) + order, suffixes, np.flatnonzero(text == DELIMITER[0]))

    def step(self, low: np.ndarray, high: np.ndarray, byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals after one more byte each."""
        first = byte.astype(np.int64) * self.size
        return np.searchsorted(self.steps, first + low), np.searchsorted(self.steps, first + high)

    def word(self, low: np.ndarray) -> np.ndarray:
        """Which word the first row of an interval of a whole word with both its delimiters stands for."""
        return len(self.delimiters) - 2 - np.searchsorted(self.delimiters, self.suffixes[low])

    def following(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(state, byte): the letters that may come next for each interval."""
        states, bytes_ = [np.empty(0, np.int64)], [np.empty(0, np.uint8)]
        sizes = high - low
        ends = np.cumsum(sizes)
        a = 0
        while a < len(low):
            b = int(np.searchsorted(ends, (ends[a - 1] if a else 0) + ROWS_AT_ONCE, "right"))
            b = min(max(a + 1, b), a + STATES_AT_ONCE, len(low))
            n = sizes[a:b]
            rows = np.repeat(low[a:b] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            seen = np.zeros((b - a, 256), bool)
            seen[np.repeat(np.arange(b - a), n), self.before[rows]] = True
            seen[:, : DELIMITER[0] + 1] = False
            state, byte = np.nonzero(seen)
            states.append(state + a)
            bytes_.append(byte.astype(np.uint8))
            a = b
        return np.concatenate(states), np.concatenate(bytes_)


def near(index: FMIndex, words: list[bytes], exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, word of the index), once each, for words at exactly one error that lies behind the first ``exact`` bytes of the query.

    One error: a byte more, a byte less or another byte. The first bytes are matched as they are; the rest is stepped through with the error at every place.
    """
    none = np.empty(0, np.int64)
    if not words:
        return none, none
    lengths = np.array([len(w) for w in words])
    data = np.frombuffer(DELIMITER.join(words) + DELIMITER, np.uint8)
    firsts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    query = np.arange(len(words))
    low, high = index.step(np.zeros(len(words), np.int64), np.full(len(words), index.size), np.full(len(words), DELIMITER[0], np.uint8))
    found = [(none, none)]

    def finish(query, at, low, high):
        """Match all that is left of the queries, from byte ``at`` on, as it is."""
        while len(query):
            low, high = index.step(low, high, data[firsts[query] + at])
            there = low < high
            query, at, low, high = query[there], at[there] + 1, low[there], high[there]
            over = at > lengths[query]
            found.append((query[over], index.word(low[over])))
            query, at, low, high = query[~over], at[~over], low[~over], high[~over]

    for place in range(int(lengths.max()) + 1):
        erring = place >= exact[query]
        q, lo, hi = query[erring], low[erring], high[erring]
        if len(q):
            state, byte = index.following(lo, hi)
            after_low, after_high = index.step(lo[state], hi[state], byte)
            own = data[firsts[q] + place][state]  # a delimiter at the end: nothing to replace
            # a byte more (before an equal one it is the same as behind it, so only other bytes here)
            other = byte != own
            finish(q[state][other], np.full(other.sum(), place), after_low[other], after_high[other])
            swapped = other & (own != DELIMITER[0])
            finish(q[state][swapped], np.full(swapped.sum(), place + 1), after_low[swapped], after_high[swapped])
            # a byte less (of equal ones in a row only the last)
            inside = place < lengths[q]
            inside[inside] = data[firsts[q[inside]] + place] != data[firsts[q[inside]] + place + 1]
            finish(q[inside], np.full(inside.sum(), place + 1), lo[inside], hi[inside])
        going = place < lengths[query]
        query, low, high = query[going], low[going], high[going]
        low, high = index.step(low, high, data[firsts[query] + place])
        there = low < high
        query, low, high = query[there], low[there], high[there]
        if not len(query):
            break
    queries, hits = (np.concatenate(x) for x in zip(*found))
    both = np.unique(queries * len(index.delimiters) + hits)
    return both // len(index.delimiters), both % len(index.delimiters)
