"""Words of many texts at once, as numpy arrays over the UTF-8 bytes of an Arrow column."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 22
SPAN_BYTES = 1 << 18
_RATIO = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1

# White space that parts words (0x20 and 0x09 to 0x0D), and A to Z.
SPACES = [0x20, *range(0x09, 0x0E)]
CAPITALS = range(0x41, 0x5B)


def mix(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers that spreads every bit over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeded(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    at = np.arange(1, n + 1, dtype=np.uint64) + np.uint64((seed * 0x632BE59BD9B4E019) & _MASK)
    return mix(at * np.uint64(_RATIO))


@lru_cache(4)
def byte_values(letters_only: bool) -> tuple[np.ndarray, np.ndarray]:
    """For each byte: a random number, the same for a capital and its small letter; whether it parts words."""
    values = seeded(7, 256)
    values[list(CAPITALS)] = values[[c + 32 for c in CAPITALS]]
    parts = np.zeros(256, bool)
    parts[SPACES] = True
    if letters_only:
        parts[:128] = True
        parts[[*range(0x30, 0x3A), *CAPITALS, *range(0x61, 0x7B)]] = False
    return values, parts


@lru_cache(1)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd ratio modulo 2**64, and of its inverse."""
    ratio = np.full(n, _RATIO, np.uint64)
    inverse = np.full(n, pow(_RATIO, -1, 1 << 64), np.uint64)
    ratio[0] = inverse[0] = 1
    return np.multiply.accumulate(ratio), np.multiply.accumulate(inverse)


@dataclass
class Words:
    """Words of texts: their bytes (``data[start:end]``), a hash of each, and the first word of each text (with the end)."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    firsts: np.ndarray

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``n`` words within a text, and the word each begins with."""
        total = len(self.hashes)
        if total < n:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        left = np.repeat(self.firsts[1:], np.diff(self.firsts)) - np.arange(total)
        at = np.flatnonzero(left >= n)
        out = np.zeros(len(at), np.uint64)
        for j, factor in enumerate(seeded(11, n) | np.uint64(1)):
            out += self.hashes[at + j] * factor
        return mix(out), at


def words_of(data: np.ndarray, offsets: np.ndarray, letters_only: bool = False, parting: np.ndarray | None = None) -> Words:
    """Words of the texts ``data[offsets[i]:offsets[i + 1]]``; a word ends at white space, or at all ASCII but letters and digits, or at the bytes that ``parting`` marks."""
    values, parts = byte_values(letters_only)
    parts = parts if parting is None else parting
    data = data[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    n = len(data)
    if not n:
        none = np.empty(0, np.int64)
        return Words(data, none, none, np.empty(0, np.uint64), np.zeros(len(offsets), np.int64))
    inner = ~parts[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    begins = inner.copy()
    begins[1:] &= parts[data[:-1]] | edge[1:n]
    stops = inner.copy()
    stops[:-1] &= parts[data[1:]] | edge[1:n]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    hashes = np.empty(len(starts), np.uint64)
    a = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + SPAN_BYTES, "right")))
        base, stop = starts[a], ends[b - 1]
        up, down = powers(max(SPAN_BYTES, int(stop - base)))
        sums = np.empty(stop - base + 1, np.uint64)
        sums[0] = 0
        np.cumsum(values[data[base:stop]] * up[: stop - base], out=sums[1:])
        hashes[a:b] = (sums[ends[a:b] - base] - sums[starts[a:b] - base]) * down[starts[a:b] - base]
        a = b
    hashes = mix(hashes ^ (ends - starts).astype(np.uint64) * np.uint64(_RATIO))
    return Words(data, starts, ends, hashes, np.searchsorted(starts, offsets))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a missing text is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if offsets else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)), at


def chunks(batch: pa.RecordBatch, text: int, size: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of a batch with about so many bytes of text (one row at least), with the text's bytes and offsets."""
    if not batch.num_rows:
        return
    data, offsets = utf8(batch.column(text))
    a = 0
    while a < batch.num_rows:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + size, "right")) - 1)
        b = min(b, batch.num_rows)
        yield batch.slice(a, b - a), data, offsets[a : b + 1]
        a = b
