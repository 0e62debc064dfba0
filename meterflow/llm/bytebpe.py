"""Byte-level BPE encoding and decoding.

Pre-tokenisation uses no regular expression. Every code point becomes a symbol (its class and,
for white space and apostrophes, what follows it). A small automaton reads symbols; what a
block of symbols does to it is a function from state to state, and composing functions is
associative. So all blocks of a batch are reduced to functions side by side, a scan over the functions gives each block its
start state, and a second pass marks token starts.

The pieces are merged by rank; a piece seen before comes from a cache. Offsets of the pieces in
the UTF-8 text are kept, and ids are turned back into bytes by table lookup.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.llm.shared import small_batches

# symbols
LETTER, NUMBER, OTHER, SHORT, LONG, WHITE, SPACE, SINGLE = range(8)
# states
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_WHITE, AFTER_SPACE, ONE_LEFT, TWO_LEFT = range(8)

# Code points that the Unicode property White_Space holds.
WHITE_SPACE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# Endings that an apostrophe starts, by their length.
SHORT_ENDINGS = "stmd"
LONG_ENDINGS = ["re", "ve", "ll"]

BLOCK = 64
CACHE_PIECES = 500_000
CACHE_PIECE_BYTES = 64
CHUNK_CHARS = 1 << 20
LONG_PIECE = 100


@lru_cache(1)
def classes() -> np.ndarray:
    """Class of every code point: LETTER, NUMBER, WHITE or OTHER."""
    out = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, (c for c in range(0x110000) if not 0xD800 <= c < 0xE000)))
    for name, cls in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER)):
        for m in regex.finditer(name, every):
            out[ord(m[0][0]) : ord(m[0][-1]) + 1] = cls
    out[0xD800:0xE000] = OTHER
    out[WHITE_SPACE] = WHITE
    return out


@lru_cache(1)
def automaton() -> tuple[np.ndarray, np.ndarray]:
    """Next state and "a token starts here", both at ``symbol * 8 + state``; symbols from 8 on begin a text."""
    to = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHERS, SHORT: ONE_LEFT, LONG: TWO_LEFT, WHITE: IN_WHITE,
          SPACE: AFTER_SPACE, SINGLE: FRESH}
    stays = {(IN_LETTERS, LETTER), (IN_NUMBERS, NUMBER), (IN_OTHERS, OTHER), (IN_WHITE, WHITE)}
    nxt, start = np.zeros(128, np.uint8), np.zeros(128, bool)
    for symbol in range(8):
        for state in range(8):
            after, begins = to[symbol], (state, symbol) not in stays
            if state in (ONE_LEFT, TWO_LEFT):
                after, begins = state - 1 if state == TWO_LEFT else FRESH, False
            elif state in (IN_OTHERS, AFTER_SPACE) and symbol in (SHORT, LONG):
                after, begins = IN_OTHERS, False
            elif state == AFTER_SPACE and symbol in (LETTER, NUMBER, OTHER):
                begins = False
            nxt[symbol * 8 + state], start[symbol * 8 + state] = after, begins
            nxt[(symbol + 8) * 8 + state], start[(symbol + 8) * 8 + state] = to[symbol], True
    return nxt, start


def symbols(points: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Symbols of code points; ``begins`` has the places where texts begin."""
    n = len(points)
    if not n:
        return np.empty(0, np.uint8)
    cls = classes()[points]
    first = np.zeros(n + 1, bool)
    first[begins] = True
    first[n] = True
    # what follows in the same text; a text's end counts as white space
    follows = np.empty(n, np.uint8)
    follows[:-1] = cls[1:]
    follows[-1] = WHITE
    follows[first[1:]] = WHITE
    out = cls.copy()
    white = cls == WHITE
    lone = white & (follows != WHITE)
    out[lone] = SINGLE
    out[lone & (points == 32)] = SPACE
    marks = np.flatnonzero(points == 39)
    if len(marks):
        padded = np.append(points, [0, 0, 0])
        one, two = padded[marks + 1], padded[marks + 2]
        same = ~first[np.minimum(marks + 1, n)]
        same_two = same & ~first[np.minimum(marks + 2, n)]
        out[marks[same & np.isin(one, [ord(c) for c in SHORT_ENDINGS])]] = SHORT
        for a, b in LONG_ENDINGS:
            out[marks[same_two & (one == ord(a)) & (two == ord(b))]] = LONG
    out[begins[begins < n]] += 8
    return out


def token_starts(sym: np.ndarray) -> np.ndarray:
    """Places of the symbols at which tokens start."""
    n = len(sym)
    if not n:
        return np.empty(0, np.int64)
    nxt, start = automaton()
    rows = -(-n // BLOCK)
    grid = np.zeros(rows * BLOCK, np.intp)
    grid[:n] = sym
    grid = np.ascontiguousarray(grid.reshape(rows, BLOCK).T * 8)
    # what each block does to each of the states
    does = np.tile(np.arange(8, dtype=np.uint8)[:, None], (1, rows))
    for column in grid:
        does = nxt[column + does]
    # scan: after step k, does[:, i] covers the blocks i - 2**k + 1 .. i
    state = np.zeros(rows, np.uint8)
    if rows > 1:
        scanned, step = does, 1
        across = np.arange(rows)
        while step < rows:
            later = scanned.copy()
            later[:, step:] = scanned[scanned[:, :-step], across[step:]]
            scanned, step = later, step * 2
        state[1:] = scanned[FRESH, :-1]
    marks = np.empty((BLOCK, rows), bool)
    for i, column in enumerate(grid):
        at = column + state
        marks[i] = start[at]
        state = nxt[at]
    return np.flatnonzero(marks.T.ravel()[:n])


def piece_offsets(texts: list[str]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """UTF-8 of the texts joined, byte offsets of all pieces in it (with the end), and the first piece of each text (with the end)."""
    joined = "".join(texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = np.concatenate([[0], np.cumsum(lengths)])
    starts = token_starts(symbols(points, begins[:-1][lengths > 0]))
    width = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
    at = np.concatenate([[0], np.cumsum(width)])
    offsets = np.append(at[starts], at[-1])
    return joined.encode("utf-8", "surrogatepass"), offsets, np.searchsorted(starts, begins)


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file: base64 of a token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a piece: of all adjacent pairs the one with the lowest rank is merged, the leftmost first, until no pair has a rank."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    return merge_long(piece, ranks) if len(piece) > LONG_PIECE else merge_short(piece, ranks)


def merge_short(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    none = len(ranks) + 1
    cuts = list(range(len(piece) + 1))
    pairs = [ranks.get(piece[i : i + 2], none) for i in range(len(piece) - 1)]
    while pairs and (lowest := min(pairs)) < none:
        i = pairs.index(lowest)
        del cuts[i + 1], pairs[i]
        if i < len(pairs):
            pairs[i] = ranks.get(piece[cuts[i] : cuts[i + 2]], none)
        if i:
            pairs[i - 1] = ranks.get(piece[cuts[i - 1] : cuts[i + 1]], none)
    return [ranks[piece[a:b]] for a, b in zip(cuts, cuts[1:])]


def merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap, as the steps above take time with the square of the length."""
    n = len(piece)
    nxt, prev, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    alive = [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or (j := nxt[i]) >= n or end[j] != stop:
            continue  # one of the two has been merged meanwhile
        alive[j] = False
        end[i], nxt[i] = stop, nxt[j]
        if nxt[i] < n:
            prev[nxt[i]] = i
            if (r := ranks.get(piece[i : end[nxt[i]]])) is not None:
                heapq.heappush(heap, (r, i, end[nxt[i]]))
        if prev[i] >= 0 and (r := ranks.get(piece[prev[i] : stop])) is not None:
            heapq.heappush(heap, (r, prev[i], stop))
    return [ranks[piece[i : end[i]]] for i in range(n) if alive[i]]


class Codec:
    """Encoder and decoder of one vocabulary, with a bounded cache of pieces."""

    def __init__(self, path: str):
        self.ranks = read_ranks(path)
        size = max(self.ranks.values(), default=-1) + 1
        tokens = [b""] * size
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.token_length = np.fromiter(map(len, tokens), np.int64, size)
        self.token_at = np.concatenate([[0], np.cumsum(self.token_length)])
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.numbers = list(map(str, range(size)))
        self.cache: dict[bytes, bytes] = {}  # 32-bit ids: bytes, unlike lists, are nothing the garbage collector walks over

    def learn(self, pieces: set[bytes]) -> None:
        """Merge the pieces that the cache lacks. A full cache starts anew, so that its size is bounded."""
        if len(self.cache) >= CACHE_PIECES:
            self.cache.clear()
        for piece in pieces.difference(self.cache):
            self.cache[piece] = array("i", merge(piece, self.ranks)).tobytes()

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each text its ids, and the byte offset at which each piece begins."""
        data, offsets, firsts = piece_offsets(texts)
        bounds = offsets.tolist()
        pieces = [data[a:b] for a, b in zip(bounds, bounds[1:])]
        self.learn(set(pieces))
        known = self.cache.__getitem__
        for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist()):
            yield np.frombuffer(b"".join(map(known, pieces[a:b])), np.int32), offsets[a:b] - offsets[a : a + 1]
        for piece in pieces:
            if len(piece) > CACHE_PIECE_BYTES:
                self.cache.pop(piece, None)

    def decimals(self, ids: np.ndarray) -> str:
        return " ".join(map(self.numbers.__getitem__, ids.tolist()))

    def decode(self, ids: np.ndarray) -> bytes:
        length = self.token_length[ids]
        ends = np.cumsum(length)
        if not len(ends):
            return b""
        place = np.arange(ends[-1]) + np.repeat(self.token_at[ids] - (ends - length), length)
        return self.token_bytes[place].tobytes()


@lru_cache(2)
def codec(path: str) -> Codec:
    return Codec(path)


def groups_of(texts: list[str], chars: int = CHUNK_CHARS) -> Iterator[list[str]]:
    """The texts in order, in groups of about so many characters; a longer text is a group of its own."""
    group: list[str] = []
    size = 0
    for text in texts:
        if group and size + len(text) > chars:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text)
    if group:
        yield group


def encode_documents(docs: DataFrame, path: str, with_ids: bool = True) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_tokens, ids_sha256, decoded_sha256, token_ids, piece_offsets.

    ``path`` names the vocabulary file, which every executor must hold at that place. token_ids
    and piece_offsets (where in the UTF-8 text each piece begins) are left out if not ``with_ids``.
    A missing or empty text has no tokens and the digests of nothing. Repeated rows and repeated or missing ids
    stay as they are. Other columns of ``docs`` are not looked at.
    """
    small_batches(docs.sparkSession)
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    schema += ", token_ids array<int>, piece_offsets array<bigint>" if with_ids else ""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = codec(path)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            counts, hashes, decoded, ids_out, offsets_out = [], [], [], [], []
            for group in groups_of(texts):
                for ids, offsets in known.encode(group):
                    counts.append(len(ids))
                    hashes.append(hashlib.sha256(known.decimals(ids).encode()).hexdigest())
                    decoded.append(hashlib.sha256(known.decode(ids)).hexdigest())
                    if with_ids:
                        ids_out.append(ids)
                        offsets_out.append(offsets)
            names = {
                "doc_id": batch.column(0),
                "n_tokens": pa.array(counts, pa.int64()),
                "ids_sha256": pa.array(hashes, pa.string()),
                "decoded_sha256": pa.array(decoded, pa.string()),
            }
            if with_ids:
                names["token_ids"] = pa.array(ids_out, pa.list_(pa.int32()))
                names["piece_offsets"] = pa.array(offsets_out, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_pydict(names)

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(encoded, schema)


def decode_ids(rows: DataFrame, path: str, ids: str = "token_ids") -> DataFrame:
    """doc_id and decoded (binary) of rows with token ids. A missing list decodes to nothing."""
    small_batches(rows.sparkSession)

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = codec(path)
        for batch in batches:
            out = [known.decode(np.array(x or [], np.int64)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "decoded": pa.array(out, pa.binary())})

    return rows.select(F.col("doc_id").cast("bigint"), F.col(ids)).mapInArrow(decoded, "doc_id bigint, decoded binary")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), with_ids=False)
