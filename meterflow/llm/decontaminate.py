"""Benchmark decontamination: rare n-grams as seeds, Smith-Waterman alignment as the judge.

A first pass over all texts counts how often each n-gram of the benchmark occurs in them. In every ``WINDOW`` consecutive n-grams of
an item the rarest one is a seed, so a long item has many seeds, none is left out for being frequent, and an edited copy
keeps some. A second pass looks all n-grams of all texts up among the seeds. Where one is met, the item is aligned with the words around that
place; the score tells what share of the best possible alignment is reached, whatever was replaced, dropped or put in.

The benchmark is a stated query set: it is taken in blocks of bounded size, and each block goes over all texts. Nothing but counts is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.llm.shared import small_batches
from meterflow.llm.textarrays import Words, chunks, utf8, words_of

GRAM = 3
WINDOW = 2
BLOCK_BYTES = 16 << 20
THRESHOLD = 0.5
# an alignment as good as so many words in a row counts, whatever share of its item it is
LONG_RUN = 25
# an item with fewer than GRAM words is searched as a whole if it has so many bytes; a shorter one ("yes") is no passage
SHORT_BYTES = 16
MATCH, MISMATCH, GAP = 2, -1, -1
MARGIN = 8
CELLS = 1 << 19
FILTER_BITS = 20


class Seeds:
    """Sorted n-gram hashes with the places they stand for, and a bit table that rejects most others at once."""

    def __init__(self, hashes: np.ndarray, at: np.ndarray):
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.at = hashes[order], at[order]
        self.table = np.zeros(1 << FILTER_BITS, bool)
        self.table[hashes >> np.uint64(64 - FILTER_BITS)] = True

    def meet(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index among ``grams``, place of the seed) of all meetings."""
        maybe = np.flatnonzero(self.table[grams >> np.uint64(64 - FILTER_BITS)])
        low = np.searchsorted(self.hashes, grams[maybe], "left")
        count = np.searchsorted(self.hashes, grams[maybe], "right") - low
        ends = np.cumsum(count)
        place = np.arange(ends[-1] if len(ends) else 0) + np.repeat(low - (ends - count), count)
        return np.repeat(maybe, count), self.at[place]


@dataclass
class Items:
    """Benchmark items of a block as lists of word hashes, one after another, and their n-grams."""

    ids: np.ndarray
    hashes: np.ndarray
    firsts: np.ndarray
    grams: np.ndarray
    gram_at: np.ndarray
    short: dict[int, Seeds]

    @classmethod
    def of(cls, ids: list[int], texts: list[str | None]) -> Items:
        words = words_of(*utf8(pa.array(texts, pa.string())), letters_only=True)
        short = {}
        for n in range(1, GRAM):
            whole = np.flatnonzero(np.diff(words.firsts) == n)
            whole = whole[words.ends[words.firsts[whole] + n - 1] - words.starts[words.firsts[whole]] >= SHORT_BYTES]
            if len(whole):
                hashes, at = words.grams(n)
                short[n] = Seeds(hashes[np.searchsorted(at, words.firsts[whole])], whole)
        return cls(np.array(ids, np.int64), words.hashes, words.firsts, *words.grams(GRAM), short)

    def item_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.firsts, at, "right") - 1


def rarest(items: Items, counts: tuple[np.ndarray, np.ndarray]) -> Seeds:
    """The rarest n-gram of every ``WINDOW`` consecutive ones of an item (of all, if it has fewer). ``counts``: sorted hashes and how often each occurs."""
    known, n = counts
    often = np.zeros(len(items.grams), np.int64)
    if len(known):
        at = np.minimum(np.searchsorted(known, items.grams), len(known) - 1)
        often = np.where(known[at] == items.grams, n[at], 0)
    owner = items.item_of(items.gram_at)
    bounds = np.searchsorted(owner, np.arange(len(items.ids) + 1))
    chosen = np.zeros(len(often), bool)
    for a, b in zip(bounds, bounds[1:]):
        for i in range(a, max(a + 1, b - WINDOW + 1)) if b > a else ():
            chosen[i + np.argmin(often[i : min(i + WINDOW, b)])] = True
    return Seeds(items.grams[chosen], items.gram_at[chosen])


def align(items: np.ndarray, regions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smith-Waterman score, and the end of the best alignment in the region, for rows of word hashes.

    Rows are padded at the end, items with 0 and regions with 1, which no word has. All rows go on together, word
    by word of the items; a gap along the region is a running maximum.
    """
    n, width = regions.shape
    along = -GAP * np.arange(width + 1, dtype=np.int32)
    row = np.zeros((n, width + 1), np.int32)
    best, end = np.zeros(n, np.int32), np.zeros(n, np.int64)
    for i in range(items.shape[1]):
        word = items[:, i : i + 1]
        step = row[:, :-1] + np.where(regions == word, MATCH, MISMATCH)
        new = np.zeros_like(row)
        np.maximum(step, row[:, 1:] + GAP, out=new[:, 1:])
        np.maximum(new, 0, out=new)
        new = np.maximum.accumulate(new + along, axis=1) - along
        row = np.where(word == 0, 0, new)
        top = row.argmax(axis=1)
        score = row[np.arange(n), top]
        better = score > best
        best[better], end[better] = score[better], top[better]
    return best, end


def hits(words: Words, items: Items, seeds: Seeds, threshold: float) -> Iterator[tuple[int, int, float, int, int]]:
    """(text, item, score, meetings, word at which the alignment ends) of each text and item with a score of at least ``threshold``, or an alignment as good as ``LONG_RUN`` words."""
    yield from aligned_hits(words, items, seeds, threshold)
    for n, whole in items.short.items():
        grams, at = words.grams(n)
        which, item = whole.meet(grams)
        text = np.searchsorted(words.firsts, at[which], "right") - 1
        order = np.lexsort((at[which], item, text))
        text, item, word = text[order], item[order], at[which][order]
        last = np.flatnonzero(np.append((text[1:] != text[:-1]) | (item[1:] != item[:-1]), True)[: len(text)])
        for a, b in zip(np.append(0, last[:-1] + 1), last):
            yield int(text[b]), int(item[b]), 1.0, int(b - a + 1), int(word[b] + n - words.firsts[text[b]])


def aligned_hits(words: Words, items: Items, seeds: Seeds, threshold: float) -> Iterator[tuple[int, int, float, int, int]]:
    """The hits of items with ``GRAM`` words or more."""
    grams, at = words.grams(GRAM)
    which, place = seeds.meet(grams)
    if not len(which):
        return
    word = at[which]
    text = np.searchsorted(words.firsts, word, "right") - 1
    item = items.item_of(place)
    shift = (word - words.firsts[text]) - (place - items.firsts[item])
    length = np.diff(items.firsts)[item]
    margin = MARGIN + length // 4
    # places whose shifts are near each other are one candidate
    order = np.lexsort((shift, item, text))
    text, item, shift, margin = text[order], item[order], shift[order], margin[order]
    same = np.append(False, (text[1:] == text[:-1]) & (item[1:] == item[:-1]))
    pair = np.cumsum(~same) - 1
    begin = np.empty(len(text), bool)
    anchor = None
    for i in range(len(text)):
        begin[i] = not same[i] or shift[i] - anchor > margin[i]
        anchor = shift[i] if begin[i] else anchor
    own = np.flatnonzero(begin)
    low = np.maximum(words.firsts[text] + shift - margin, words.firsts[text])[own]
    high = np.minimum(words.firsts[text] + shift + 2 * margin + np.diff(items.firsts)[item], words.firsts[text + 1])[own]
    best: dict[int, tuple[float, int]] = {}
    size = np.diff(items.firsts)[item[own]]
    by_size = np.argsort(size, kind="stable")
    a = 0
    while a < len(own):
        b = a + 1
        while b < len(own) and (b - a + 1) * int((high - low)[by_size[a : b + 1]].max()) <= CELLS:
            b += 1
        rows = by_size[a:b]
        left = _padded(items.hashes, items.firsts[item[own[rows]]], size[rows], 0)
        right = _padded(words.hashes, low[rows], (high - low)[rows], 1)
        score, end = align(left, right)
        for r, s, e in zip(rows, score / (MATCH * size[rows]), end):
            key = int(pair[own[r]])
            if s > best.get(key, (0.0, 0))[0]:
                best[key] = (float(s), int(low[r] + e - words.firsts[text[own[r]]]))
        a = b
    met = np.bincount(pair)
    sizes = np.diff(items.firsts)
    first = np.flatnonzero(~same)
    for key, (score, end) in sorted(best.items()):
        if score >= threshold or score * sizes[item[first[key]]] >= LONG_RUN:
            yield int(text[first[key]]), int(item[first[key]]), score, int(met[key]), end


def _padded(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray, fill: int) -> np.ndarray:
    out = np.full((len(starts), int(lengths.max())), fill, np.uint64)
    inside = np.arange(out.shape[1]) < lengths[:, None]
    out[inside] = values[(starts[:, None] + np.arange(out.shape[1]))[inside]]
    return out


def blocks_of(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[Items]:
    """The items in blocks of about ``block_bytes`` of text, each brought to the driver by itself."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id IS NOT NULL AND text <> ''")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // block_bytes)
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).distinct().orderBy("item_id", "text").collect()
        if rows:
            yield Items.of([r.item_id for r in rows], [r.text for r in rows])


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, item_id, score, seeds, end_word: each document and item whose alignment reaches ``threshold``, or is as good as ``LONG_RUN`` words in a row (part of a long item).

    score: the alignment's score (word met 2, other word -1, gap -1) by that of the whole item, 0 to 1. seeds: how many seeds met. end_word: how many words
    of the document lie before the alignment's end. Words are runs of letters, digits and bytes beyond ASCII, in small letters. Items
    with fewer than ``GRAM`` words are found as they are only (score 1), and not at all if they have fewer than ``SHORT_BYTES`` bytes. Missing texts are part of nothing. Repeated documents give repeated rows; repeated items count once. Missing ids of documents stay.
    """
    spark = small_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id bigint, item_id bigint, score double, seeds bigint, end_word bigint"
    found = spark.createDataFrame([], schema)
    for items in blocks_of(benchmark):
        seeds = rarest(items, gram_counts(texts, items))

        def search(batches: Iterator[pa.RecordBatch], items: Items = items, seeds: Seeds = seeds) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part, data, offsets in chunks(batch, 1):
                    rows = list(hits(words_of(data, offsets, letters_only=True), items, seeds, threshold))
                    if rows:
                        text, item, score, met, end = (np.array(c) for c in zip(*rows))
                        yield pa.RecordBatch.from_pydict({
                            "doc_id": part.column(0).take(pa.array(text)),
                            "item_id": pa.array(items.ids[item]),
                            "score": pa.array(score),
                            "seeds": pa.array(met, pa.int64()),
                            "end_word": pa.array(end, pa.int64()),
                        })

        found = found.union(texts.mapInArrow(search, schema))
    return found


def gram_counts(texts: DataFrame, items: Items) -> tuple[np.ndarray, np.ndarray]:
    """How often the block's n-grams occur in all texts: sorted hashes and counts, a number each for every n-gram of the block at most."""
    known = Seeds(*np.unique(items.grams, return_index=True))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(len(known.hashes), np.int64)
        for batch in batches:
            for _, data, offsets in chunks(batch, 0):
                grams, _ = words_of(data, offsets, letters_only=True).grams(GRAM)
                which, _ = known.meet(grams)
                totals += np.bincount(np.searchsorted(known.hashes, grams[which]), minlength=len(totals))
        some = np.flatnonzero(totals)
        yield pa.RecordBatch.from_pydict({"hash": pa.array(known.hashes[some].view(np.int64)), "n": pa.array(totals[some])})

    counted = texts.select("text").mapInArrow(count, "hash bigint, n bigint").groupBy("hash").agg(F.sum("n").alias("n"))
    found = counted.toArrow()
    hashes = found.column("hash").to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], found.column("n").to_numpy()[order]


def without_contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """All rows and columns of ``docs`` but the rows that ``contaminated`` would find; judged row by row, so repeated or missing ids do no harm."""
    spark = small_batches(docs.sparkSession)
    at = docs.columns.index("text")
    kept = docs
    for items in blocks_of(benchmark):
        seeds = rarest(items, gram_counts(docs.select(F.col("text").cast("string").alias("text")), items))

        def clean(batches: Iterator[pa.RecordBatch], items: Items = items, seeds: Seeds = seeds) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part, data, offsets in chunks(batch, at):
                    keep = np.ones(part.num_rows, bool)
                    keep[[h[0] for h in hits(words_of(data, offsets, letters_only=True), items, seeds, threshold)]] = False
                    yield part.filter(pa.array(keep))

        kept = kept.mapInArrow(clean, docs.schema)
    return kept


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
