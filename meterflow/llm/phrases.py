"""Phrase collocations by tries that grow a word a level.

Words are counted first. Then, level by level, the frequent phrases of k words are made into double-array tries, in blocks of bounded size that are
broadcast one after another, and numpy walks all positions of a text down the trie at once. Where a position and the next one are both accepted, the k + 1 words there
are a candidate whose two parts of k words are frequent (Apriori); its bin is the accepting state with the word that follows. Tasks count bins and Spark sums them.
No list of candidates is made beforehand: joining frequent phrases that overlap makes, around a frequent word, as many pairs as it has
neighbours on both sides squared, nearly all of which are in no text.

Each row of a level carries the counts of its first and last 1, 2, ... words, so that all cuts are at hand without another join.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterflow.llm.doublearray import Trie, build
from meterflow.llm.shared import small_batches, stored
from meterflow.llm.textarrays import CAPITALS, Words, chunks, mix, words_of

MIN_COUNT = 100
MOST_WORDS = 5
TOP = 2000
COVER_PERCENT = 100
# phrases in a broadcast trie, which then has some 30 MB at most
BLOCK_PHRASES = 1 << 19
# distinct bins that a task holds before it passes them on
HELD_BINS = 1 << 20

# What ends a piece, and what parts words within one.
PIECE_ENDS = [*b".,;:!?", *range(0x0A, 0x0E)]
WORD_ENDS = [0x20, 0x09]


def _marks(values: list[int]) -> np.ndarray:
    out = np.zeros(256, bool)
    out[values] = True
    return out


_ENDS_PIECE, _PARTS = _marks(PIECE_ENDS), _marks(PIECE_ENDS + WORD_ENDS)
_DOWN = np.arange(256, dtype=np.uint8)
_DOWN[list(CAPITALS)] += 32


def _by_lang(batch: pa.RecordBatch) -> Iterator[tuple[str, Words, np.ndarray, np.ndarray]]:
    """For each language of a batch (lang, text): its words in parts of some MB, a symbol for each word (of this language), and how many words are left in its piece."""
    langs = batch.column(0)
    for lang in langs.unique().to_pylist():
        salt = np.uint64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))
        for _, data, offsets in chunks(batch.filter(pc.equal(langs, lang)), 1):
            words = words_of(data, offsets, parting=_PARTS)
            n = len(words.starts)
            if not n:
                continue
            ended = np.cumsum(_ENDS_PIECE[words.data])[words.starts]
            last = np.ones(n, bool)
            last[:-1] = ended[1:] != ended[:-1]
            last[words.firsts[1:][words.firsts[1:] > 0] - 1] = True
            ends = np.flatnonzero(last)
            left = np.repeat(ends, np.diff(np.concatenate([[-1], ends]))) - np.arange(n) + 1
            yield lang, words, mix(words.hashes ^ salt).astype(np.int64), left


def _texts(docs: DataFrame) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, word, symbol, n of every word of every language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, words, symbols, _ in _by_lang(batch):
                sizes = words.ends - words.starts
                offsets = np.concatenate([[0], np.cumsum(sizes)])
                bytes_ = _DOWN[words.data[np.repeat(words.starts - offsets[:-1], sizes) + np.arange(offsets[-1])]]
                texts = pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(bytes_))
                coded = texts.dictionary_encode()
                places = coded.indices.to_numpy()
                n = np.bincount(places, minlength=len(coded.dictionary))
                first = np.zeros(len(n), np.int64)
                first[places[::-1]] = np.arange(len(places))[::-1]
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([lang] * len(n)), "word": coded.dictionary.cast(pa.string()), "symbol": pa.array(symbols[first]), "n": pa.array(n),
                })

    found = _texts(docs).mapInArrow(count, "lang string, word string, symbol bigint, n bigint")
    return found.groupBy("lang", "word", "symbol").agg(F.sum("n").alias("n"))


def _merged(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(phrase, symbol, n) with one entry for each phrase and symbol."""
    phrase, symbol, n = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((symbol, phrase))
    phrase, symbol, n = phrase[order], symbol[order], n[order]
    new = np.ones(len(n), bool)
    new[1:] = (phrase[1:] != phrase[:-1]) | (symbol[1:] != symbol[:-1])
    heads = np.flatnonzero(new)
    return phrase[heads], symbol[heads], np.add.reduceat(n, heads)


def extension_counts(docs: DataFrame, trie: Trie, ids: np.ndarray, whole: bool) -> DataFrame:
    """phrase (its number in ``ids``), symbol of the word after it, n: how often, over all texts. With ``whole`` the trie holds all frequent phrases, and only candidates count."""
    shared = docs.sparkSession.sparkContext.broadcast((trie, ids))

    def batch_of(phrase: np.ndarray, symbol: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"phrase": pa.array(shared.value[1][phrase]), "symbol": pa.array(symbol), "n": pa.array(n)})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, _ = shared.value
        held: list = []
        size = 0
        for batch in batches:
            for _, _, symbols, left in _by_lang(batch):
                codes = trie.codes(symbols)
                phrases = trie.walk(codes, left)
                going = (phrases >= 0) & (left > trie.depth)
                if whole:
                    going[:-1] &= phrases[1:] >= 0
                at = np.flatnonzero(going)
                if not len(at):
                    continue
                if whole:
                    names, follow = trie.alphabet, codes[at + trie.depth]
                else:
                    names, follow = np.unique(symbols[at + trie.depth], return_inverse=True)
                bins, n = np.unique(phrases[at] * len(names) + follow, return_counts=True)
                held.append((bins // len(names), names[bins % len(names)], n))
                size += len(bins)
                if size > HELD_BINS:
                    held = [_merged(held)]
                    size = len(held[0][2])
                    if size > HELD_BINS // 2:
                        yield batch_of(*held[0])
                        held, size = [], 0
        if held:
            yield batch_of(*_merged(held))

    found = _texts(docs).mapInArrow(count, "phrase bigint, symbol bigint, n bigint")
    return found.groupBy("phrase", "symbol").agg(F.sum("n").alias("n"))


def _numbered(level: DataFrame, label: str) -> DataFrame:
    """The level as a written table; the numbers are written with it, so they hold."""
    return stored(level.withColumn("id", F.monotonically_increasing_id()), label)


def _blocks(level: DataFrame, block: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """(symbols of the phrases, their ids, whether these are all) for parts of about ``block`` phrases each."""
    n = level.count()
    parts = -(-n // block)
    for part in range(parts):
        chosen = level.where(F.pmod(F.xxhash64("id"), F.lit(parts)) == part) if parts > 1 else level
        table = chosen.select("id", "symbols").toArrow()
        if table.num_rows:
            symbols = table.column("symbols").combine_chunks()
            yield symbols.flatten().to_numpy().reshape(table.num_rows, -1), table.column("id").to_numpy(), parts == 1


def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT, most_words: int = MOST_WORDS, block: int = BLOCK_PHRASES) -> list[DataFrame]:
    """A table for each number of words from 1 on: id, lang, phrase, symbols, n, heads and tails (counts of the first and last 1, 2, ... words), head and tail (ids one level below).

    Only phrases with n >= ``min_count``; the first table has all_n (all words of the language) too.
    """
    words = stored(word_counts(docs), "words")
    clash = words.groupBy("symbol").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not clash.isEmpty():
        raise ValueError("two words have one symbol; choose other factors in textarrays")
    totals = words.groupBy("lang").agg(F.sum("n").alias("all_n"))
    first = words.where(F.col("n") >= min_count).join(totals, "lang")
    first = first.select("lang", F.col("word").alias("phrase"), F.array("symbol").alias("symbols"), "n", F.array("n").alias("heads"), F.array("n").alias("tails"),
                         F.lit(None).cast("bigint").alias("head"), F.lit(None).cast("bigint").alias("tail"), "all_n")
    levels = [_numbered(first, "phrases-1")]
    known = levels[0].select(F.col("symbols")[0].alias("symbol"), F.col("phrase").alias("word"))
    while len(levels) < most_words:
        below = levels[-1]
        found = None
        for symbols, ids, whole in _blocks(below, block):
            counts = stored(extension_counts(docs, build(symbols), ids, whole).where(F.col("n") >= min_count), "extensions")
            found = counts if found is None else found.union(counts)
        if found is None:
            break
        head = below.select(F.col("id").alias("phrase"), "lang", F.col("phrase").alias("words"), "symbols", "heads", "all_n")
        longer = found.join(head, "phrase").join(known, "symbol").select(
            "lang", F.concat_ws(" ", "words", "word").alias("phrase"), F.concat("symbols", F.array("symbol")).alias("symbols"), "n",
            F.concat("heads", F.array("n")).alias("heads"), F.col("phrase").alias("head"), "all_n",
        )
        rest = F.expr("substr(phrase, instr(phrase, ' ') + 1)")
        tail = below.select("lang", F.col("phrase").alias("rest"), F.col("tails").alias("below"), F.col("id").alias("tail"))
        longer = longer.withColumn("rest", rest).join(tail, ["lang", "rest"])
        longer = longer.select("lang", "phrase", "symbols", "n", "heads", F.concat("below", F.array("n")).alias("tails"), "head", "tail", "all_n")
        levels.append(_numbered(longer, f"phrases-{len(levels) + 1}"))
    return levels


# 1000 * a * n has no more than 38 digits; div rounds down
_SCORE = """
cast(1000 AS decimal(4,0)) * cast(n AS decimal(17,0)) * cast(all_n AS decimal(17,0))
    div (cast(get(heads, k - 1) AS decimal(19,0)) * cast(get(tails, size(tails) - k - 1) AS decimal(19,0)))
"""


def collocations(
    docs: DataFrame,
    min_count: int = MIN_COUNT,
    most_words: int = MOST_WORDS,
    top: int | None = TOP,
    cover_percent: int = COVER_PERCENT,
    block: int = BLOCK_PHRASES,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the phrases of 2 to ``most_words`` words that occur ``min_count`` times or more in the texts of a language.

    ``docs`` has lang and text; other columns play no part. A missing lang is ``und``, a missing text empty. n counts all words of the language, a the phrase; l and r its two parts
    at the cut with the lowest score, floor(1000 a n / (l r)), ties to the shorter first part. A phrase goes if a longer frequent one holds it and occurs
    at least ``cover_percent`` of its times. Each language's first ``top`` (all if None) by score, then a, then phrase. Repeated rows count
    each time; texts without words and empty tables give no rows.
    """
    levels = frequent_phrases(docs, min_count, most_words, block)
    scored = None
    for at, level in enumerate(levels[1:], 1):
        cuts = F.expr(f"""array_max(transform(sequence(1, size(heads) - 1), k -> named_struct(
            'low', -cast({_SCORE} AS bigint), 'first', -k, 'l', get(heads, k - 1), 'r', get(tails, size(tails) - k - 1))))""")
        rows = level.select("id", "lang", "phrase", F.col("n").alias("a"), cuts.alias("cut"), F.col("all_n").alias("n"))
        if at + 1 < len(levels):
            # what a longer phrase covers, one with a word more covers too
            above = levels[at + 1]
            both = above.select(F.col("head").alias("id"), F.col("n").alias("_n")).union(above.select("tail", "n")).groupBy("id").agg(F.max("_n").alias("_n"))
            rows = rows.join(both, "id", "left").where(F.col("_n").isNull() | (F.col("_n") * 100 < F.col("a") * cover_percent)).drop("_n")
        rows = rows.select("lang", "phrase", "a", "cut.l", "cut.r", "n", (-F.col("cut.low")).alias("score"))
        scored = rows if scored is None else scored.union(rows)
    if scored is None:
        return docs.sparkSession.createDataFrame([], "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(best))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "text"))


def oracle_sql(min_count: int = MIN_COUNT, most_words: int = MOST_WORDS, top: int = TOP, cover_percent: int = COVER_PERCENT) -> str:
    """The same in SQL: all phrases of all pieces, grouped."""
    return f"""
WITH texts AS (
    SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
),
pieces AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM texts),
runs AS (SELECT lang, list_filter(string_split_regex(piece, '[ \\x09]+'), lambda w: w <> '') AS w FROM pieces),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM runs),
grams AS (
    SELECT lang, w[i : i + m - 1] AS p, m FROM starts, (SELECT unnest(range(1, {most_words} + 1)) AS m) WHERE i + m - 1 <= len(w)
),
counts AS (SELECT lang, p, m, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= {min_count}),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM runs GROUP BY lang),
cuts AS (SELECT lang, p, m, f, unnest(range(1, m)) AS k FROM counts WHERE m > 1),
scored AS (
    SELECT c.lang, c.p, c.m, c.f AS a, l.f AS l, r.f AS r, n, k,
        (1000 * c.f::HUGEINT * n::HUGEINT) // (l.f::HUGEINT * r.f::HUGEINT) AS score
    FROM cuts c JOIN totals USING (lang)
    JOIN counts l ON l.lang = c.lang AND l.p = c.p[1 : k] JOIN counts r ON r.lang = c.lang AND r.p = c.p[k + 1 : c.m]
),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
inner_parts AS (
    SELECT lang, p[i : i + size - 1] AS p, max(f) AS over
    FROM (SELECT lang, p, m, f, size, unnest(range(1, m - size + 2)) AS i FROM counts, (SELECT unnest(range(2, {most_words})) AS size) WHERE m > size)
    GROUP BY ALL
),
kept AS (
    SELECT s.* FROM lowest s LEFT JOIN inner_parts o ON o.lang = s.lang AND o.p = s.p WHERE o.over IS NULL OR 100 * o.over < {cover_percent} * s.a
),
ranked AS (
    SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, n, score::BIGINT AS score FROM kept
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM ranked QUALIFY rank <= {top}
"""


OP12_SQL = oracle_sql()
