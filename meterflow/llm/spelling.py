"""Spelling variants: words at one error, found by search schemes over bidirectional FM-indexes, and the form that each word belongs to.

An error lies in one half of a word, so the other half is there as it is. One direction matches the first half and extends to the right over the second with one error,
the other one matches the second half and extends to the left. For each direction the vocabulary lies in shards, ranges of words (of reversed words for the second one), each with an index of its own,
and a word is searched in those shards only whose range meets its exact half.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.llm.fmindex import FMIndex, near
from meterflow.llm.shared import small_batches, stored
from meterflow.llm.textarrays import CAPITALS, chunks

MIN_LENGTH = 5
MIN_COUNT = 3
TYPO_MODULUS = 97
GROWTH = 2
# words of a shard's index, and searches in one task
SHARD_WORDS = 1 << 14
SHARD_SEARCHES = 1 << 15
_SHORT = 64

_DOWN = np.arange(256, dtype=np.uint8)
_DOWN[list(CAPITALS)] += 32
_LETTER = np.zeros(256, bool)
_LETTER[[*CAPITALS, *range(0x61, 0x7B)]] = True
_LEAD = 0xC3  # of U+00C0 to U+00FF in UTF-8


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def _checksums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> np.ndarray:
    """crc32 of each ``data[start:end]``, going on from the checksum ``before``."""
    sizes = ends - starts
    out = before.copy()
    for i in np.flatnonzero(sizes > _SHORT):
        out[i] = zlib.crc32(data[starts[i] : ends[i]].tobytes(), int(before[i]))
    order = np.argsort(-sizes, kind="stable")
    order = order[np.searchsorted(-sizes[order], -_SHORT) :]
    state, heads, left = ~before[order], starts[order], -sizes[order]
    for place in range(_SHORT):
        n = int(np.searchsorted(left, -place))  # those with more than ``place`` bytes
        if not n:
            break
        state[:n] = _CRC[(state[:n] ^ data[heads[:n] + place]) & 0xFF] ^ (state[:n] >> 8)
    out[order] = ~state
    return out.astype(np.int64)


def _runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes in lower case, start and end of each run of letters, text it is in)."""
    data = data[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    lead = data == _LEAD
    inner = _LETTER[data] | lead
    inner[1:] |= lead[:-1]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins, stops = inner.copy(), inner.copy()
    begins[1:] &= ~inner[:-1] | edge[1:-1]
    stops[:-1] &= ~inner[1:] | edge[1:-1]
    starts = np.flatnonzero(begins)
    return _DOWN[data], starts, np.flatnonzero(stops) + 1, np.searchsorted(offsets, starts, "right") - 1


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, modulus: int = TYPO_MODULUS) -> DataFrame:
    """word, n of all words of ``min_length`` or more code points in ``docs`` (doc_id, text)."""
    small_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in chunks(batch, 1):
                data, starts, ends, text = _runs(data, offsets)
                if not len(starts):
                    continue
                heads = np.array([zlib.crc32(f"{i}:".encode()) for i in part.column(0).to_pylist()], np.uint32)
                sums = _checksums(data, starts, ends, heads[text])
                changed = sums % modulus == 0
                shorter: Counter = Counter()
                for i in np.flatnonzero(changed):
                    word = data[starts[i] : ends[i]].tobytes().decode()
                    at = int(sums[i]) % len(word)
                    shorter[word[:at] + word[at + 1 :]] += 1
                leads = np.concatenate([[0], np.cumsum(data == _LEAD)])
                kept = ~changed & (ends - starts - (leads[ends] - leads[starts]) >= min_length)
                starts, sizes = starts[kept], (ends - starts)[kept]
                places = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
                own = data[np.repeat(starts - places[:-1], sizes) + np.arange(places[-1])]
                coded = pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(places), pa.py_buffer(own)).dictionary_encode()
                n = np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary))
                yield pa.RecordBatch.from_pydict({"word": coded.dictionary.cast(pa.string()), "n": pa.array(n)})
                rest = {w: k for w, k in shorter.items() if len(w) >= min_length}
                yield pa.RecordBatch.from_pydict({"word": pa.array(list(rest), pa.string()), "n": pa.array(list(rest.values()), pa.int64())})

    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _turned(word: bytes, direction: int) -> bytes:
    return word[::-1] if direction else word


def _exact(length: int, direction: int) -> int:
    """Bytes that are matched as they are: the first half, or the second one (with the middle)."""
    return length - length // 2 if direction else length // 2


def _bounds(words: DataFrame, shards: int, direction: int) -> list[bytes]:
    """The first word of each range, for about ``shards`` equal ranges; the driver gets a word for each."""
    turned = F.reverse("word") if direction else F.col("word")
    ranged = words.select(turned.alias("word")).repartitionByRange(shards, "word")
    firsts = ranged.groupBy(F.spark_partition_id().alias("range")).agg(F.min("word").alias("word")).collect()
    return sorted(r["word"].encode("latin-1") for r in firsts)


def near_words(words: DataFrame, shard_words: int = SHARD_WORDS, shard_searches: int = SHARD_SEARCHES) -> DataFrame:
    """word, near, near_n: all ordered pairs of ``words`` (word, n; distinct) with exactly one inserted, deleted or replaced code point between them.

    Words consist of letters up to U+00FF. Shards have about ``shard_words`` words, whatever they are; where more than
    ``shard_searches`` words are searched in one, its index is built in several tasks.
    """
    shards = max(1, -(-words.count() // shard_words))
    bounds = [_bounds(words, shards, direction) for direction in (0, 1)]

    def targets(word: bytes, direction: int) -> range:
        turned = _turned(word, direction)
        half = turned[: _exact(len(word), direction)]
        own = bounds[direction]
        return range(max(0, bisect_right(own, half) - 1), max(1, bisect_right(own, half, key=lambda first: first[: len(half)])))

    def loads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter = Counter()
        for batch in batches:
            for word in batch.column(0).to_pylist():
                for direction in (0, 1):
                    n.update((direction, shard) for shard in targets(word.encode("latin-1"), direction))
        keys = list(n)
        yield pa.RecordBatch.from_pydict({"direction": pa.array([k[0] for k in keys], pa.int32()), "shard": pa.array([k[1] for k in keys], pa.int32()), "n": pa.array([n[k] for k in keys], pa.int64())})

    searched = words.select("word").mapInArrow(loads, "direction int, shard int, n bigint").groupBy("direction", "shard").agg(F.sum("n").alias("n")).collect()
    parts = {(r["direction"], r["shard"]): -(-r["n"] // shard_searches) for r in searched}

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each word to its own shard (once for each part), and to one part of every shard it is searched in."""
        for batch in batches:
            rows = []
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = word.encode("latin-1")
                for direction in (0, 1):
                    own = max(0, bisect_right(bounds[direction], _turned(data, direction)) - 1)
                    rows += [(direction, own, part, False, word, n) for part in range(parts.get((direction, own), 0))]
                    rows += [(direction, shard, zlib.crc32(data) % parts[direction, shard], True, word, n) for shard in targets(data, direction)]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.string(), pa.int64()))],
                    ["direction", "shard", "part", "search", "word", "n"],
                )

    def search(key: tuple, table: pa.Table) -> pa.Table:
        direction = key[0].as_py()
        mask = table.column("search").to_numpy()
        held, asked = table.filter(pa.array(~mask)), table.filter(pa.array(mask))
        words, queries = ([_turned(w.encode("latin-1"), direction) for w in t.column("word").to_pylist()] for t in (held, asked))
        if not words:
            return pa.table({"word": pa.array([], pa.string()), "near": pa.array([], pa.string()), "near_n": pa.array([], pa.int64())})
        exact = np.array([_exact(len(q), direction) for q in queries], np.int64)
        query, hit = near(FMIndex.of(words), queries, exact)
        return pa.table({"word": asked.column("word").take(pa.array(query)), "near": held.column("word").take(pa.array(hit)), "near_n": held.column("n").take(pa.array(hit))})

    rows = words.select("word", "n").mapInArrow(dealt, "direction int, shard int, part int, search boolean, word string, n bigint")
    pairs = rows.groupBy("direction", "shard", "part").applyInArrow(search, "word string, near string, near_n bigint")
    return pairs.groupBy("word", "near").agg(F.first("near_n").alias("near_n"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for ``forms`` (word, form): from each word along the forms to the last one. A round halves the ways; counts double with each form, so these are short."""
    at = stored(forms.select("word", F.coalesce("form", "word").alias("root")), "roots")
    while True:
        step = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        at = stored(at.join(step, "root").select("word", F.col("further").alias("root"), (F.col("further") != F.col("root")).alias("moved")), "roots")
        if at.where("moved").isEmpty():
            return at.select("word", "root")


def spelling_variants(
    docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, modulus: int = TYPO_MODULUS, shard_words: int = SHARD_WORDS, shard_searches: int = SHARD_SEARCHES
) -> DataFrame:
    """word, n, n_near, form, form_n, root of each word of ``docs`` (doc_id, text).

    Words are runs of Latin letters up to U+00FF, A to Z in lower case, with ``min_length`` code points and ``min_count`` occurrences or more; a run whose checksum with its document's id
    is divisible by ``modulus`` has lost a code point. A missing doc_id counts as an empty one, a missing text as none; repeated rows count each time; other columns, whatever their names, play no
    part; an empty table has no words. Near words differ by one code point; form is the most frequent of them (ties: the smallest) if it occurs at least twice as often.
    """
    words = stored(word_counts(docs, min_length, modulus).where(F.col("n") >= min_count), "vocabulary")
    best = near_words(words, shard_words, shard_searches).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("low"), "near")).alias("best"))
    joined = words.join(best, "word", "left")
    is_form = -F.col("best.low") >= F.col("n") * GROWTH
    forms = stored(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.low")).alias("form_n"),
    ), "forms")
    return forms.join(_roots(forms), "word").select("word", "n", "n_near", "form", "form_n", "root")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return spelling_variants(docs).select("word", "form", "root", "n", "n_near", "form_n")


# Replaced: equal words once the same place is left out. One more or less: the shorter word is the longer one with a place left out.
OP13_SQL = f"""
WITH RECURSIVE table_ AS (
    SELECT list(v ORDER BY i) AS t FROM (
        SELECT i, list_reduce(list_prepend(i, range(8)), lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v FROM range(256) r(i))
),
runs AS (
    SELECT coalesce(doc_id::VARCHAR, '') AS doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents
),
per_doc AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL),
hexed AS (SELECT *, hex(encode(doc_id || ':' || run)) AS x FROM per_doc),
bytes AS (SELECT *, list_transform(range(0, len(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT) AS b FROM hexed),
summed AS (
    SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda a, c: xor(t[(xor(a, c) & 255) + 1], a >> 8)), 4294967295) AS h FROM bytes, table_
),
results AS (SELECT CASE WHEN h % {TYPO_MODULUS} = 0 THEN substr(run, 1, h % len(run)) || substr(run, h % len(run) + 2) ELSE run END AS word, n FROM summed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM results WHERE len(word) >= {MIN_LENGTH} GROUP BY word HAVING sum(n) >= {MIN_COUNT}),
without AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, len(word) + 1)) AS i FROM words)),
pairs AS (
    SELECT a.word, b.word AS near, b.n AS near_n FROM without a JOIN without b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    UNION SELECT a.word, w.word, w.n FROM without a JOIN words w ON w.word = a.rest
    UNION SELECT w.word, a.word, a.n FROM without a JOIN words w ON w.word = a.rest
),
best AS (SELECT word, count(*) AS n_near, min_by(near, (-near_n, near)) AS near, max(near_n) AS near_n FROM pairs GROUP BY word),
forms AS (
    SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN near_n >= {GROWTH} * w.n THEN near END AS form, CASE WHEN near_n >= {GROWTH} * w.n THEN near_n END AS form_n
    FROM words w LEFT JOIN best USING (word)
),
ways AS (
    SELECT word, word AS root, form AS next FROM forms
    UNION ALL SELECT ways.word, forms.word, forms.form FROM ways JOIN forms ON forms.word = ways.next
)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n FROM forms f JOIN (SELECT word, root FROM ways WHERE next IS NULL) r USING (word)
"""
