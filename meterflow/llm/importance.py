"""Quality by importance resampling with hashed n-grams.

Two bags of hashed words and pairs of words are counted: one over the target texts (those labelled as good), one over all raw texts. The
log of the ratio of both smoothed models, added up over a text's n-grams, is its importance weight. Adding independent Gumbel noise and taking the
largest sums draws texts without replacement, each in proportion to its weight (Gumbel top-k). The noise comes from a hash of doc_id and
text, so a run can be repeated and every task can draw by itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.llm.shared import small_batches, stored
from meterflow.llm.textarrays import Words, chunks, words_of
from meterflow.llm.totals import running_totals

BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
SMOOTHING = 1.0
# good rows that the target model is fitted on at most; their ids go to every task
MOST_TARGETS = 100_000


def hashed_grams(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Text and bucket of every word and every pair of words."""
    pairs, at = words.grams(2)
    n = np.diff(words.firsts)
    texts = np.repeat(np.arange(len(n)), n)
    buckets = np.concatenate([words.hashes, pairs]) >> np.uint64(64 - BUCKET_BITS)
    return np.concatenate([texts, texts[at]]), buckets.astype(np.int64)


def gram_totals(texts: DataFrame, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of all buckets over all texts, and over those whose doc_id is in ``targets`` (sorted). Texts are counted where they lie; tasks add up first, so no more than a row per bucket and task is shuffled."""
    small_batches(texts.sparkSession)
    shared = texts.sparkSession.sparkContext.broadcast(targets)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = shared.value
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for part, data, offsets in chunks(batch, 1):
                of, buckets = hashed_grams(words_of(data, offsets))
                raw += np.bincount(buckets, minlength=BUCKETS)
                known = np.array(part.column(0).is_valid())
                own = part.column(0).fill_null(0).to_numpy()
                if len(ids):
                    good = known & (ids[np.minimum(np.searchsorted(ids, own), len(ids) - 1)] == own)
                    target += np.bincount(buckets[good[of]], minlength=BUCKETS)
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(some.astype(np.int32)), "n": pa.array(raw[some]), "n_target": pa.array(target[some])})

    found = texts.mapInArrow(count, "bucket int, n bigint, n_target bigint").groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("n_target").alias("n_target")).toPandas()
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    at = found["bucket"].to_numpy(np.int64)
    raw[at], target[at] = found["n"].to_numpy(np.int64), found["n_target"].to_numpy(np.int64)
    return raw, target


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Log of the ratio of both models for each bucket."""
    p, q = (((c + SMOOTHING) / (c.sum() + SMOOTHING * BUCKETS)) for c in (target, raw))
    return np.log(p) - np.log(q)


def weigh(docs: DataFrame, ratio: np.ndarray) -> DataFrame:
    """doc_id, n_grams, log_weight for each row of ``docs``."""
    small_batches(docs.sparkSession)

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in chunks(batch, 1):
                texts, buckets = hashed_grams(words_of(data, offsets))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column(0),
                    "n_grams": pa.array(np.bincount(texts, minlength=part.num_rows).astype(np.int64)),
                    "log_weight": pa.array(np.bincount(texts, ratio[buckets], part.num_rows).astype(np.float64)),
                    "noise": part.column(2),
                })

    text = F.col("text").cast("string")
    # a number strictly between 0 and 1 from 52 bits of a hash, and the Gumbel noise it stands for
    share = (F.pmod(F.xxhash64("doc_id", text, F.lit(1)), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))
    noise = (-F.log(-F.log(share))).alias("noise")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), noise).mapInArrow(
        weighed, "doc_id bigint, n_grams bigint, log_weight double, noise double"
    )


def resample(docs: DataFrame, labels: DataFrame, share: float | None = None, most_targets: int = MOST_TARGETS) -> DataFrame:
    """doc_id, n_grams, log_weight, key, rank (from 1), kept for each row of ``docs`` (doc_id, text).

    The target are the texts with quality 1 in ``labels``, at most ``most_targets`` of them, chosen by a hash of doc_id; the raw model is counted over all texts. ``share`` of the rows are kept (rounded to the nearest number): those with the largest key,
    which is log_weight plus Gumbel noise; by default the share of quality 1 among all labels. Ties go to the smaller doc_id. A text
    without words has weight 1 (log 0), as has every text if there are no good texts. Repeated rows have equal keys and ranks in a row. Without labels
    all rows are kept.
    """
    good = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("quality").alias("quality"))
    if share is None:
        found = good.agg(F.avg(F.col("quality").cast("double"))).first()[0]
        share = 1.0 if found is None else float(found)
    ids = good.where("quality = 1").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_targets).select("doc_id").toArrow().column(0).to_numpy()
    raw, target = gram_totals(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")), np.sort(ids))
    ratio = log_ratio(target, raw) if target.any() else np.zeros(BUCKETS)
    keyed = stored(weigh(docs, ratio).select("doc_id", "n_grams", "log_weight", (F.col("log_weight") + F.col("noise")).alias("key")), "weights")
    placed = running_totals(keyed.select("*", (-F.col("key")).alias("_down"), F.lit(1).alias("_one")), ["_down", "doc_id"], {"_before": "_one"})
    keep = round(share * keyed.count())
    return placed.select("doc_id", "n_grams", "log_weight", "key", (F.col("_before") + 1).alias("rank"), (F.col("_before") < keep).alias("kept"))


def op1_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
