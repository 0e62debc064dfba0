"""Toxicity from confirmed examples and unlabelled text: non-negative positive-unlabelled learning.

A linear model over hashed words is trained in numpy. Confirmed toxic texts are the positives; the other side is
text without labels, in which some are toxic too. With the share of toxic texts (the class prior) the risk of the unseen clean texts is the risk
of the unlabelled as clean less the prior times the risk of the positives as clean. That estimate is kept from falling below zero: when it
does, the step goes the other way, so that the model does not learn the single positives by heart.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.llm.shared import small_batches
from meterflow.llm.textarrays import Words, chunks, words_of

FEATURE_BITS = 16
MOST_POSITIVE = 6_000
MOST_UNLABELLED = 12_000
MOST_CALIBRATION = 6_000
THRESHOLD = 0.3
STEPS, BATCH, RATE, DECAY = 400, 2048, 0.05, 1e-3
MOST_WORDS, LEAST_DEVIATIONS, LEAST_TEXTS = 256, 4.0, 4

HELD_OUT = "coalesce(crc32(cast(cast(doc_id AS string) AS binary)) % 4 = 2, false)"


def features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Text and bucket of each distinct hashed word of each text, in order."""
    texts = np.repeat(np.arange(len(words.firsts) - 1, dtype=np.uint64), np.diff(words.firsts))
    keys = np.unique((texts << np.uint64(FEATURE_BITS)) | (words.hashes >> np.uint64(64 - FEATURE_BITS)))
    return (keys >> np.uint64(FEATURE_BITS)).astype(np.int64), (keys & np.uint64((1 << FEATURE_BITS) - 1)).astype(np.int64)


def sums(weights: np.ndarray, texts: np.ndarray, buckets: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(texts, weights[buckets], n)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


@dataclass
class Rows:
    """Texts as lists of buckets, one after another."""

    buckets: np.ndarray
    starts: np.ndarray

    @classmethod
    def of(cls, lists: list[bytes]) -> Rows:
        arrays = [np.frombuffer(x, np.uint16) for x in lists]
        return cls(np.concatenate([np.empty(0, np.uint16), *arrays]).astype(np.int64), np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int64))

    def __len__(self) -> int:
        return len(self.starts) - 1

    def pick(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths = self.starts[which + 1] - self.starts[which]
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[which] - (ends - lengths), lengths)
        return np.repeat(np.arange(len(which)), lengths), self.buckets[at]


def telling(positive: Rows, unlabelled: Rows) -> np.ndarray:
    """The buckets whose share of texts differs most between both sides, in standard deviations; the others only add noise."""
    n, m = len(positive), len(unlabelled)
    a, b = (np.bincount(r.buckets, minlength=1 << FEATURE_BITS) for r in (positive, unlabelled))
    p = (a + b) / (n + m)
    deviations = np.abs(a / n - b / m) / np.sqrt(np.maximum(p * (1 - p), 1 / (n + m)) * (1 / n + 1 / m))
    least = max(LEAST_DEVIATIONS, np.sort(deviations)[-MOST_WORDS])
    return (deviations >= least) & (a + b >= LEAST_TEXTS)


def train(positive: Rows, unlabelled: Rows, prior: float, steps: int = STEPS) -> np.ndarray:
    """Weights of all buckets and, last, the bias, by Adam on the non-negative risk."""
    size = 1 << FEATURE_BITS
    usable = np.append(telling(positive, unlabelled), True)
    w = np.zeros(size + 1)
    w[-1] = np.log(prior / (1 - prior))
    m, v, t = np.zeros_like(w), np.zeros_like(w), 0
    rng = np.random.Generator(np.random.PCG64(17))
    for _ in range(steps):
        p, u = (np.sort(rng.permutation(len(r))[:BATCH]) for r in (positive, unlabelled))
        (pt, pb), (ut, ub) = positive.pick(p), unlabelled.pick(u)
        zp, zu = sums(w, pt, pb, len(p)) + w[-1], sums(w, ut, ub, len(u)) + w[-1]
        clean = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        up, uu = prior * sigmoid(zp) / len(p), sigmoid(zu) / len(u)  # slopes of the clean part
        if clean >= 0:
            gp, gu = -prior * sigmoid(-zp) / len(p) - up, uu
        else:
            gp, gu = up, -uu
        g = np.bincount(pb, gp[pt], size) + np.bincount(ub, gu[ut], size)
        g = np.append(g, gp.sum() + gu.sum())
        t += 1
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8) * usable
        w[:-1] *= 1 - DECAY
    return w


def calibrate(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift that turn sums into probabilities (logistic regression on one number, by Newton steps)."""
    if not len(z) or y.min() == y.max():
        return 1.0, 0.0
    a, b = 1.0, 0.0
    for _ in range(50):
        p = sigmoid(a * z + b)
        r, s = y - p, p * (1 - p) + 1e-9
        g = np.array([(r * z).sum() - 1e-3 * a, r.sum()])
        h = np.array([[(s * z * z).sum() + 1e-3, (s * z).sum()], [(s * z).sum(), s.sum()]])
        step = np.linalg.solve(h, g)
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float, float] | float:
    """Weights, slope and shift from the labels of rows that are not held out; a constant score where there are no positives.

    The only sample of this module: at most ``MOST_POSITIVE`` confirmed texts, ``MOST_UNLABELLED`` labelled rows whose labels are hidden (the unlabelled
    side), and ``MOST_CALIBRATION`` labelled rows for the calibration, each with the smallest hashes of doc_id; crc32 mod 4 = 3 is for calibration
    only. The class prior is the share of toxic among all labels that are not held out.
    """
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    known = known.where(f"NOT {HELD_OUT}").withColumn("tuning", F.expr("crc32(cast(cast(doc_id AS string) AS binary)) % 4 = 3"))
    prior = known.agg(F.avg("toxic")).first()[0] or 0.0
    if not 0 < prior < 1:
        return float(prior)

    def smallest(df: DataFrame, n: int, role: str) -> DataFrame:
        return df.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n).select("doc_id", "toxic", F.lit(role).alias("role"))

    sample = (
        smallest(known.where("NOT tuning AND toxic = 1"), MOST_POSITIVE, "positive")
        .union(smallest(known.where("NOT tuning"), MOST_UNLABELLED, "unlabelled"))
        .union(smallest(known.where("tuning"), MOST_CALIBRATION, "tuning"))
    )
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.join(F.broadcast(sample), "doc_id")  # bounded by the three numbers above

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in chunks(batch, 1):
                of, buckets = features(words_of(data, offsets, letters_only=True))
                bounds = np.searchsorted(of, np.arange(part.num_rows + 1))
                packed = [buckets[a:b].astype(np.uint16).tobytes() for a, b in zip(bounds, bounds[1:])]
                yield pa.RecordBatch.from_pydict({"doc_id": part.column(0), "toxic": part.column(2), "role": part.column(3), "buckets": pa.array(packed, pa.binary())})

    found = texts.mapInArrow(hashed, "doc_id bigint, toxic int, role string, buckets binary").toPandas()
    found = found.sort_values(["role", "doc_id"], kind="stable")
    side = {role: found[found.role == role] for role in ("positive", "unlabelled", "tuning")}
    if not len(side["positive"]) or not len(side["unlabelled"]):
        return float(prior)
    w = train(Rows.of(list(side["positive"].buckets)), Rows.of(list(side["unlabelled"].buckets)), prior)
    tuning = Rows.of(list(side["tuning"].buckets))
    z = sums(w, *tuning.pick(np.arange(len(tuning))), len(tuning)) + w[-1]
    return w, *calibrate(z, side["tuning"].toxic.to_numpy(float))


def score_texts(docs: DataFrame, model: tuple[np.ndarray, float, float] | float) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``docs`` (doc_id, text).

    The score looks at the words of the whole text only: runs of letters, digits and bytes beyond ASCII, in small letters. A missing or
    empty text has no words, so its score is that of the bias. Repeated rows stay; a missing doc_id is not held out. Other columns are not looked at.
    """
    small_batches(docs.sparkSession)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in chunks(batch, 2):
                if isinstance(model, float):
                    score = np.full(part.num_rows, model)
                else:
                    w, a, b = model
                    z = sums(w, *features(words_of(data, offsets, letters_only=True)), part.num_rows) + w[-1]
                    score = sigmoid(a * z + b)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column(0),
                    "held_out": part.column(1),
                    "score": pa.array(score),
                    "predicted": pa.array((score >= THRESHOLD).astype(np.int32)),
                })

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.expr(HELD_OUT).alias("held_out"), F.col("text").cast("string"))
    return rows.mapInArrow(scored, "doc_id bigint, held_out boolean, score double, predicted int")


def without_toxic(docs: DataFrame, model: tuple[np.ndarray, float, float] | float) -> DataFrame:
    """All rows and columns of ``docs`` whose score stays below ``THRESHOLD``; judged row by row as in ``score_texts``."""
    small_batches(docs.sparkSession)
    at = docs.columns.index("text")

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in chunks(batch, at):
                if isinstance(model, float):
                    score = np.full(part.num_rows, model)
                else:
                    w, a, b = model
                    score = sigmoid(a * (sums(w, *features(words_of(data, offsets, letters_only=True)), part.num_rows) + w[-1]) + b)
                yield part.filter(pa.array(score < THRESHOLD))

    return docs.mapInArrow(kept, docs.schema)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score_texts(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
