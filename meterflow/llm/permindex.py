"""Nearest neighbours by a permutation index.

A vector is represented by its nearest pivots in order. Pivots are a bounded sample of the vectors, each chosen as far as can be from those before it, so that a crowd of like vectors gets few of
them. The index is cut into blocks; a block has an inverted file for each pivot: the vectors that have it among their nearest ones, each with its place there.
A query reads the files of its own nearest pivots, no others, and adds up for each vector it meets how near the two orders are: with places counted
down from ``prefix``, the induced footrule distance of two orders is a constant less twice the sum of the smaller place over all shared pivots.

Vectors are then scored exactly in the order of their footrule distance, some at a time, for as long as that still betters the ``k``-th best; after a few steps in a row
without any change the rest of the block is left alone. There is no number of candidates: a query that goes on finding better ones goes on.

Inner products are no angles when lengths differ; so each vector gets one more component that gives all the same length, and a query a zero.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterflow.llm.shared import stored

PIVOTS = 256
PREFIX = 64
# distinct vectors that pivots are chosen from
PIVOT_SAMPLE = 4096
# vectors scored at a time, and steps in a row without a better k-th one after which a query is done with a block
STEP = 128
PATIENCE = 6
BLOCK_VECTORS = 8192
# queries that go to all tasks at a time
BLOCK_QUERIES = 16384


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): the vectors that take part, in double precision.

    Vectors that are missing, empty or zero, or have a missing or non-finite component, take no part; nor do those without vec_id or with
    another number of components than most (the larger number, if two are as frequent).
    """
    v = vectors.select(F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<double>").alias("v")).where("vec_id IS NOT NULL AND v IS NOT NULL")
    finite = "forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity')) AND exists(v, x -> x <> 0)"
    v = v.where(finite).withColumn("dims", F.size("v"))
    common = v.groupBy("dims").count().orderBy(F.desc("count"), F.desc("dims")).first()
    return v.where(F.col("dims") == (common["dims"] if common else 0)).select("vec_id", "v")


def lengthened(v: np.ndarray, longest: float) -> np.ndarray:
    """Vectors with one more component, all of length ``longest``."""
    rest = np.sqrt(np.maximum(longest**2 - (v * v).sum(axis=1), 0))
    return np.hstack([v, rest[:, None]])


def orders(products: np.ndarray, prefix: int) -> np.ndarray:
    """The ``prefix`` pivots with the largest inner product, nearest first."""
    if prefix < products.shape[1]:
        near = np.sort(np.argpartition(-products, prefix - 1, axis=1)[:, :prefix], axis=1)
        return np.take_along_axis(near, np.argsort(-np.take_along_axis(products, near, 1), axis=1, kind="stable"), 1)
    return np.argsort(-products, axis=1, kind="stable")


def exact(v: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products, added up the same way wherever a vector lies, so that equal vectors of two blocks have equal scores."""
    return np.einsum("ij,j->i", v, q)


def far_apart(sample: np.ndarray, n: int) -> np.ndarray:
    """``n`` rows of ``sample`` (of one length): the first, then always the one whose nearest chosen row is farthest; all rows if there are no more."""
    chosen = [0]
    nearest_one = sample @ sample[0]
    while len(chosen) < min(n, len(sample)):
        nearest_one[chosen[-1]] = np.inf
        chosen.append(int(np.argmin(nearest_one)))
        nearest_one = np.maximum(nearest_one, sample @ sample[chosen[-1]])
    return sample[chosen]


@dataclass
class Block:
    """Distinct vectors with their ids (those of one vector in a row, smallest first), and the inverted files: for each pivot the vectors that name it, and prefix - place."""

    vectors: np.ndarray
    ids: np.ndarray
    id_bounds: np.ndarray
    posted: np.ndarray
    weights: np.ndarray
    file_bounds: np.ndarray
    prefix: int

    @classmethod
    def of(cls, ids: np.ndarray, v: np.ndarray, pivots: np.ndarray, longest: float) -> Block:
        by_id = np.argsort(ids, kind="stable")
        distinct, of = np.unique(v[by_id], axis=0, return_inverse=True)
        of = of.ravel()
        grouped = np.argsort(of, kind="stable")
        prefix = min(PREFIX, len(pivots))
        own = orders(lengthened(distinct, longest) @ pivots.T, prefix).ravel()
        by_pivot = np.argsort(own, kind="stable")
        return cls(
            distinct, ids[by_id][grouped], np.searchsorted(of[grouped], np.arange(len(distinct) + 1)),
            (by_pivot // prefix).astype(np.int32), (prefix - by_pivot % prefix).astype(np.int16), np.searchsorted(own[by_pivot], np.arange(len(pivots) + 1)), prefix,
        )

    def by_footrule(self, order: np.ndarray) -> np.ndarray:
        """All vectors, nearest by footrule to a query's order of pivots first; those that share no pivot with it come last."""
        shared = np.zeros(len(self.vectors), np.int16)
        for place, p in enumerate(order):
            file = slice(self.file_bounds[p], self.file_bounds[p + 1])
            shared[self.posted[file]] += np.minimum(self.weights[file], np.int16(self.prefix - place))
        return np.argsort(-shared, kind="stable")

    def search(self, query_id: int, q: np.ndarray, order: np.ndarray, k: int, step: int, patience: int) -> tuple[list[tuple[int, float]], int]:
        """((vec_id, score) of the ``k`` best found, how many vectors were scored)."""
        near = self.by_footrule(order)
        found = np.empty(0, np.int64)
        scores = np.empty(0)
        at, idle, least = 0, 0, -np.inf
        while at < len(near) and idle < patience:
            more = near[at : at + step]
            found, scores = np.concatenate([found, more]), np.concatenate([scores, exact(self.vectors[more], q)])
            at += len(more)
            # (one more than k: a query's own vector may be among them)
            if len(found) > k + 1:
                top = np.argpartition(-scores, k)
                # all that tie with the last one stay
                stay = scores >= scores[top[k]]
                found, scores = found[stay], scores[stay]
                idle = idle + 1 if scores.min() <= least else 0
                least = max(least, scores.min())
        rows: list[tuple[int, float]] = []
        best = np.argsort(-scores, kind="stable")
        for d, score in zip(found[best], scores[best]):
            if len(rows) >= k and score < rows[k - 1][1]:
                break
            # k + 1 of the ids suffice, as one may be the query's own
            rows += [(int(x), float(score)) for x in self.ids[self.id_bounds[d] : min(self.id_bounds[d + 1], self.id_bounds[d] + k + 1)] if x != query_id]
        rows.sort(key=lambda r: (-r[1], r[0]))
        return rows[:k], at


def query_orders(q: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return orders(np.hstack([q, np.zeros((len(q), 1))]) @ pivots.T, min(PREFIX, len(pivots)))


def nearest(vectors: DataFrame, is_query: str, k: int = 20, pivots: int = PIVOTS, step: int = STEP, patience: int = PATIENCE) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` nearest found for each vector for which the SQL condition ``is_query`` holds.

    Nearness is the inner product in double precision, ties go to the smaller vec_id; a query does not find its own vec_id. Pivots are chosen
    among the ``PIVOT_SAMPLE`` distinct vectors with the smallest hash, the only sample here: every vector is in the index. Scores are exact; ``step`` and ``patience`` tell how
    long a query goes on, see above. See
    ``usable`` for vectors that take no part. Repeated rows (one id, one vector) count once; an id with two vectors is two vectors. Equal
    vectors share a posting and are expanded in the order of their ids. Other columns of ``vectors`` are not looked at.

    Vectors are dealt to blocks by vec_id; queries go to all tasks, ``BLOCK_QUERIES`` at a time, so no vector is sent twice for them.
    """
    spark = vectors.sparkSession
    v = stored(usable(vectors).distinct(), "vectors")
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    sample = v.select("v").distinct().orderBy(F.xxhash64("v"), "v").limit(PIVOT_SAMPLE).toArrow()
    if not sample.num_rows:
        return spark.createDataFrame([], schema)
    facts = v.agg(F.count("*").alias("n"), F.count_if(F.expr(is_query)).alias("queries"), F.max(F.expr("aggregate(v, 0D, (a, x) -> a + x * x)")).alias("square")).first()
    longest = float(np.sqrt(facts["square"]))
    centers = far_apart(lengthened(_matrix(sample.column("v")), longest), pivots)
    blocks, parts = -(-facts["n"] // BLOCK_VECTORS), -(-facts["queries"] // BLOCK_QUERIES)
    index = v.repartition(blocks, "vec_id")
    found = None
    for part in range(parts):
        asked = v.where(is_query).where(F.pmod(F.xxhash64("vec_id"), F.lit(parts)) == part).toArrow()
        if asked.num_rows:
            hits = _searched(index, asked, centers, longest, k, step, patience)
            found = hits if found is None else found.unionByName(hits)
    if found is None:
        return spark.createDataFrame([], schema)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _matrix(column) -> np.ndarray:
    """A column of lists of one length as rows of numbers."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(float)


def _searched(index: DataFrame, asked: pa.Table, centers: np.ndarray, longest: float, k: int, step: int, patience: int) -> DataFrame:
    """query_id, vec_id, score: the best of each block for each query."""
    q = _matrix(asked.column("v"))
    shared = index.sparkSession.sparkContext.broadcast((asked.column("vec_id").to_numpy(), q, query_orders(q, centers), centers))

    def one_block(ids: list[np.ndarray], rows: list[np.ndarray]) -> pa.RecordBatch:
        query_ids, q, theirs, centers = shared.value
        block = Block.of(np.concatenate(ids), np.vstack(rows), centers, longest)
        out = [(i, *hit) for i, x, order in zip(query_ids.tolist(), q, theirs) for hit in block.search(i, x, order, k, step, patience)[0]]
        columns = list(zip(*out)) or [(), (), ()]
        return pa.RecordBatch.from_pydict({"query_id": pa.array(columns[0], pa.int64()), "vec_id": pa.array(columns[1], pa.int64()), "score": pa.array(columns[2], pa.float64())})

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows, n = [], [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            ids.append(batch.column(0).to_numpy())
            rows.append(_matrix(batch.column(1)))
            n += batch.num_rows
            if n >= 2 * BLOCK_VECTORS:
                yield one_block(ids, rows)
                ids, rows, n = [], [], 0
        if n:
            yield one_block(ids, rows)

    return index.mapInArrow(search, "query_id bigint, vec_id bigint, score double")


def op8_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id % 20 = 0")
