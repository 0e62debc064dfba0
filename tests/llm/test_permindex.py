"""The index against brute force: recall, exact scores, ties and odd rows."""

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from meterflow.llm.permindex import PATIENCE, PIVOTS, STEP, Block, far_apart, lengthened, nearest, op8_permutation_index, query_orders

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def brute_force(rows, is_query, k=20):
    out = {}
    for i, v in rows:
        if is_query(i):
            scored = sorted((-float(np.dot(v, w)), j) for j, w in rows if j != i)
            out[i] = [(j, -s) for s, j in scored[:k]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_recall_on_the_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, np.array(r.embedding, float)) for r in table.collect()]
    v, ids = np.array([r[1] for r in rows]), np.array([r[0] for r in rows])
    got = found(op8_permutation_index(spark, "/root/testdata/sf0.1"))
    assert set(got) == {i for i in ids if i % 20 == 0}
    hits = total = 0
    for i, near in got.items():
        scores = v @ v[list(ids).index(i)]
        scores[ids == i] = -np.inf
        best = set(ids[np.lexsort((ids, -scores))[:20]])
        hits, total = hits + len(best & {j for j, _ in near}), total + 20
        assert len(near) == 20
    assert hits / total >= 0.9


def test_lengths_differ_and_candidates_are_few():
    rng = np.random.default_rng(1)
    v = rng.normal(size=(4000, 24)) * rng.uniform(0.2, 3, size=(4000, 1))
    longest = float(np.sqrt((v * v).sum(axis=1).max()))
    hits, scored = searched(v, np.arange(4000), range(50), longest)
    assert hits >= 0.9 and scored <= 0.6


def searched(v, ids, queries, longest):
    """(recall at 20, share of the vectors scored) of queries by the index of one block."""
    centers = far_apart(lengthened(v[:4096], longest), PIVOTS)
    block = Block.of(ids, v, centers, longest)
    hits = scored = 0
    for i, order in zip(queries, query_orders(v[list(queries)], centers)):
        rows, n = block.search(ids[i], v[i], order, 20, STEP, PATIENCE)
        s = v @ v[i]
        s[i] = -np.inf
        hits += sum(x >= np.sort(s)[-20] - 1e-12 for _, x in rows)
        scored += n
    return hits / 20 / len(queries), scored / len(queries) / len(block.vectors)


@pytest.mark.parametrize("n, most", [(4100, 0.45), (8192, 0.27), (20000, 0.13)])
@pytest.mark.parametrize("clustered", [False, True])
def test_few_vectors_are_scored(n, most, clustered):
    """Recall comes from the order by footrule: the share of vectors that are scored falls with the size of a block."""
    v, ids = drawn(n, n + 1, group=n // 3 if clustered else 0, spread=0.1)
    at = np.random.default_rng(2).permutation(n)
    hits, scored = searched(v[at], ids[at], range(100), 1.0)
    assert hits >= 0.93 and scored <= most


def test_only_files_of_the_query_are_read():
    v, ids = drawn(500, 5)
    centers = far_apart(v[:100], 40)
    block = Block.of(ids, v, lengthened(centers, 1.0), 1.0)
    order = query_orders(v[:1], lengthened(centers, 1.0))[0]
    places = [{p: block.prefix - k for k, p in enumerate(o)} for o in query_orders(block.vectors, lengthened(centers, 1.0))]
    want = [sum(min(w, block.prefix - k) for k, p in enumerate(order) if (w := own.get(p))) for own in places]
    assert block.by_footrule(order).tolist() == sorted(range(500), key=lambda i: (-want[i], i))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 2.0]), (40, [1.0, 1.0])] + [(i, [1.0, 0.5]) for i in range(100, 160)]
    odd = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0]), (None, [1.0, 0.0]), (60, None), (0, [1.0, 0.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows + odd], SCHEMA).withColumns({"block": F.lit(1), "v": F.lit("x")})
    got = found(nearest(df, "vec_id % 20 = 0"))
    want = brute_force([(i, np.array(v)) for i, v in rows], lambda i: i % 20 == 0)
    assert got == want
    assert nearest(df.limit(0), "vec_id % 20 = 0").collect() == []
    assert found(nearest(df.where("vec_id = 20"), "vec_id % 20 = 0")) == {}


def drawn(n, seed, group=0, spread=None, dims=64):
    """``n`` unit vectors; the first ``group`` of them are copies of one vector, or lie around it if there is a ``spread``."""
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, dims))
    v[:group] = v[0] if spread is None else v[0] + spread * rng.normal(size=(group, dims))
    v = v / np.linalg.norm(v, axis=1)[:, None]
    return v, rng.permutation(n)


def recall(spark, folder, v, ids, is_query="vec_id % 40 = 0", chosen=lambda i: i % 40 == 0):
    """Share of the true 20 best scores that the index reaches, for the queries that ``chosen`` picks; equal scores count alike."""
    path = f"{folder}/vectors.parquet"
    pq.write_table(pa.table({"vec_id": ids, "embedding": list(v)}), path, row_group_size=4096)
    got = found(nearest(spark.read.parquet(path), is_query))
    hits = total = 0
    for at in np.flatnonzero([chosen(i) for i in ids]):
        scores = v @ v[at]
        scores[at] = -np.inf
        least = np.sort(scores)[-20]
        hits, total = hits + sum(s >= least - 1e-12 for _, s in got[ids[at]]), total + 20
    return hits / total


def test_recall_outside_a_hot_group(spark, tmp_path):
    v, ids = drawn(8191, 3, group=2731)
    outside = set(ids[2731:])
    assert recall(spark, tmp_path, v, ids, chosen=lambda i: i % 40 == 0 and i in outside) >= 0.9


@pytest.mark.parametrize("n", [4100, 8192, 20000])
@pytest.mark.parametrize("clustered", [False, True])
def test_recall_by_size(spark, tmp_path, n, clustered):
    group = n // 3 if clustered else 0
    v, ids = drawn(n, n + group, group=group, spread=0.1)
    assert recall(spark, tmp_path, v, ids) >= 0.95


def test_equal_scores_of_many_blocks_go_by_id(spark, tmp_path):
    v, ids = drawn(17000, 7, group=6000)
    path = f"{tmp_path}/vectors.parquet"
    pq.write_table(pa.table({"vec_id": ids, "embedding": list(v)}), path)
    query = ids[0]
    got = found(nearest(spark.read.parquet(path), f"vec_id = {query}"))
    assert [j for j, _ in got[query]] == sorted(set(ids[:6000]) - {query})[:20]
