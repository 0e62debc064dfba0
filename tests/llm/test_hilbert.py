"""Shards along the curve: the curve itself, sizes, slots and odd rows."""

import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from meterflow.llm.hilbert import curve_index, hilbert_shards, op9_hilbert


@pytest.mark.parametrize("n, bits", [(2, 3), (3, 2), (3, 3), (1, 3), (4, 1)])
def test_curve_visits_all_cells_in_unit_steps(spark, n, bits):
    cells = spark.range(1 << (n * bits)).select(*[F.expr(f"cast(shiftright(id, {i * bits}) & {(1 << bits) - 1} AS int)").alias(f"x{i}") for i in range(n)])
    rows = cells.select("*", curve_index([F.col(f"x{i}") for i in range(n)], bits).alias("h")).collect()
    path = [tuple(r)[:n] for r in sorted(rows, key=lambda r: r.h)]
    assert sorted(r.h for r in rows) == list(range(1 << (n * bits)))
    assert all(sum(abs(a - b) for a, b in zip(p, q)) == 1 for p, q in zip(path, path[1:]))


def laws(rows, docs, shards):
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs
    )
    slots, sizes = defaultdict(list), Counter()
    for r in rows:
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(shards))
    if rows:
        share = sum(sizes.values()) / shards
        assert all(abs(sizes[k] - share) <= 2 * max(r["size"] for r in rows) for k in range(shards))
    order = sorted(rows, key=lambda r: (r.shard, r.slot))
    assert [r.hilbert for r in order] == sorted(r.hilbert for r in rows)


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = op9_hilbert(spark, "/root/testdata/sf0.001").collect()
    laws(rows, [(r.doc_id, r.text) for r in docs.collect()], 8)
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}
    assert len({r.shard for r in rows}) == 8


def test_odd_rows(spark):
    rows = [(1, None, None, None, None), (None, "", "en", "a", 0), (2, "x" * 5000, "en", "a", 5000), (3, "é", "de", None, 1)] + [(4, "same", "en", "a", 4)] * 50
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").withColumns({"size": F.lit("x"), "place": F.lit(1)})
    laws(hilbert_shards(df, 4).collect(), [r[:2] for r in rows], 4)
    assert hilbert_shards(df.limit(0), 4).collect() == []


def test_no_python(spark):
    """(One-row tables are joined by broadcast: as scalar subqueries they run the totals' plans once more, which took too much memory on many partitions.)"""
    plan = op9_hilbert(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Python|Pandas|Arrow|CartesianProduct", plan)


def test_dimensions_that_are_not_there_and_long_texts(spark):
    rows = [(i, "x" * (1 if i else 200_000)) for i in range(40)]
    got = hilbert_shards(spark.createDataFrame(rows, "doc_id bigint, text string"), 4).collect()
    assert len(got) == 40 and {r.hilbert for r in got} == {0} and sum(r["size"] for r in got) == 200_001 + 39 * 2
    assert sorted((r.shard, r.slot) for r in got) == sorted((r.shard, k) for s in {r.shard for r in got} for k, r in enumerate(x for x in got if x.shard == s))
