"""Weights and draws against a plain version."""

import math
import re
import struct
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import functions as F

from meterflow.llm.importance import BUCKET_BITS, BUCKETS, op1_importance, resample
from meterflow.llm.textarrays import utf8, words_of

SF_DIR = "/root/testdata/sf0.001"


def grams(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    return [w.lower() for w in words] + [a.lower() + b" " + b.lower() for a, b in zip(words, words[1:])]


def test_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").toPandas()
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").toPandas()
    got = op1_importance(spark, SF_DIR).toPandas().set_index("doc_id")
    assert sorted(got.index) == sorted(docs.doc_id)
    assert (got.n_grams == docs.set_index("doc_id").text.map(lambda t: len(grams(t))).reindex(got.index)).all()
    share = labels.quality.mean()
    assert got.kept.sum() == round(share * len(docs))
    ordered = got.sort_values("rank")
    assert list(ordered["rank"]) == list(range(1, len(docs) + 1)) and (ordered.key.diff().dropna() <= 0).all()
    assert (ordered.kept == (ordered["rank"] <= got.kept.sum())).all()
    # the sum of logs over a text, from exact words instead of arrays
    import pyarrow as pa

    def bucket(text):
        w = words_of(*utf8(pa.array([text])))
        return [int(h) >> (64 - BUCKET_BITS) for h in [*w.hashes, *w.grams(2)[0]]]

    good = set(labels[labels.quality == 1].doc_id)
    raw, target = Counter(), Counter()
    buckets = {i: bucket(t) for i, t in docs.values}
    for i, b in buckets.items():
        raw.update(b)
        if i in good:
            target.update(b)
    n, m = sum(raw.values()), sum(target.values())
    for i in list(buckets)[:40]:
        want = sum(math.log((target[b] + 1) / (m + BUCKETS)) - math.log((raw[b] + 1) / (n + BUCKETS)) for b in buckets[i])
        assert abs(want - got.log_weight[i]) < 1e-6 * max(1, abs(want))


def test_key_and_rank(spark):
    """The noise from a hash of the row by another library, and the ranks from sorting the keys."""
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()}
    got = op1_importance(spark, SF_DIR).toPandas()

    def noise(doc_id):
        h = xxhash.xxh64_intdigest(struct.pack("<q", doc_id), 42)
        h = xxhash.xxh64_intdigest(docs[doc_id].encode(), h) if docs[doc_id] is not None else h
        h = xxhash.xxh64_intdigest(struct.pack("<i", 1), h)
        return -math.log(-math.log((h % (1 << 52) + 0.5) / (1 << 52)))

    want = {r.doc_id: r.log_weight + noise(r.doc_id) for r in got.itertuples()}
    assert all(abs(want[r.doc_id] - r.key) < 1e-9 * max(1, abs(r.key)) for r in got.itertuples())
    order = sorted(got.itertuples(), key=lambda r: (-r.key, r.doc_id))
    assert [r.rank for r in order] == list(range(1, len(order) + 1))


def test_bound_of_targets(spark):
    """More good rows than the bound: a fixed choice of them makes the target model; all rows make the raw one and get a weight."""
    docs = spark.createDataFrame([(i, f"w{i} common") for i in range(60)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id bigint, quality int, toxic int")
    few, again, whole = (resample(docs, labels, 0.5, n).toPandas().set_index("doc_id").log_weight for n in (5, 5, 40))
    assert (few == again).all() and (few.nlargest(5).index < 40).all() and len(few) == 60
    assert set(whole.nlargest(40).index) == set(range(40))


def test_good_texts_are_drawn_more_often(spark):
    rows = [(i, ("good words here " if i % 2 else "bad junk there ") * 5) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(100)], "doc_id bigint, quality int, toxic int")
    kept = resample(docs, labels).where("kept").toPandas()
    assert len(kept) == 200 and (kept.doc_id % 2 == 1).mean() > 0.9
    noise = resample(docs, labels).selectExpr("key - log_weight AS g").toPandas().g
    assert abs(noise.mean() - 0.5772) < 0.25 and abs(noise.std() - np.pi / np.sqrt(6)) < 0.25


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "a"), (3, "a"), (None, "b c"), (5, "w " * 100_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"key": F.lit(1), "quality": F.lit(9)})
    labels = spark.createDataFrame([(3, 1, None), (5, 0, None), (None, 1, 1), (2, None, 0)], "doc_id bigint, quality int, toxic int")
    got = resample(docs, labels).collect()
    assert sorted((r.doc_id or 0, r.n_grams) for r in got) == [(0, 3), (1, 0), (2, 0), (3, 1), (3, 1), (5, 199_999)]
    assert sum(r.kept for r in got) == 3 and sorted(r["rank"] for r in got) == [1, 2, 3, 4, 5, 6]
    assert all(r.log_weight == 0 for r in resample(docs, labels.limit(0)).collect()) and resample(docs, labels.limit(0)).where("kept").count() == 6
    assert resample(docs.limit(0), labels).collect() == []
