"""Training on planted words, held-out accuracy, odd rows."""

import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from meterflow.llm import toxicity as T
from meterflow.llm.textarrays import utf8, words_of
from meterflow.llm.toxicity import fit, op7_toxicity, score_texts, without_toxic

LABELS = "doc_id bigint, quality int, toxic int"


def planted(n, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(500)]
    rows, labels = [], []
    for i in range(n):
        text = rng.choices(words, k=rng.randint(5, 80))
        toxic = int(rng.random() < 0.15)
        for _ in range(2 * toxic):
            text.insert(rng.randrange(len(text)), rng.choice(["Scum", "rot!", "vile,"]))
        rows.append((i, " ".join(text)))
        labels.append((i, 1, toxic))
    return rows, labels


def auc(pairs):
    order = sorted(pairs)
    positive = sum(y for _, y in order)
    ranks = sum(k + 1 for k, (_, y) in enumerate(order) if y)
    return (ranks - positive * (positive + 1) / 2) / (positive * (len(order) - positive))


def plain_train(positive, unlabelled, prior, steps):
    """The non-negative risk step by step, text by text, with Adam written out for each weight."""
    n, m = len(positive), len(unlabelled)
    used = set()
    counts = {b: (sum(b in x for x in positive), sum(b in x for x in unlabelled)) for b in {b for x in positive + unlabelled for b in x}}
    apart = {}
    for b, (k, j) in counts.items():
        p = (k + j) / (n + m)
        apart[b] = abs(k / n - j / m) / math.sqrt(max(p * (1 - p), 1 / (n + m)) * (1 / n + 1 / m))
    least = max(T.LEAST_DEVIATIONS, sorted([*apart.values(), *[0.0] * T.MOST_WORDS])[-T.MOST_WORDS])
    used = {b for b in counts if apart[b] >= least and sum(counts[b]) >= T.LEAST_TEXTS} | {"bias"}
    w = dict.fromkeys([*counts, "bias"], 0.0)
    w["bias"] = math.log(prior / (1 - prior))
    first, second = dict.fromkeys(w, 0.0), dict.fromkeys(w, 0.0)
    rng = np.random.Generator(np.random.PCG64(17))
    sig = lambda z: 1 / (1 + math.exp(-z))
    for t in range(1, steps + 1):
        some, others = ([x[i] for i in sorted(rng.permutation(len(x))[: T.BATCH])] for x in (positive, unlabelled))
        score = lambda x: sum(w[b] for b in x) + w["bias"]
        clean = sum(math.log1p(math.exp(score(x))) for x in others) / len(others) - prior * sum(math.log1p(math.exp(score(x))) for x in some) / len(some)
        g = dict.fromkeys(w, 0.0)
        for x in some:
            z = score(x)
            slope = (-prior * sig(-z) - prior * sig(z)) / len(some) if clean >= 0 else prior * sig(z) / len(some)
            for b in [*x, "bias"]:
                g[b] += slope
        for x in others:
            slope = sig(score(x)) / len(others) * (1 if clean >= 0 else -1)
            for b in [*x, "bias"]:
                g[b] += slope
        for b in w:
            first[b] = 0.9 * first[b] + 0.1 * g[b]
            second[b] = 0.999 * second[b] + 0.001 * g[b] ** 2
            if b in used:
                w[b] -= T.RATE * (first[b] / (1 - 0.9**t)) / (math.sqrt(second[b] / (1 - 0.999**t)) + 1e-8)
            if b != "bias":
                w[b] *= 1 - T.DECAY
    return w


@pytest.mark.parametrize("prior", [0.3, 0.9])
def test_training_against_plain_version(prior):
    rng = random.Random(5)
    common = [rng.sample(range(100, 160), 6) for _ in range(60)]
    positive = [sorted({*x, *rng.sample([1, 2, 3], 2)}) for x in common[:25]]
    unlabelled = [sorted({*x, *([1, 3] if k % 4 == 0 else [])}) for k, x in enumerate(common)]
    rows = [T.Rows.of([np.array(x, np.uint16).tobytes() for x in side]) for side in (positive, unlabelled)]
    want = plain_train(positive, unlabelled, prior, 30)
    got = T.train(*rows, prior, 30)
    # (the bias begins where its slope is 0, so the first step of Adam takes the sign of rounding; it fades)
    assert abs(got[-1] - want["bias"]) < 0.05 and all(abs(got[b] - v) < 0.05 for b, v in want.items() if b != "bias")
    assert {b for b, v in want.items() if v} - {"bias"} == set(np.flatnonzero(got[:-1])) and max(abs(v) for b, v in want.items() if b != "bias") > 0.4
    one = plain_train(positive, unlabelled, prior, 1)
    assert all(abs(T.train(*rows, prior, 1)[b] - v) < 1e-9 for b, v in one.items() if b != "bias")


def test_query_scores_against_plain_sums(spark):
    """Each text's score from the distinct words of the whole text, one by one."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    w, a, b = T.fit(docs, labels)
    got = {r.doc_id: r for r in op7_toxicity(spark, "/root/testdata/sf0.001").collect()}
    for r in docs.collect():
        words = set(re.findall(rb"[0-9a-z\x80-\xff]+", (r.text or "").encode().lower()))
        hashes = [int(words_of(*utf8(pa.array([x.decode("utf-8", "ignore")])), letters_only=True).hashes[0]) >> (64 - T.FEATURE_BITS) for x in words]
        z = sum(w[h] for h in set(hashes)) + w[-1]
        score = 1 / (1 + math.exp(-max(-60, min(60, a * z + b))))
        assert abs(score - got[r.doc_id].score) < 1e-9 and got[r.doc_id].predicted == int(score >= 0.3)


def test_held_out(spark):
    rows, labels = planted(3000, 3)
    docs, marks = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, LABELS)
    model = fit(docs, marks)
    got = score_texts(docs, model).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in got)
    toxic = {i: t for i, _, t in labels}
    held = [(r.score, toxic[r.doc_id]) for r in got if r.held_out]
    assert auc(held) > 0.97
    assert sum((s >= 0.3) == t for s, t in held) / len(held) > 0.95
    # held-out labels do not matter
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, q, t in labels]
    again = {r.doc_id: r.score for r in score_texts(docs, fit(docs, spark.createDataFrame(flipped, LABELS))).collect()}
    assert again == {r.doc_id: r.score for r in got}
    kept = without_toxic(docs.withColumn("score", F.lit("x")), model)
    assert kept.columns == ["doc_id", "text", "score"] and {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if r.score < 0.3}


def test_table(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    got = op7_toxicity(spark, "/root/testdata/sf0.1").where("held_out").collect()
    assert auc([(r.score, labels[r.doc_id]) for r in got if r.doc_id in labels]) > 0.85


def test_odd_rows(spark):
    rows, labels = planted(400, 5)
    docs, marks = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame([*labels, (1, None, None), (None, 1, 1), (1, 1, 0)], LABELS)
    model = fit(docs, marks)
    odd = spark.createDataFrame([(1, None), (2, ""), (None, "scum rot vile"), (4, "scum " * 100_000), (4, "scum " * 100_000)], "doc_id bigint, text string").withColumn("predicted", F.lit("x"))
    got = sorted(score_texts(odd, model).collect(), key=lambda r: r.doc_id or 0)
    assert [r.doc_id for r in got] == [None, 1, 2, 4, 4] and got[1].score == got[2].score < 0.3 and got[3].score == got[4].score and got[0].held_out is False
    assert score_texts(odd.limit(0), model).collect() == [] and without_toxic(odd.limit(0), model).collect() == []
    assert fit(docs, marks.limit(0)) == 0.0 and {r.score for r in score_texts(odd, 0.0).collect()} == {0.0}
