"""Alignment against a plain version, planted copies, odd rows."""

import random

import numpy as np
from pyspark.sql import functions as F

from meterflow.llm.decontaminate import align, contaminated, without_contaminated
from meterflow.llm.queries import ORACLE, QUERIES


def plain(a, b):
    best, row = 0, [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(max(0, row[j] + (2 if x == y else -1), row[j + 1] - 1, new[j] - 1))
        row = new
        best = max(best, *row)
    return best


def test_alignment():
    rng = np.random.default_rng(2)
    for _ in range(50):
        left, right = rng.integers(2, 6, (7, 12)).astype(np.uint64), rng.integers(2, 6, (7, 20)).astype(np.uint64)
        left[3, 8:] = 0
        right[5, 10:] = 1
        score, _ = align(left, right)
        want = [plain([x for x in a.tolist() if x], [y for y in b.tolist() if y != 1]) for a, b in zip(left, right)]
        assert score.tolist() == want


def edited(rng, words, share):
    out = []
    for w in words:
        r = rng.random()
        if r < share / 3:
            continue
        out.append(f"new{rng.randrange(99)}" if r < 2 * share / 3 else w)
        if r > 1 - share / 3:
            out.append("extra")
    return out


def test_planted_copies(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(15, 60)))) for i in range(30)]
    docs, planted = [], set()
    for d in range(200):
        words = rng.choices(vocabulary, k=rng.randint(0, 400))
        if d % 3 == 0:
            i, text = items[rng.randrange(30)]
            at = rng.randint(0, len(words))
            words[at:at] = edited(rng, text.split(), rng.choice([0, 0.1, 0.25]))
            planted.add((d, i))
        docs.append((d, rng.choice([" ", ", ", "\n"]).join(words).upper()))
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumns({"item_id": F.lit("x"), "score": F.lit(0)})
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in contaminated(df, benchmark).collect()}
    assert len(planted - got) <= 2 and got <= planted
    kept = without_contaminated(df, benchmark)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {d for d, _ in docs} - {d for d, _ in got}


def test_odd_rows(spark):
    item = "a b c d e f g h i j"
    docs = spark.createDataFrame([(1, None), (2, ""), (3, item), (3, item), (None, item), (4, "x " * 100_000 + item), (5, "a b")], "doc_id bigint, text string")
    benchmark = spark.createDataFrame([(7, item), (7, item), (8, None), (9, "a b"), (10, ""), (None, item)], "item_id bigint, text string")
    got = sorted((r.doc_id or 0, r.item_id, r.score, r.end_word) for r in contaminated(docs, benchmark).collect())
    assert got == [(0, 7, 1.0, 10), (3, 7, 1.0, 10), (3, 7, 1.0, 10), (4, 7, 1.0, 100_010)]
    assert sorted(r.doc_id for r in without_contaminated(docs, benchmark).collect()) == [1, 2, 5]
    assert contaminated(docs, benchmark.limit(0)).collect() == [] and contaminated(docs.limit(0), benchmark).collect() == []
    assert without_contaminated(docs, benchmark.limit(0)).count() == 7


def test_long_runs_of_long_items(spark):
    """A run of 40 words of an item of 200 is found though it is a fifth of it; one of 20 is not; nor is a run that is broken all the time."""
    rng = random.Random(9)
    item = [f"w{k}" for k in range(200)]
    def noise(n):
        return [f"n{rng.randrange(5000)}" for _ in range(n)]
    docs = [(1, noise(50) + item[60:100] + noise(50)), (2, noise(50) + item[60:80] + noise(50)), (3, [x for w in item[:60] for x in (w, *noise(2))]), (4, item), (5, noise(9) + item[170:])]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in docs], "doc_id bigint, text string")
    got = {r.doc_id: r.score for r in contaminated(df, spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string")).collect()}
    assert got == {1: 0.2, 4: 1.0, 5: 0.15}


def test_short_items_are_found_whole(spark):
    """Items of one or two words are found as they are if they are long enough to say something."""
    rows = [(1, "これは空白のない文章です"), (2, "extraordinarily unremarkable"), (3, "yes"), (4, "of the"), (5, "extraordinarily unremarkable")]
    docs = spark.createDataFrame([(1, "x. これは空白のない文章です! これは空白のない文章です"), (2, "an Extraordinarily, unremarkable day"), (3, "yes, of the"), (4, "unremarkable extraordinarily"), (5, None)],
                                 "doc_id bigint, text string")
    benchmark = spark.createDataFrame(rows, "item_id bigint, text string")
    got = sorted(tuple(r) for r in contaminated(docs, benchmark).collect())
    assert got == [(1, 1, 1.0, 2, 3), (2, 2, 1.0, 1, 3), (2, 5, 1.0, 1, 3)]
    assert sorted(r.doc_id for r in without_contaminated(docs, benchmark).collect()) == [3, 4, 5]


def test_query_against_plain_alignment(spark, tmp_path):
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(15, 40)))) for i in range(6)]
    docs = []
    for d in range(30):
        words = rng.choices(vocabulary, k=rng.randint(0, 80))
        if d % 2:
            at = rng.randint(0, len(words))
            words[at:at] = edited(rng, items[d % 6][1].split(), rng.choice([0, 0.1]))
        docs.append((d, " ".join(words)))
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    want = {}
    for d, text in docs:
        for i, item in items:
            score = plain(item.split(), text.split()) / (2 * len(item.split()))
            if score >= 0.5:
                want[d, i] = score
    assert len(want) >= 15
    assert {(r.doc_id, r.item_id): r.score for r in QUERIES["op4_decontaminate"](spark, str(tmp_path)).collect()} == want


def test_oracles_are_sql():
    assert all(isinstance(sql, str) for sql in ORACLE.values())
