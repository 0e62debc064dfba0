"""Near-duplicates against brute force over all pairs."""

import random
import re

import pytest

from meterflow.llm.minhash import near_duplicates

SCHEMA = "doc_id bigint, text string"


def shingles(text, n):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def brute_force(rows, n, percent):
    sets = [(i, shingles(t, n)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= percent * len(a | b) and find(i) != find(j):
                low, high = sorted((find(i), find(j)))
                parent[high] = low
    return sorted((i, len(s), find(i), find(i) == i) for i, s in sets)


def found(df):
    return sorted(tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect())


def copies(seed, originals, per_original):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows, next_id = [], 100
    for _ in range(originals):
        text = rng.choices(words, k=rng.choice([1, 3, 6, 40, 120]))
        for _ in range(per_original):
            copy = list(text)
            for _ in range(rng.randint(0, max(1, len(text) // 25))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((next_id, rng.choice([" ", "\n", "  "]).join(copy)))
            next_id += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("n", [4, 5])
def test_chains_of_copies(spark, n):
    rows = copies(n, 12, 12)
    assert found(near_duplicates(spark.createDataFrame(rows, SCHEMA), n, 80)) == brute_force(rows, n, 80)


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(near_duplicates(docs, 4, 80)) == brute_force(rows, 4, 80)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "A b"), (5, "a B"), (6, "a"), (7, "x " * 50000), (8, "x x x x x"), (9, "y"), (9, "y"), (10, "Y")]
    df = spark.createDataFrame([(i, t, "c", 0) for i, t in rows], SCHEMA + ", component string, bucket int")
    got = found(near_duplicates(df, 4, 80))
    assert got == [
        (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False), (6, 1, 6, True),
        (7, 1, 7, True), (8, 1, 7, False), (9, 1, 9, True), (9, 1, 9, True), (10, 1, 9, False),
    ]
    missing = near_duplicates(spark.createDataFrame([(None, "a b c"), (None, "a b c"), (3, "a b c")], SCHEMA), 4, 80)
    assert sorted((r.doc_id is None, r.component_id, r.kept) for r in missing.collect()) == [(False, 3, True), (True, None, True), (True, None, True)]
    assert found(near_duplicates(spark.createDataFrame([], SCHEMA), 4, 80)) == []
