"""Collocations against a plain count of all phrases, and double-array tries against a dictionary."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import compare, duck
from pyspark.sql import functions as F

from meterflow.llm.doublearray import build
from meterflow.llm.phrases import _SCORE, collocations, op12_phrases, oracle_sql


def plain(rows, least, most, top, percent=100):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        down = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", down):
            words = [w for w in re.split("[ \t]", piece) if w]
            totals[lang] += len(words)
            for m in range(1, most + 1):
                counts[lang].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, f in counts.items():
        n = totals[lang]
        often = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in often.items():
            longer = (q for q in often if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))))
            if any(100 * f[q] >= percent * a for q in longer):
                continue
            score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def texts(seed, n=150):
    rng = random.Random(seed)
    bits = ["New York", "new YORK city", "of the", "the", "a", "été là", "x\ty", "end.", "so,", "\r\n", "a a a", "of the new york", "Ünder", "#"]
    rows = [(rng.choice(["en", "fr", None]), " ".join(rng.choices(bits, k=rng.randint(0, 30)))) for _ in range(n)]
    return rows + [("en", None), ("en", ""), (None, " \t\n"), ("de", "a b " * 3000), ("de", "nurhier"), rows[0], rows[0]]


def found(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("least, most, top, percent, block", [(3, 5, 2000, 100, 1 << 19), (3, 5, 7, 60, 1 << 19), (10, 3, 2000, 100, 1 << 19), (3, 4, 2000, 100, 5)])
def test_against_plain_counts(spark, least, most, top, percent, block):
    rows = texts(least)
    docs = spark.createDataFrame([(lang, text, 1, "x") for lang, text in rows], "lang string, text string, n int, phrase string")
    got = found(collocations(docs, least, most, top, percent, block))
    assert got == plain(rows, least, most, top, percent) and len(got) > 5


def test_large_products(spark):
    """Counts of texts that are repeated by the million stay exact."""
    made = spark.sql("SELECT 7 AS k_, 90000000000000 AS n, 90000000000001 AS all_n, array(90000000000003L, 1L) AS heads, array(90000000000009L, 1L) AS tails, 1 AS k")
    got = made.select(F.expr(_SCORE).alias("s")).first()["s"]
    assert got == 1000 * 90000000000000 * 90000000000001 // (90000000000003 * 90000000000009)


def test_odd_tables(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert collocations(empty).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and collocations(empty).collect() == []
    assert collocations(spark.createDataFrame([(None, None)], "lang string, text string")).collect() == []
    assert collocations(spark.createDataFrame([("en", "one. two. three")], "lang string, text string"), 1).collect() == []


def test_query_over_whole_table(spark):
    message, rows = compare(op12_phrases(spark, "/root/testdata/sf0.01"), duck("/root/testdata/sf0.01"), oracle_sql())
    assert not message and rows


@pytest.mark.parametrize("depth, size, words", [(1, 5000, 5000), (2, 20000, 300), (3, 3000, 40), (5, 4000, 12), (2, 1, 1)])
def test_trie(depth, size, words):
    rng = np.random.default_rng(depth)
    symbols = rng.integers(-(1 << 62), 1 << 62, words)
    phrases = np.unique(symbols[rng.integers(0, words, (size, depth))], axis=0)
    rng.shuffle(phrases)
    trie = build(phrases)
    text = np.concatenate([phrases[rng.integers(0, len(phrases), 500)].ravel(), symbols[rng.integers(0, words, 2000)], [3, 4]])
    left = rng.integers(1, depth + 3, len(text))
    left = np.minimum(left, len(text) - np.arange(len(text)))
    rows = {tuple(p): i for i, p in enumerate(phrases.tolist())}
    want = [rows.get(tuple(text[i : i + depth].tolist()), -1) if left[i] >= depth else -1 for i in range(len(text))]
    assert trie.walk(trie.codes(text), left).tolist() == want and max(want) >= 0
