"""Spelling variants against a plain version that makes all words at one error; the index against plain search."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from compare import compare, duck

from meterflow.llm.fmindex import FMIndex, near, suffix_array
from meterflow.llm.spelling import OP13_SQL, op13_spelling, spelling_variants

LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))


def around(word, letters=LETTERS):
    out = {word[:i] + word[i + 1 :] for i in range(len(word))}
    out |= {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in letters}
    out |= {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in letters}
    return out - {word}


def plain(rows, least, times, modulus):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % modulus == 0 else run] += 1
    n = {w: k for w, k in n.items() if len(w) >= least and k >= times}
    form, out = {}, []
    for w, k in n.items():
        close = sorted((-n[x], x) for x in around(w) if x in n)
        form[w] = (len(close), close[0][1] if close and -close[0][0] >= 2 * k else None)
    for w, (count, f) in form.items():
        root = w
        while form[root][1] is not None:
            root = form[root][1]
        out.append((w, n[w], count, f, n.get(f), root))
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select("word", "n", "n_near", "form", "form_n", "root").collect())


def documents(seed):
    rng = random.Random(seed)
    words = ["colour", "color", "colours", "Colour", "couleur", "straße", "strasse", "ÉTAGE", "étage", "étages", "aaaaa", "aaaaaa", "aaaaaaa", "abcabc", "×mal÷", "short", "sort", "tiny"]
    words += ["".join(rng.choices("abé", k=rng.randint(4, 7))) for _ in range(60)]
    rows = [(i, " ".join(rng.choices(words, weights=[len(words) - j for j in range(len(words))], k=60))) for i in range(80)]
    return rows + [(None, "colour colour"), (7, None), (8, ""), (9, "12 -- \n"), (10, "y" * 90 + " " + "Lang" * 20), (11, "ÿÿÿÿÿ ÿÿÿÿÿÿ " * 5), rows[0], rows[0]]


@pytest.mark.parametrize("least, times, modulus, shard_words, searches", [(5, 3, 97, 1 << 14, 1 << 15), (5, 3, 5, 20, 1 << 15), (4, 1, 7, 30, 10)])
def test_against_plain_version(spark, least, times, modulus, shard_words, searches):
    rows = documents(modulus)
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n int, word string")
    got = found(spelling_variants(docs, least, times, modulus, shard_words, searches))
    assert got == plain(rows, least, times, modulus)
    assert any(r[3] for r in got) and any(r[5] not in (r[0], r[3]) for r in got) or shard_words > 100


def test_long_words(spark):
    long = ["y" * 20000, "y" * 20001, "ab" * 5000, "ab" * 2500 + "c" + "ab" * 2500]
    docs = spark.createDataFrame([(i, w) for i, w in enumerate(long * 3 + long[:1] * 6)], "doc_id long, text string")
    got = {w: (n, count, form) for w, n, count, form, _, _ in found(spelling_variants(docs, modulus=1 << 40))}
    assert got == {long[0]: (9, 1, None), long[1]: (3, 1, long[0]), long[2]: (3, 1, None), long[3]: (3, 1, None)}


def test_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling_variants(empty).collect() == []
    assert spelling_variants(spark.createDataFrame([(1, None), (None, "ab cd")], "doc_id long, text string")).collect() == []
    alone = spark.createDataFrame([(1, "einsam einsam einsam")], "doc_id long, text string")
    assert found(spelling_variants(alone)) == [("einsam", 3, 0, None, None, "einsam")]


def test_query_over_whole_table(spark):
    message, rows = compare(op13_spelling(spark, "/root/testdata/sf0.01"), duck("/root/testdata/sf0.01"), OP13_SQL)
    assert not message and rows


def test_suffix_array():
    rng = np.random.default_rng(3)
    for text in (rng.integers(0, 3, 500), np.zeros(70, np.int64), np.array([5]), rng.integers(0, 200, 300)):
        want = sorted(range(len(text)), key=lambda i: text[i:].tolist())
        assert suffix_array(text.astype(np.uint8)).tolist() == want


@pytest.mark.parametrize("letters", ["ab", "abcdefé"])
def test_search(letters):
    rng = random.Random(4)
    words = sorted({"".join(rng.choices(letters, k=rng.randint(1, 7))) for _ in range(400)})
    queries = words[::2] + ["".join(rng.choices(letters, k=rng.randint(1, 7))) for _ in range(50)]
    exact = [rng.randint(0, len(q)) for q in queries]
    index = FMIndex.of([w.encode("latin-1") for w in words])
    q, hit = near(index, [w.encode("latin-1") for w in queries], np.array(exact))
    want = set()
    for i, (w, e) in enumerate(zip(queries, exact)):
        behind = {w[:e] + x for x in around(w[e:], letters)}
        want |= {(i, words.index(x)) for x in behind - {w} if x in words}
    assert set(zip(q.tolist(), hit.tolist())) == want and len(q) == len(want)
