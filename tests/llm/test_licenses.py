"""License scans against a plain version: regular expressions over lists of words, containment by comparing all pairs."""

import random
import re

import pytest

from meterflow.llm.licenses import BASE, MENTION, NOTICE, STEMS, TITLE, Rule, default_rules, detections, op11_licenses

RULES = default_rules()


def plain(text, rules):
    down = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", down)
    line = "".join(f" {w} " for w in words)

    def places(pattern):
        return [(line.count(" ", 0, m.start()) // 2, line.count(" ", 0, m.end()) // 2) for m in re.finditer(pattern, line)]

    base = sorted((s, label) for label, p in BASE for s in range(len(words)) if words[s : s + len(p.split())] == p.split())
    found = [(s, e, r.priority, i, r.label) for i, r in enumerate(rules) for s, e in places(r.pattern)]
    kept = [d for d in found if not any(
        o[2] <= d[2] and o[0] <= d[0] and o[1] >= d[1] and (o[0] < d[0] or o[1] > d[1] or o[2] < d[2] or o[3] < d[3]) for o in found)]
    return len(words), base, sorted(kept)


def rows(df):
    return [(r["doc_id"], r["n_words"], sorted((b["start"], b["label"]) for b in r["base"]),
             sorted((d["start"], d["until"], d["priority"], d["rule"], d["label"]) for d in r["found"])) for r in df.collect()]


def test_rules():
    assert len(RULES) > 300 and len({(r.label, r.priority, r.signature) for r in RULES}) > 300
    for r in RULES:
        needed = [w for w, must in r.words if must]
        # what every match holds for certain: plain words and the letters that a pattern begins or ends with
        sure = "".join(f" {w.partition('[')[0]} " if re.match("^[a-z0-9]+", w) else "  " for w in needed)
        assert any(stem in sure for stem in STEMS), r
        assert r.keyword.strip() in sure, r


@pytest.mark.parametrize("text, labels", [
    ("Licensed under the Apache License, Version 2.0.", {"apache-2.0"}),
    ("SPDX-License-Identifier: MIT", {"mit"}),
    ("This work is licensed under the GNU General Public License, version 3.", {"gpl-3.0"}),
    ("Licensed under CC BY-NC 4.0.", {"cc-by-nc-4.0"}),
    ("Redistribution and use in source and binary forms, with or without", {"bsd"}),
    ("Das ist mit Lizenz", set()),
    ("the MIT\nLICENSE; mit licence", {"mit"}),
    ("GPLv3 or gpl", {"gpl-3.0", "gpl"}),
])
def test_labels(spark, text, labels):
    found = rows(detections(spark.createDataFrame([(1, text)], "doc_id long, text string")))[0][3]
    assert {d[4] for d in found} == labels


def test_against_plain_version(spark):
    rng = random.Random(5)
    bits = ["mit license", "MIT-License", "licensed under the", "Apache License, Version 2.0", "gnu lesser general public license v2.1", "general public license",
            "été", "all rights reserved", "SPDX-License-Identifier:", "bsd 3 clause", "cc by sa 4.0", "word", "Copyright (c) 2019", "public domain", "x\x00y", "  ", "\n"]
    texts = [" ".join(rng.choices(bits, k=rng.randint(0, 40))) for _ in range(60)]
    texts += [None, "", " \n", "mit license " * 1500, "Licensed under the MIT license. " * 700 + "é" * 5000, texts[0], texts[0]]
    docs = spark.createDataFrame([(i if i % 9 else None, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, found string, base int")
    got = sorted(rows(detections(docs)), key=str)
    want = sorted(((i if i % 9 else None, *plain(t, RULES)) for i, t in enumerate(texts)), key=str)
    assert got == want


def test_order_and_priority(spark):
    rules = [Rule("long", TITLE, "some licen[sc]e text"), Rule("first", TITLE, "licen[sc]e text"), Rule("strong", 1, "license text"), Rule("tie", 1, "license text"),
             Rule("weak", MENTION, "some license text here"), Rule("other", NOTICE, "text here license")]
    docs = spark.createDataFrame([(1, "some license text here license"), (2, "license text"), (3, "a licence text")], "doc_id long, text string")
    got = {r[0]: {d[4] for d in r[3]} for r in rows(detections(docs, rules, []))}
    assert got == {1: {"long", "strong", "weak", "other"}, 2: {"strong"}, 3: {"first"}}


def test_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert detections(empty).collect() == []
    clash = spark.createDataFrame([(7, "mit license", "a", "b")], "doc_id long, text string, norm string, n_words string")
    assert rows(detections(clash))[0][:3] == (7, 2, [(0, "mit")])


def test_no_python_and_no_shuffle(spark):
    plan = op11_licenses(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Python|Pandas|Arrow|Exchange|Join", plan)


def test_query_counts_base_places(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    counted = {r["doc_id"]: plain(r["text"], []) for r in docs.collect()}
    want = {(doc_id, n_words, len(base)) for doc_id, (n_words, base, _) in counted.items()}
    got = {(r["doc_id"], r["n_words"], r["n_base"]) for r in op11_licenses(spark, "/root/testdata/sf0.001").collect()}
    assert got == want
