"""Line dedup against a brute-force version that looks at all places of all grams."""

import random
import re

from pyspark.sql import functions as F

from meterflow.llm.winnow import op2_line_dedup, without_repeated_lines

SCHEMA = "doc_id bigint, text string"
CUT = re.compile(r"(?<=\n)|(?<=[.!?] )")


def gram(lines, a, least):
    """End of the shortest run from ``a`` on with ``least`` words, if there is one."""
    total, b = 0, a
    while b < len(lines) and total < least:
        total += lines[b][1]
        b += 1
    return b if total >= least else None


def filled(text):
    """The lines that are not blank, with their words; and which pieces of the text they are."""
    lines = [(k, p.strip(" \t\n")) for k, p in enumerate(CUT.split(text))]
    return [(x, x.count(" ") + 1) for _, x in lines if x], [k for k, x in lines if x]


def brute_force(rows, gram_words, sure_words):
    """Lines that must go (in a gram within a sure run seen before), and lines that may go (in a gram seen before)."""
    docs, pieces = {}, {}
    for i, text in rows:
        if i is not None and text and text.strip():
            docs[i], pieces[i] = filled(text)
    out = []
    for least in (sure_words, gram_words):
        seen, gone = set(), {i: set() for i in docs}
        for i in sorted(docs):
            lines = docs[i]
            for a in range(len(lines)):
                if (b := gram(lines, a, least)) is not None:
                    key = tuple(x for x, _ in lines[a:b])
                    if key in seen:
                        for c in range(a, b):
                            if (d := gram(lines, c, gram_words)) is not None and d <= b:
                                gone[i].update(range(pieces[i][c], pieces[i][d - 1] + 1))
                    seen.add(key)
            # the lines from the last gram's start to the end are a gram too
            if (starts := [a for a in range(len(lines)) if gram(lines, a, gram_words)]) and least == gram_words:
                key = ("end", *(x for x, _ in lines[starts[-1] :]))
                if key in seen:
                    gone[i].update(range(pieces[i][starts[-1]], pieces[i][-1] + 1))
                seen.add(key)
        out.append(gone)
    return out


def check(spark, rows, gram_words=20, sure_words=40):
    got = without_repeated_lines(spark.createDataFrame(rows, SCHEMA), gram_words, sure_words).collect()
    must, may = brute_force(rows, gram_words, sure_words)
    texts = dict(rows)
    removed = 0
    for r in got:
        gone = set(r.removed)
        if r.doc_id not in must:
            assert not gone and r.text == texts[r.doc_id]
            continue
        assert must[r.doc_id] <= gone <= may[r.doc_id], (r.doc_id, must[r.doc_id], gone, may[r.doc_id])
        pieces = CUT.split(texts[r.doc_id])
        assert r.n_lines == len(pieces)
        assert r.text == "".join(p for k, p in enumerate(pieces) if k not in gone)
        removed += len(gone)
    return removed


def test_planted_passages(spark):
    rng = random.Random(5)
    def sentence():
        return " ".join(f"w{rng.randrange(3000)}" for _ in range(rng.randint(1, 14))) + rng.choice([".", "!", "."])
    passages = [[sentence() for _ in range(rng.randint(6, 14))] for _ in range(6)]
    common = [sentence() for _ in range(5)]
    rows = []
    for i in range(120):
        parts = []
        for _ in range(rng.randint(1, 6)):
            parts += [rng.choice(common)] + [sentence() for _ in range(rng.randint(0, 6))]
            if rng.random() < 0.4:
                p = rng.choice(passages)
                parts += p if rng.random() < 0.6 else p[rng.randint(0, 3) :]
        text = "".join(p + rng.choice([" ", "\n", "\n\n"]) for p in parts)
        rows.append((i, text.strip() if rng.random() < 0.5 else text))
    assert check(spark, rows) > 200


def test_blank_lines_are_no_lines(spark):
    """A passage goes from a copy with blank lines, and spaces before the breaks, between its lines."""
    lines = [f"{'abcdefgh'[k]} one two three four five six seven" for k in range(8)]
    rows = [(1, "head\n" + "\n".join(lines) + "\ntail"), (2, "other\n\n" + "\n\n".join(lines) + "\n\nend"), (3, " \n".join(lines)), (4, "\n \n\t\n".join(lines[2:]))]
    for tails in (False, True):
        got = {r.doc_id: r for r in without_repeated_lines(spark.createDataFrame(rows, SCHEMA), tails=tails).collect()}
        assert [got[i].text for i in (1, 2, 3, 4)] == [rows[0][1], "other\n\n\nend", "", ""]
    check(spark, rows)


def test_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    assert check(spark, rows) > 0


def test_odd_rows(spark):
    long = "a b c d e f g h i j. k l m n o p q r s t. u v w x y z a b c d. e f g h i j k l m n o."
    rows = [(1, None), (2, ""), (3, " \n"), (4, long), (5, "x y z. " + long), (6, "short. line."), (7, "short. line."), (8, "q r s. " * 3000)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"removed": F.lit(1), "hash": F.lit("h"), "doc": F.lit(1)})
    got = {r.doc_id: r for r in without_repeated_lines(df.drop("doc")).collect()}
    assert [got[i].text for i in (1, 2, 3, 4, 6, 7)] == [None, "", " \n", long, "short. line.", "short. line."]
    assert got[5].text == "x y z. " and got[5].removed == [1, 2, 3, 4] and got[5].hash == "h"
    assert [got[i].n_lines for i in (1, 2)] == [0, 0]
    assert got[8].text.split() == ["q", "r", "s."]
    twice = without_repeated_lines(spark.createDataFrame([(4, long), (4, long), (None, long), (None, long), (9, long)], SCHEMA)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in twice) == [(0, long), (0, long), (4, long), (4, long), (9, "")]
    assert without_repeated_lines(spark.createDataFrame([], SCHEMA)).collect() == []


def backward(rows, gram_words=20):
    """Lines in a shortest run with ``gram_words`` words up to a line, whose lines an earlier place has."""
    seen, gone = set(), {}
    for i, text in sorted(rows):
        lines, at = filled(text)
        gone[i] = set()
        for b in range(len(lines)):
            if (n := gram(lines[b::-1], 0, gram_words)) is not None:
                key = tuple(x for x, _ in lines[b - n + 1 : b + 1])
                if key in seen:
                    gone[i].update(range(at[b - n + 1], at[b] + 1))
                seen.add(key)
    return gone


def test_tails_of_passages_go(spark, tmp_path):
    rng = random.Random(8)
    def sentences(n, least=3, most=14):
        return [" ".join(f"w{rng.randrange(3000)}" for _ in range(rng.randint(least, most))) + ". " for _ in range(n)]
    passage = sentences(8, 7, 9)
    rows = [(i, "".join(sentences(rng.randint(0, 5)) + passage + sentences(rng.randint(1, 5)))) for i in range(30)]
    path = f"{tmp_path}/documents.parquet"
    spark.createDataFrame(rows, SCHEMA).write.parquet(path)
    got = {r.doc_id: set(r.removed) for r in op2_line_dedup(spark, str(tmp_path)).collect()}
    for i, text in rows[1:]:
        pieces = CUT.split(text)
        assert got[i] == {k for k, p in enumerate(pieces) if p in passage}
    assert got[0] == set()


def test_tails_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    rows = [(i, t) for i, t in rows if i is not None and t and t.strip()]
    df = spark.createDataFrame(rows, SCHEMA)
    plain = {r.doc_id: set(r.removed) for r in without_repeated_lines(df).collect()}
    got = {r.doc_id: set(r.removed) for r in without_repeated_lines(df, tails=True).collect()}
    may, tails = brute_force(rows, 20, 40)[1], backward(rows)
    assert all(plain[i] <= got[i] <= may[i] | tails[i] for i in got)
    assert all(tails[i] <= got[i] for i in got if plain[i])
    assert sum(map(len, got.values())) > sum(map(len, plain.values()))


def test_texts_are_dealt_once(spark, tmp_path):
    """One scan of the texts goes to the join with the places, not one for texts with and one for texts without any."""
    path = f"{tmp_path}/documents.parquet"
    spark.createDataFrame([(1, "a b. " * 30), (2, "a b. " * 30), (3, "c d.")], SCHEMA).write.parquet(path)
    out = without_repeated_lines(spark.read.parquet(path), tails=True)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan parquet \[[^\]]*text#", plan)) == 1


def test_tails_with_odd_rows(spark):
    """Short, blank, missing and repeated texts, ids that come with two texts, and a text that holds the mark; all with ``tails``."""
    rng = random.Random(3)
    lines = [" ".join(f"w{rng.randrange(500)}" for _ in range(7)) for _ in range(12)]
    block = "\n".join(lines[:6])
    rows = [(1, block + "\nown one"), (2, "head\n" + block.replace("\n", "\n\n") + "\ntail of two"), (2, "\n".join(lines[6:]) + "\n" + block), (3, block), (3, block), (4, None), (5, " \n\t"), (6, "\n".join(lines[:3])), (7, "\n".join(lines[:3]))]
    rows += [(8, "x\x01y. " + block), (9, "\n".join(lines[6:] + ["between"] + lines[6:])), (None, block)]
    got = {(r.doc_id, r.n_lines, tuple(r.removed)) for r in without_repeated_lines(spark.createDataFrame(rows, SCHEMA), tails=True).collect()}
    assert got == {
        (1, 7, ()), (2, 13, (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11)), (2, 12, (6, 7, 8, 9, 10, 11)), (3, 6, (0, 1, 2, 3, 4, 5)), (4, 0, ()), (5, 2, ()), (6, 3, (0, 1, 2)), (7, 3, (0, 1, 2)),
        (8, 7, (1, 2, 3, 4, 5, 6)), (9, 13, (0, 1, 2, 3, 4, 5, 7, 8, 9, 10, 11, 12)), (None, 6, ()),
    }
