"""Encoding against the tiktoken library, decoding by exact round trips."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from meterflow.llm.bytebpe import codec, decode_ids, encode_documents, piece_offsets

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec(PATH).ranks, special_tokens={})


def ids_of(texts):
    return [ids.tolist() for ids, _ in codec(PATH).encode(texts)]


def test_random_texts(reference):
    rng = random.Random(1)
    alphabet = [*"ab'stmdrevl  \n\t\r é12!?.,ſ", " ", "　", "\x85", "\x1c", "’", "🙂", "'s", "'re", "'ll", "  ", " '", "<|endoftext|>"]
    for _ in range(4000):
        texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 14))) for _ in range(3)]
        assert ids_of(texts) == [reference.encode_ordinary(t) for t in texts], texts


def test_all_code_points(reference):
    points = [chr(i) for i in range(0x30000) if not 0xD800 <= i < 0xE000]
    for i in range(0, len(points), 2000):
        text = "a".join(points[i : i + 2000])
        assert ids_of([text]) == [reference.encode_ordinary(text)]


def test_long_pieces_and_blocks(reference):
    for text in ("a" * 5000, "ab" * 3000, " " * 5000 + "x", "word " * 40_000, "\n" * 300, "é" * 999):
        assert ids_of([text]) == [reference.encode_ordinary(text)]


def test_offsets():
    data, offsets, firsts = piece_offsets(["é a", "", "b\n\nc"])
    assert [data[a:b].decode() for a, b in zip(offsets, offsets[1:])] == ["é", " a", "b", "\n", "\n", "c"]
    assert firsts.tolist() == [0, 2, 2, 6]


def test_documents(spark, reference):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = dict(docs.select("doc_id", "text").toPandas().values)
    coded = encode_documents(docs, PATH)
    for r in coded.collect():
        want = reference.encode_ordinary(texts[r.doc_id])
        assert r.token_ids == want and r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    assert {r.doc_id: bytes(r.decoded).decode() for r in decode_ids(coded, PATH).collect()} == texts


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "x"), (3, "x"), (None, "y")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"n_tokens": F.lit("z"), "token_ids": F.lit(1)})
    got = sorted(((r.doc_id or 0, r.n_tokens, r.ids_sha256[:4]) for r in encode_documents(df, PATH).collect()), key=str)
    nothing = hashlib.sha256(b"").hexdigest()[:4]
    assert [g[:2] for g in got] == [(0, 1), (1, 0), (2, 0), (3, 1), (3, 1)] and got[1][2] == got[2][2] == nothing
    assert encode_documents(df.limit(0), PATH).collect() == []
