"""The pipeline's stages on planted cases, and its whole run."""

import hashlib

import pytest

import corpus_pipeline as cp

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def test_stages_keep_the_columns(spark, docs):
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns, name
        assert [f.dataType for f in out.schema] == [f.dataType for f in docs.schema], name
        assert stage(spark, docs.limit(0), SF_DIR).count() == 0, name


def test_line_stage_drops_only_emptied_documents(spark):
    long = " ".join(f"w{i}" for i in range(60)) + "."
    rows = [(1, long, 1), (2, long, 2), (3, "Own words here. " + long, 3), (4, None, None), (5, "", 0), (6, "short", 5)]
    out = cp.line_dedup_stage(spark, spark.createDataFrame(rows, "doc_id bigint, text string, n_chars int"), "")
    assert sorted(map(tuple, out.collect())) == [(1, long, 1), (3, "Own words here. ", 16), (4, None, None), (5, "", 0), (6, "short", 5)]


def test_stages_keep_columns_with_clashing_names(spark):
    """Columns that are named like results keep their values; odd rows pass through every stage."""
    long = " ".join(f"w{i}" for i in range(60)) + "."
    rows = [(1, long, "r", "n", 7), (2, "Other. " + long, "r2", "n2", 8), (None, None, None, None, None), (4, "", "x", "y", 9), (4, "", "x", "y", 9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, removed string, n_lines string, kept int")
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.schema == docs.schema, name
        assert {(r.doc_id, r.removed, r.n_lines, r.kept) for r in out.collect()} <= {(r[0], *r[2:]) for r in rows}, name
    assert ("Other. ", "r2", "n2", 8) in {tuple(r)[1:] for r in cp.line_dedup_stage(spark, docs, SF_DIR).collect()}


def test_near_stage_keeps_the_first(spark):
    text = " ".join(f"w{i}" for i in range(200))
    rows = [(1, text), (2, text), (3, text.replace("w77", "new")), (4, "other words"), (5, None), (6, ""), (None, text)]
    out = cp.near_dedup_stage(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), "")
    assert sorted(r.doc_id or 0 for r in out.collect()) == [0, 1, 4, 5, 6]


def test_run(spark, docs):
    out = cp.run(spark, SF_DIR).collect()
    ids = [r.doc_id for r in out]
    assert len(set(ids)) == len(ids) and 0 < len(ids) < docs.count() and set(ids) <= {r.doc_id for r in docs.collect()}
    assert all(r.ids_sha256 == hashlib.sha256(" ".join(map(str, r.token_ids)).encode()).hexdigest() for r in out)
