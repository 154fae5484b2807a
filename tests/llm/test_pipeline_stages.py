"""The corpus pipeline against its stages done by hand on what each was given."""

from __future__ import annotations

import pytest

import corpus_pipeline
from orderflume.llm import langid, pii, simhash
from orderflume.llm.common import stage

SMALL = "/root/testdata/sf0.001"


def test_every_stage_works_on_what_its_predecessor_kept(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    given, seen = docs, [docs]
    for name, step in corpus_pipeline.STAGES:
        given = stage(step(spark, given, SMALL), name)
        seen.append(given)
    for before, after in zip(seen[:4], seen[1:5]):
        assert after.columns == docs.columns
        assert {r.doc_id for r in after.select("doc_id").collect()} <= {r.doc_id for r in before.select("doc_id").collect()}
    assert seen[1].count() >= 0.97 * docs.count() and seen[2].count() >= 0.8 * seen[1].count()
    before = {r.doc_id: r.text for r in seen[3].collect()}
    for r in seen[4].collect():
        assert r.text == pii.masked(before[r.doc_id]) and r.n_chars == len(r.text)
    packed = seen[5].toPandas()
    assert set(packed.doc_id) == set(before)
    assert (packed.groupby("doc_id").length.sum() == packed.groupby("doc_id").doc_tokens.first()).all()


ODD = "doc_id long, text string, lang string, source string, n_chars long, own_fp int, kept_id string, `a b` struct<`c d`:int,`e``f`:string>"


def odd_rows():
    texts = [None, "", "one two three four five", "one two three four five", "\n", "mail a.b@c.de please", "word " * 3000]
    rows = [(i, t, None, None, len(t or ""), 1, "k", (1, "x")) for i, t in enumerate(texts)]
    return [*rows, rows[2], (None, "one two three four five", None, None, None, None, None, None)]


def test_stages_take_any_column_names(spark):
    docs = spark.createDataFrame(odd_rows(), ODD)
    kept = simhash.keep_first(docs)
    assert kept.schema.simpleString() == docs.schema.simpleString()
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [0, 2, 5, 6, None]


def test_without_any_language_all_documents_stay(spark):
    docs = spark.createDataFrame(odd_rows(), ODD)
    assert langid.keep_known(docs).count() == docs.count()


@pytest.mark.parametrize("rows", [[], odd_rows()], ids=["empty", "odd"])
def test_run_on_empty_and_odd_tables(spark, tmp_path, rows):
    spark.createDataFrame(rows, ODD).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in pieces} == ({0, 2, 5, 6, None} if rows else set())
