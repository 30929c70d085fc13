"""The pipeline's stages on nulls, empty texts, repeated rows, clashing columns and empty tables; long URLs; clashes in SimHash."""

from __future__ import annotations

import os

import pytest

import corpus_pipeline
from cdmflow.llm import queries, simhash, url_filter

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
ROWS = [(1, "a plain text about nothing at all", "en", "a", 33), (1, "a plain text about nothing at all", "en", "a", 33), (2, None, None, None, None),
        (3, "", "en", "a", 0), (None, "no id here", "de", "b", 10), (5, "the secret benchmark phrase that must not be learnt", "en", "a", 51)]


@pytest.fixture()
def folder(spark, tmpdir_path):
    def write(docs):
        spark.createDataFrame(docs, COLUMNS).write.parquet(os.path.join(tmpdir_path, "documents.parquet"))
        spark.createDataFrame([(1, 0, 0), (5, 1, 1)] if docs else [], "doc_id long, quality int, toxic int").write.parquet(
            os.path.join(tmpdir_path, "labels.parquet"))
        spark.createDataFrame([(1, "the secret benchmark phrase")] if docs else [], "item_id long, text string").write.parquet(
            os.path.join(tmpdir_path, "benchmark.parquet"))
        return tmpdir_path
    return write


def test_every_stage_handles_the_edge_cases(spark, folder):
    sf = folder(ROWS)
    docs = spark.createDataFrame([(*r, "x", "y") for r in ROWS], COLUMNS + ", _toxicity string, hay string")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        kept[name] = sorted((r["doc_id"] or 0) for r in out.collect())
        if name != "best-fit packing":
            assert out.columns == docs.columns
        assert stage(spark, docs.limit(0), sf).count() == 0
    assert kept["simhash near-dedup"] == [0, 1, 2, 5] and kept["benchmark decontamination"] == [0, 1, 1, 2, 3]
    assert kept["personal data"] == [0, 1, 1, 2, 3, 5] and kept["best-fit packing"] == [0, 1, 1, 2, 3, 5]


def test_the_pipeline_on_empty_tables(spark, folder):
    assert corpus_pipeline.run(spark, folder([])).count() == 0


def test_long_urls(spark):
    rows = [(1, "http://" + "a" * 1_000_000 + ".com/x"), (2, "http://example.com/en/" + "y" * 1_000_000), (3, "x" * 1_000_000)]
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filter.filter_urls(
        spark.createDataFrame(rows, "page_id long, url string"), queries.URL_RULES).collect()}
    assert got == {1: ("com/", "allow"), 2: ("example.com/en/", "block"), 3: (None, "allow")}


def test_simhash_with_clashing_columns(spark):
    df = spark.createDataFrame([(1, "one two three four five", "a", "b"), (2, "one two three four five", "c", "d")],
                               "doc_id long, text string, fp string, component_id string")
    rows = simhash.near_duplicates(df).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == {1: 1, 2: 1}
