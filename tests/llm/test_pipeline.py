"""The pipeline's stages against what each promises, on the smallest data set and on odd tables."""

import os

import pytest

import corpus_pipeline
from tidegate.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    if not os.path.isdir(SF):
        pytest.skip("no test data")
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_stages_take_effect_in_turn(spark, docs):
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, now, SF)
        rows = after.collect()
        assert after.columns == list(corpus_pipeline.COLUMNS), name
        before = {r["doc_id"] for r in now.collect()}
        assert {r["doc_id"] for r in rows} <= before and rows
        now = spark.createDataFrame(rows, docs.schema)
    packed = corpus_pipeline.STAGES[-1][1](spark, now, SF)
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in now.collect()}


def test_stages_on_an_empty_table_and_nulls(spark, docs):
    odd = spark.createDataFrame([(None, None, None, None, None), (1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0)], docs.schema)
    for table in (docs.limit(0), odd):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, table, SF).collect()


def test_all_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))
