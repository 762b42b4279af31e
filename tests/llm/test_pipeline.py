"""The pipeline's stages: columns, decisions and survival of awkward rows."""

import importlib

import pytest
from pyspark.sql import functions as F

from medallion.llm.common import _murmur3, slots


@pytest.fixture(scope="module")
def pipeline():
    return importlib.import_module("corpus_pipeline")


def test_stages_keep_the_columns_and_decide(spark, sf, pipeline):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names, left = docs.columns, [docs.count()]
    for _, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf).cache()
        assert docs.columns == names
        left.append(docs.count())
    assert left == sorted(left, reverse=True) and left[0] > left[-1] > 0
    mix = pipeline.STAGES[-1][1](spark, docs, sf)
    rows = mix.select("doc_id", "position").collect()
    assert [r.position for r in rows] == sorted(r.position for r in rows)
    assert {r.doc_id for r in rows} <= {r.doc_id for r in docs.select("doc_id").collect()}


def test_stages_on_an_empty_table_and_awkward_rows(spark, sf, pipeline):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", None, 0), (1, "", "en", None, 0)], docs.schema)
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs.limit(0), sf).count() == 0
        stage(spark, odd, sf).count()


def test_near_duplicate_stage_keeps_one_of_each_group(spark, sf, pipeline):
    text = " ".join(f"word{k}" for k in range(60))
    rows = [(5, text, "en", "a", 1), (3, text, "en", "a", 1), (3, text, "en", "a", 1), (9, text + " more", "en", "a", 1), (4, "alone " * 3, "en", "a", 1),
            (None, text, "en", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = pipeline.near_duplicate_stage(spark, docs, sf)
    assert sorted(r.doc_id for r in out.collect()) == [3, 4]


def test_slots_match_the_hash_partitioner(spark):
    n = 13
    ids = slots(spark, n)
    got = spark.createDataFrame([(int(i),) for i in ids], "x long").select(F.expr(f"pmod(hash(x), {n})")).collect()
    assert [r[0] for r in got] == list(range(n))
    assert _murmur3(ids).shape == (n,)
