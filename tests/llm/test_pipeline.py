import os

import pytest

import corpus_pipeline
from lectern.session import stage
from tests.llm import samples

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="tables are not there")
def test_stages_one_after_the_other(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, kept = docs.columns, []
    for name, function in corpus_pipeline.STAGES:
        result = stage(function(spark, docs, SF_DIR), f"test-{name}")
        if name != "packing":
            assert result.columns == columns
            before, after = {r.doc_id for r in docs.collect()}, [r.doc_id for r in result.collect()]
            assert set(after) <= before and len(after) == len(set(after))
            kept.append(len(after))
            docs = result
        else:
            packed = {r.doc_id for r in result.collect()}
            assert packed == {r.doc_id for r in docs.collect()}
    assert kept[0] > kept[1] >= kept[2] == kept[3] > 0
    texts = [samples.lower(r.text) for r in docs.collect()]
    assert len(texts) == len(set(texts))
    assert sorted(corpus_pipeline.run(spark, SF_DIR).collect()) == sorted(result.collect())


@pytest.mark.parametrize("make", [samples.documents, samples.empty])
def test_stages_stand_odd_rows(spark, folder, make):
    labels = spark.createDataFrame([(1, 0), (13, 0), (None, None)], "doc_id long, toxic int")
    labels.write.parquet(f"{folder}/labels.parquet")
    docs = stage(make(spark), "odd")
    for name, function in corpus_pipeline.STAGES:
        out = stage(function(spark, docs, folder), f"odd-{name}")
        if name != "packing":
            assert out.columns == docs.columns
            docs = out
    if make is samples.documents:
        ids = [r.doc_id for r in docs.collect()]
        assert ids.count(9) == 1 and 8 in ids and 7 not in ids
