"""The pipeline's stages on the smallest tables and on planted rows."""

import pytest
from conftest import SF_DIR

import corpus_pipeline
from courtflow.llm.common import stored


@pytest.fixture(scope="module")
def kept(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    top = docs.orderBy("doc_id").first()
    more = spark.createDataFrame(
        [(10_001, top.text, None, "x", 1), (10_001, top.text, None, "x", 1), (10_002, None, "en", "x", 0), (10_003, "12 34 --", "en", "x", 8),
         (10_004, f"{' '.join(f'neu{k}' for k in range(40))} write to some.one@example.org", None, "x", 1)], docs.schema)
    docs = docs.unionByName(more)
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], SF_DIR), name))
    return out


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_stages(kept):
    docs, known, single, clean, hidden, packed = kept
    assert ids(docs) - ids(known) == {10_002, 10_003}
    assert known.where("doc_id = 10001").count() == 2 and known.where("lang is null").count() == 0
    assert 10_001 not in ids(single) and single.count() == len(ids(single))
    assert ids(clean) <= ids(single) and all(f.columns == docs.columns for f in (known, single, clean, hidden))
    assert "[EMAIL]" in hidden.where("doc_id = 10004").first().text
    assert ids(packed) == ids(hidden)


def test_benchmark_copies_without_an_id_and_of_shared_ids(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(50)
    item = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").first().text
    clean = " ".join(f"neu{k}" for k in range(40))
    rows = [(None, item, "en", "x", 1), (None, clean, "en", "x", 1), (20_001, item, "en", "x", 1), (20_001, clean, "en", "x", 1)]
    out = corpus_pipeline.drop_benchmark_copies(spark, docs.unionByName(spark.createDataFrame(rows, docs.schema)), SF_DIR)
    found = out.where("doc_id is null or doc_id = 20001").collect()
    assert len(found) == 2 and {(r.doc_id, r.text) for r in found} == {(None, clean), (20_001, clean)}


def test_run(spark):
    assert corpus_pipeline.run(spark, SF_DIR).count() > 0
