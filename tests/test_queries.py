"""Every registered query against its SQL, and what its plan must not contain."""

import pytest
from compare import connect, difference, types_differ
from conftest import SF_DIR

from courtflow.plans.queries import registry

QUERIES = registry()
# these run jobs while they are built; their plans only read the result
EAGER = {"write_batch", "transform_games", "transform_counts", "transform_contents", "append_documents",
         "ingest_stream_documents", "ingest_stream_manifest", "ingest_batches_documents", "ingest_batches_manifest",
         "ingest_two_streams", "compact_documents", "ingest_staged_documents", "ingest_staged_worklist"}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    query, sql = QUERIES[name]
    assert difference(spark, con, SF_DIR, query, sql) is None


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in EAGER])
def test_plan_and_types(spark, con, name):
    query, sql = QUERIES[name]
    df = query(spark, SF_DIR)
    assert types_differ(df, con.sql(sql)) == []
    plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
    for slow in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                 "FlatMapGroups"):
        assert slow not in plan
    assert "Exchange SinglePartition" not in plan


def test_newest_row_is_chosen_before_the_shuffle(spark):
    query, _ = QUERIES["latest_documents"]
    df = query(spark, SF_DIR)
    plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
    assert "Partial" in plan[plan.index("Exchange"):]


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_without_a_library_keeps_the_other_queries(monkeypatch):
    import sys

    import __spark_entry__ as contract

    for name in [m for m in sys.modules if m.startswith("courtflow.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    # as if the library were not installed
    for library in ("regex", "tokenizers"):
        monkeypatch.setitem(sys.modules, library, None)
    assert set(QUERIES) <= set(contract.queries())
