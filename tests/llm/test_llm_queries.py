"""Registered queries against their SQL, and the pipeline stage by stage."""

from pathlib import Path

import pytest

import corpus_pipeline
from tracemill.llm.oracles import ORACLES
from tracemill.llm.queries import QUERIES
from tracemill.sources.staging import stored_tables
from workload.compare import connect, differences


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, smallest, name):
    actual = QUERIES[name](spark, smallest).toPandas()
    assert differences(actual, connect(smallest).sql(ORACLES[name]).df()) == ""


def test_all_are_registered():
    import __spark_entry__ as contract

    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert QUERIES.keys() | {"pipeline"} <= contract.queries().keys()
    assert ORACLES.keys() <= contract.oracle_sql().keys()


def test_pipeline(spark, smallest, odd_documents, no_documents):
    docs = spark.read.parquet(f"{smallest}/documents.parquet")
    for given in (docs, odd_documents.withColumn("n_chars", odd_documents.doc_id), no_documents):
        kept, columns = given, given.columns
        for _, step in corpus_pipeline.STAGES[:-1]:
            before = kept.count()
            kept = step(spark, kept, smallest).cache()
            assert kept.columns == columns and kept.dtypes == given.dtypes
            assert kept.count() <= before
        name, last = corpus_pipeline.STAGES[-1]
        packed = last(spark, kept, smallest)
        assert packed.select("doc_id").distinct().count() == kept.select("doc_id").distinct().count()
    assert corpus_pipeline.run(spark, smallest).count() > 100


def test_a_run_leaves_its_last_tables_only(spark, smallest):
    with stored_tables() as paths:
        rows = corpus_pipeline.run(spark, smallest)
        assert rows.count() > 100
    there = [path for path in paths if Path(path.removeprefix("file:")).exists()]
    assert len(paths) > 25 and len(there) < 6
    assert any("pipeline-secret_scans" in path for path in there)


def test_pipeline_drops_copies_from_four_fifths_on(spark, smallest):
    """One word replaced: 45 of 55 shingles are shared (0.82), of shorter texts 38 of 48 (0.79)."""
    rows = []
    for name, size in (("v", 54), ("w", 47)):
        words = [f"{name}{i}" for i in range(size)]
        rows += [" ".join(words), " ".join([*words[:20], "x", *words[21:]])]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    kept = corpus_pipeline.drop_copies(spark, docs, smallest)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2, 3]
