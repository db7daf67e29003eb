"""Every registered query against its SQL in DuckDB, on the smallest test data."""

import pytest

from workload.compare import connect, differences
from workload.oracles import ORACLES
from workload.registry import QUERIES

TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
}


@pytest.fixture(scope="module")
def duck(smallest):
    return connect(smallest)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, smallest, duck, name):
    frame = QUERIES[name](spark, smallest)
    relation = duck.sql(ORACLES[name])
    kinds = dict(zip(relation.columns, map(str, relation.types)))
    assert {column: TYPES[kind] for column, kind in frame.dtypes} == kinds
    assert differences(frame.toPandas(), relation.df()) == ""


def test_no_query_leaves_spark(spark, smallest):
    """Built-in expressions only, and no broadcast that Spark did not size itself."""
    for name in ("clean_traces", "verify_accepted", "eval_summary", "mixed_recipe", "text_reasoned"):
        execution = QUERIES[name](spark, smallest)._jdf.queryExecution()
        assert "Python" not in execution.executedPlan().toString()
        assert "broadcast" not in execution.analyzed().toString().lower()


def test_entry(spark):
    import __spark_entry__ as contract

    assert QUERIES.keys() <= contract.oracle_sql().keys() <= contract.queries().keys()
    frame = contract.entry(spark)
    assert frame.columns == ["origin", "id", "copy", "text"] and frame.count() > 0
