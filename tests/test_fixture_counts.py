"""Counts known for the short derived tables, with a third of the traces missing."""

import pytest
from pyspark.sql import functions as F

from tracemill import clean_traces, evaluate, exclude_ids
from tracemill.functions.answers import has_box
from workload.derived import predictions, problems, traces


@pytest.fixture(scope="module")
def short_traces(spark, smallest):
    number = F.substr("id", F.lit(2)).cast("bigint")
    return traces(spark, smallest).filter(number % 3 != 0)


def test_evaluation_counts(spark, smallest):
    table = predictions(spark, smallest)
    for tolerance, matched in ((0.001, 90), (0, 80)):
        found = evaluate(table, tolerance=tolerance).summary.first()
        assert (found["evaluated"], found["matched"]) == (200, matched)


def test_cleaning_counts(spark, smallest, short_traces):
    assert short_traces.count() == 133
    clean = clean_traces(short_traces)
    assert clean.count() == 53
    assert clean.filter(has_box(F.col("reasoning"))).count() == 13
    assert exclude_ids(problems(spark, smallest), clean).count() == 147
