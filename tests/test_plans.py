"""What the plans read and move."""

import pytest
from pyspark.sql import functions as F

from tracemill import exclude_ids, judge_traces, sample_exact
from tracemill.operators.checks import mix_report
from tracemill.operators.ranking import find_cut, seeded_key


@pytest.fixture
def stored(spark, tmp_path):
    def make(name, rows):
        path = str(tmp_path / name)
        number = F.col("id")
        spark.range(rows).select(
            F.concat(F.lit("p"), number).alias("id"),
            F.repeat(F.lit("long "), 20).alias("prompt"),
            number.cast("string").alias("answer"),
        ).write.parquet(path)
        return spark.read.parquet(path)

    return make


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df):
    return [line for line in plan(df).splitlines() if "FileScan" in line]


def schema_of(line):
    return line.split("ReadSchema: ")[1].strip()


def test_a_sample_filters_in_the_scan_and_moves_nothing(stored):
    sample = sample_exact(stored("problems", 1000), 300)
    assert "Exchange" not in plan(sample)
    assert "Sort" not in plan(sample)


def test_the_cut_reads_only_the_key(stored, monkeypatch):
    problems = stored("problems", 1000)
    seen = []
    collect = type(problems).collect
    monkeypatch.setattr(type(problems), "collect", lambda df: seen.append(df) or collect(df))
    find_cut(problems, seeded_key(1, "id"), 300)
    assert seen
    assert {schema_of(line) for df in seen for line in scans(df)} == {"struct<id:string>"}


def test_the_sample_is_cut_before_it_meets_the_used_ids(stored):
    """Both sides of the exclusion are filtered by the cut inside their scans."""
    pool = exclude_ids(stored("problems", 1000), stored("used", 100).select("id"))
    lines = plan(sample_exact(pool, 300)).splitlines()
    joined = [line for line in lines if "FileScan" in line and "isnotnull" in line]
    assert len(joined) == 2 and all("md5" in line for line in joined)


def test_counting_tables_reads_no_column(stored):
    problems = stored("problems", 100)
    mix = problems.select(F.lit("direct").alias("origin"), F.col("prompt").alias("text"))
    schemas = [schema_of(line) for line in scans(mix_report(problems, problems, problems, mix))]
    assert sorted(schemas) == ["struct<>"] * 3 + ["struct<prompt:string>"]


def test_judging_is_one_generated_stage(stored):
    traces = stored("problems", 10).withColumn("reasoning", F.col("prompt"))
    lines = plan(judge_traces(traces).filter("reject_reason is null")).splitlines()
    operators = [line for line in lines if line.lstrip(" +-:").startswith("*")]
    assert {line.split("*")[1][:3] for line in operators} == {"(1)"}
    assert any("Generate" in line for line in operators)
