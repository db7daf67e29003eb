"""Run registered queries and their SQL side by side and compare all values."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

from tracemill.session import local_session
from workload.oracles import ORACLES
from workload.registry import QUERIES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def rows_of(frame: pd.DataFrame) -> list[tuple]:
    names = sorted(frame.columns)
    rows = zip(*(frame[name] for name in names)) if names else []
    plain = [tuple(None if pd.isna(value) else value for value in row) for row in rows]
    return sorted(plain, key=repr)


def differences(actual: pd.DataFrame, expected: pd.DataFrame) -> str:
    if sorted(actual.columns) != sorted(expected.columns):
        return f"columns {sorted(actual.columns)} / {sorted(expected.columns)}"
    if len(actual) != len(expected):
        return f"rows {len(actual)} / {len(expected)}"
    for left, right in zip(rows_of(actual), rows_of(expected)):
        if left != right:
            return f"first difference {str(left)[:400]} / {str(right)[:400]}"
    return ""


def main(sf_dir: str, *names: str) -> int:
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    bad = 0
    for name in names or QUERIES:
        started = time.time()
        actual = QUERIES[name](spark, sf_dir).toPandas()
        took = time.time() - started
        expected = connection.sql(ORACLES[name]).df()
        found = differences(actual, expected)
        bad += bool(found)
        print(f"{name:24s} {took:6.2f}s {len(actual):7d} rows  {found or 'equal'}", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(*sys.argv[1:]))
