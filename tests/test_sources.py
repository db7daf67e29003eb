"""Reading and writing records, and the staging folder."""

import json

import pytest

from tracemill.sources import sinks, staging
from tracemill.sources.records import load_records, read_csv, read_json_lines, with_id

CSV = (
    'id,prompt,answer\n000666,"line one\nsays ""hi"", then\n\nline four",00110100\n'
    '000b53cf,"  padded  ",1.10\nempty,,""\n'
)


def rows(df):
    return [tuple(row) for row in df.orderBy(df.columns[0]).collect()]


@pytest.mark.parametrize("name", ["t.csv", "t.CSV"])
def test_csv(spark, tmp_path, name):
    (tmp_path / name).write_text(CSV)
    found = load_records(spark, str(tmp_path / name))
    assert found.dtypes == [("id", "string"), ("prompt", "string"), ("answer", "string")]
    assert rows(found) == [
        ("000666", 'line one\nsays "hi", then\n\nline four', "00110100"),
        ("000b53cf", "  padded  ", "1.10"),
        ("empty", "", ""),
    ]


def test_csv_columns_come_from_the_header(spark, tmp_path):
    (tmp_path / "t.csv").write_text("answer,extra,id\n1,2,3\n")
    assert load_records(spark, str(tmp_path / "t.csv")).first().asDict() == {
        "answer": "1",
        "extra": "2",
        "id": "3",
    }


@pytest.mark.parametrize("suffix", ["jsonl", "ndjson", "JSONL"])
def test_json_lines(spark, tmp_path, suffix):
    path = tmp_path / f"t.{suffix}"
    lines = ['{"id": "1", "answer": "007", "prompt": "é\\n"}', "", "  ",
             '{"id": 2, "answer": 1.10, "reasoning": null}', '{"answer": true}']
    path.write_text("\n".join(lines), encoding="utf-8")
    found = load_records(spark, str(path)).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(
        [("007", "1", "é\n", None), ("1.10", "2", None, None), ("true", None, None, None)], key=repr
    )


def test_json_fields_are_a_choice(spark, tmp_path):
    (tmp_path / "t.jsonl").write_text('{"truth": "1", "guess": "2"}')
    found = load_records(spark, str(tmp_path / "t.jsonl"), ("truth", "guess"))
    assert rows(found) == [("1", "2")]


def test_json_lines_bring_all_their_fields(spark, tmp_path):
    (tmp_path / "t.jsonl").write_text('{"prediction": "p", "n": 1.50}\n{"meta": {"a": [1, 2.0]}}\n')
    found = load_records(spark, str(tmp_path / "t.jsonl"))
    assert found.dtypes == [("meta", "string"), ("n", "string"), ("prediction", "string")]
    assert sorted(map(tuple, found.collect()), key=repr) == [
        ('{"a": [1, 2.0]}', None, None), (None, "1.50", "p")]


def test_another_order_of_csv_columns_stops_the_read(spark, tmp_path):
    folder = tmp_path / "t.csv"
    folder.mkdir()
    (folder / "1.csv").write_text("id,prompt,answer\n1,p,a\n")
    (folder / "2.csv").write_text("id,answer,prompt\n2,a,p\n")
    with pytest.raises(Exception, match="(?i)header"):
        load_records(spark, str(folder)).collect()


def test_plain_csv_can_be_split(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,prompt\n1,x\n2,\n")
    assert rows(read_csv(spark, str(tmp_path / "t.csv"), multi_line=False)) == [("1", "x"), ("2", "")]


def test_a_bad_line_stops_the_read(spark, tmp_path):
    (tmp_path / "t.jsonl").write_text('{"id": "1"}\n{"id": \n')
    with pytest.raises(Exception, match="(?i)malformed|failfast"):
        load_records(spark, str(tmp_path / "t.jsonl")).collect()


def test_missing_path_and_other_suffix(spark, tmp_path):
    for name in ("t.csv", "t.jsonl", "t.parquet", "t.txt"):
        with pytest.raises(FileNotFoundError):
            load_records(spark, str(tmp_path / name))
    (tmp_path / "t.txt").write_text("x")
    with pytest.raises(ValueError, match=r"unsupported.*\.txt"):
        load_records(spark, str(tmp_path / "t.txt"))


def test_parquet_becomes_text(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.range(3).write.parquet(path)
    assert load_records(spark, path).dtypes == [("id", "string")]


def test_ids_are_derived_where_missing(texts):
    table = texts("prompt answer", [("p", "a"), ("q", "a")])
    found = [row["id"] for row in with_id(table).collect()]
    assert len(set(found)) == 2 and all(len(i) == 32 for i in found)
    partly = texts("id prompt answer", [("x", "p", "a"), (None, "p", "a")])
    assert {row["id"] for row in with_id(partly).collect()} == {"x", found[0]}
    odd = texts("id prompt answer", [("", "p", "a"), (None, None, "a"), ("", "a", None)])
    assert len({row["id"] for row in with_id(odd).collect()} - {""}) == 3


def test_append_and_replace(texts, spark, tmp_path):
    path = str(tmp_path / "out.jsonl")
    first, second = texts("id answer", [("1", "é")]), texts("id answer", [("2", None)])
    sinks.append_json_lines(first, path)
    sinks.append_json_lines(second, path)
    fields = ("id", "answer")
    assert rows(load_records(spark, path, fields)) == [("1", "é"), ("2", None)]
    lines = [line for file in (tmp_path / "out.jsonl").glob("*.json")
             for line in file.read_text(encoding="utf-8").splitlines()]
    assert sorted(lines) == ['{"id":"1","answer":"é"}', '{"id":"2","answer":null}']
    assert json.loads(lines[0])
    sinks.replace_json_lines(second, path)
    assert rows(load_records(spark, path, fields)) == [("2", None)]


def test_refuse_to_overwrite(texts, spark, tmp_path):
    path = str(tmp_path / "out.jsonl")
    table = texts("id", [("1",)])
    sinks.create_json_lines(table, path)
    with pytest.raises(Exception, match="(?i)already exists"):
        sinks.create_json_lines(table, path)
    sinks.create_json_lines(texts("id", [("2",)]), path, overwrite=True)
    assert rows(read_json_lines(spark, path, ("id",))) == [("2",)]


def test_training_text_sink(texts, spark, tmp_path):
    path = str(tmp_path / "out.parquet")
    sinks.write_training_text(texts("id text", [("1", "x")]), path)
    assert rows(load_records(spark, path)) == [("x",)]
    with pytest.raises(Exception, match="(?i)already exists"):
        sinks.write_training_text(texts("id text", [("1", "x")]), path)
    with pytest.raises(Exception, match="no text"):
        sinks.write_training_text(texts("id text", [("1", None)]), str(tmp_path / "other.parquet"))


def test_staged_tables_are_stored_and_still_prune_columns(texts, spark):
    staged = staging.stage(texts("id prompt", [("1", "x")]), "some")
    assert all(staging.staging_folder(spark) in file for file in staged.inputFiles())
    assert rows(staged) == [("1", "x")]
    plan = staged.select("id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:string>" in plan


class FakeSession:
    """Only the settings of a session."""

    def __init__(self, **values):
        named = {name.replace("__", "."): value for name, value in values.items()}
        self.conf = type("Conf", (), {"get": lambda _, name, default=None: named.get(name, default)})()


def test_the_folder_is_the_one_the_session_names():
    session = FakeSession(spark__master="yarn", spark__checkpoint__dir="hdfs:/scratch/")
    assert staging.staging_folder(session) == "hdfs:/scratch"


def test_no_temporary_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.staging_folder(FakeSession(spark__master="yarn"))


def test_a_temporary_folder_in_local_sessions():
    session = FakeSession(spark__master="local[4]", spark__app__id="here")
    assert staging.staging_folder(session) == staging.staging_folder(session)


def test_tables_stored_on_the_way_can_be_deleted(spark, texts):
    from pathlib import Path

    df = texts("id", [("a",)])
    with staging.stored_tables() as outer:
        staging.stage(df, "one")
        with staging.stored_tables() as inner:
            kept = staging.stage(df, "two")
    staging.stage(df, "three")
    assert len(outer) == 2 and inner == outer[1:]
    staging.release_paths(spark, outer[:1])
    gone, there = (Path(path.removeprefix("file:")) for path in outer)
    assert not gone.exists() and there.exists() and kept.count() == 1
