"""Cases that an earlier review found: JSON datasets by form, Python literals
in logs, file names that repeat, one evaluation of the export search."""

import ast
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from trainprep.operators.export import convert_export, export_rejects
from trainprep.operators.logs import eval_rows, log_dicts
from trainprep.sinks.files import write_files, write_log_table
from trainprep.sources.files import load_dataset

ROWS = [{"a": 1, "b": "x\ny"}, {"a": 2, "b": "} {"}, {"a": 3, "b": None}]


@pytest.mark.parametrize(
    "text",
    ["\n".join(map(json.dumps, ROWS)), "\n\n" + "\n".join(map(json.dumps, ROWS)) + "\n", json.dumps(ROWS), json.dumps(ROWS, indent=2)],
    ids=["lines", "blank", "array", "indented"],
)
def test_json_dataset_forms(spark, tmp_path, text):
    path = tmp_path / "rows.json"
    path.write_text(text)
    assert [r.asDict() for r in load_dataset(spark, str(path)).orderBy("a").collect()] == ROWS


def test_json_dataset_of_one_indented_object(spark, tmp_path):
    path = tmp_path / "row.json"
    path.write_text(json.dumps(ROWS[0], indent=2))
    assert [r.asDict() for r in load_dataset(spark, str(path)).collect()] == ROWS[:1]


@pytest.mark.parametrize("first", ["lines", "whole"])
def test_json_dataset_of_mixed_forms_is_an_error(spark, tmp_path, first):
    lines, whole = "\n".join(map(json.dumps, ROWS)), json.dumps(ROWS, indent=2)
    a, b = (lines, whole) if first == "lines" else (whole, lines)
    (tmp_path / "a.json").write_text(a)
    (tmp_path / "b.json").write_text(b)
    with pytest.raises((ValueError, PySparkException)):
        load_dataset(spark, str(tmp_path), fmt="json").collect()


LITERALS = [
    "{'eval_loss': 1.0, 'epoch': 2, }",
    "{'eval_loss': .5, 'epoch': 5.}",
    "{'eval_loss': 1_0, 'epoch': 1}",
    "{'eval_loss': 1.5, 'epoch': 1, 'span': (1, 2)}",
    "{'eval_loss': 2.5, 'epoch': 1, 3: 4}",
    "{'eval_loss': True, 'epoch': 1}",
    "{'eval_loss': 1.0, 'epoch': 1, 'f': true}",
    "{'eval_loss': None, 'epoch': 1}",
    "{'eval_loss': '0.25', 'epoch': 1, 'epoch': 7}",
    "{'eval_loss': [1], 'epoch': 1}",
    "{1, 2}",
    "{",
    "plain",
]


def _python(line):
    try:
        d = ast.literal_eval(line)
        return (float(d["eval_loss"]), float(d["epoch"])) if isinstance(d, dict) else None
    except (ValueError, SyntaxError, TypeError, KeyError):
        return None


def test_log_literals_by_python_rules(spark):
    df = spark.createDataFrame([(x,) for x in [*LITERALS, None]], "value string")
    got = sorted(tuple(r) for r in eval_rows(log_dicts(df, exact=True)).collect())
    assert got == sorted(p for p in map(_python, LITERALS) if p)


def test_written_files_need_distinct_names_and_contents(spark, tmp_path):
    twice = spark.createDataFrame([("a", "1"), ("a", "2")], "name string, content string")
    with pytest.raises(PySparkException, match="share a file name"):
        write_files(twice, str(tmp_path / "twice")).collect()
    none = spark.createDataFrame([("a", None)], "name string, content string")
    with pytest.raises(PySparkException, match="no content for a"):
        write_files(none, str(tmp_path / "none")).collect()


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_empty_log_table_keeps_its_columns(spark, tmp_path, fmt):
    for i, empty in enumerate([spark.range(8).repartition(4).where("id < 0"), spark.createDataFrame([], "id long")]):
        path = str(tmp_path / str(i))
        write_log_table(empty.select(F.col("id").alias("loss"), F.col("id").alias("epoch")), path, ["loss", "epoch"], fmt)
        reader = spark.read.option("header", "true") if fmt == "csv" else spark.read
        assert reader.format(fmt).load(path).columns == ["loss", "epoch"]


def test_export_search_runs_once(spark):
    df = spark.createDataFrame([('{"a": 1}',), ('{"messages": []}',)], "value string")
    rejects = export_rejects(convert_export(df))
    assert rejects._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert [r.status for r in rejects.collect()] == ["missing_key"]
