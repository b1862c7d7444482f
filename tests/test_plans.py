"""Plan-level properties: single evaluation of parses, plans without size switches."""

import os

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from trainprep.operators.columns import computed_once
from trainprep.operators.logs import eval_rows, log_dicts
from trainprep.plans.tables import table
from trainprep.sources.files import parse_json_documents


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_filters_do_not_copy_parses(spark):
    lines = spark.createDataFrame([("{'eval_loss': 1.0, 'epoch': 2.0}",)], "value string")
    assert _optimized(eval_rows(log_dicts(lines))).count("from_json") == 1
    files = spark.createDataFrame([("p", "n", '{"messages": []}')], "path string, name string, value string")
    plan = _optimized(parse_json_documents(files).where(F.col("status") != "corrupt"))
    assert plan.count("from_json") == 2  # top-level keys, then the messages array


def test_computed_once_keeps_values(spark):
    df = spark.createDataFrame([(1, "a"), (2, "bb")], "id long, s string")
    out = computed_once(df, ["id"], n=F.length("s"), u=F.upper("s")).where("n > 1")
    assert [tuple(r) for r in out.collect()] == [(2, 2, "BB")]


def test_tables_have_one_plan_at_every_size(spark):
    for size in ("sf0.001", "sf0.01", "sf0.1"):
        plan = table(spark, f"/root/testdata/{size}", "documents")._jdf.queryExecution().toString()
        assert "Repartition" not in plan
