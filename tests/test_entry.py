"""Driver contract: entry(), queries(), oracle_sql()."""

import pytest

import __spark_entry__ as E
from table_paths import SF_SMALL


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns == ["conv_id", "text"]


def test_every_query_of_the_library_has_an_oracle():
    """Training-data operators may have none: their tests hold them against
    plain Python."""
    from trainprep.plans.catalog import QUERIES

    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_runs_on_smallest_scale(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    assert df.count() >= 0


def test_plain_session_elsewhere(tmp_path):
    """The driver's view: a plain local session, another working directory,
    no checkpoint folder of ours; Arrow / pandas code must still import."""
    import os
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "4").getOrCreate()
import __spark_entry__ as E
assert len(E.entry(spark).collect()) > 0
assert E.queries()["pack_chars"](spark, {SF_SMALL!r}).count() > 0
assert E.queries()["export_path"](spark, {SF_SMALL!r}).count() > 0
print("ok")
"""
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0 and "ok" in out.stdout, out.stderr[-2000:]
