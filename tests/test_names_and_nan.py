"""Numbered names beyond their width, JSON strings, dict lines, NaN losses
and doubled replies."""

from __future__ import annotations

import json
import math

import pytest
from pyspark.sql import functions as F

from trainprep.functions.text import json_query, zero_pad
from trainprep.operators.dialogue import complete_sessions
from trainprep.operators.logs import early_stop, first_dict
from trainprep.sinks.files import chunk_name


def test_names_grow_beyond_their_width(spark):
    ids = [0, 999, 9_999, 10_000, 99_999, 100_000, 1_000_000]
    rows = spark.createDataFrame([(i,) for i in ids], "c long").select("c", chunk_name("c", "part", 4, 1).alias("p"), zero_pad("c", 6).alias("z")).collect()
    assert [r.p for r in rows] == [f"part_{i + 1:04d}" for i in ids]
    assert [r.z for r in rows] == [f"{i:06d}" for i in ids]


@pytest.mark.parametrize("text", ["a", "a b", "a ", "\u0085", 'q"\\\n', "", None])
def test_json_query_keeps_the_text(spark, text):
    row = spark.createDataFrame([(text,)], "t string").select(json_query("t").alias("q")).first()
    assert json.loads(row.q) == {"query": text}


@pytest.mark.parametrize("sep", ["\u0085", " ", " ", " "])
def test_first_dict_crosses_line_separators(spark, sep):
    row = spark.createDataFrame([(f"x {{'loss':{sep}1}} y {{2}}",)], "t string").select(first_dict("t").alias("d")).first()
    assert row.d == f"{{'loss':{sep}1}}"


def loop(losses, patience=3, threshold=1e-3):
    best, bad = None, 0
    for i, x in enumerate(losses):
        if best is None or best - x > threshold:
            best, bad = x, 0
        else:
            bad += 1
        if bad >= patience:
            return i + 1
    return len(losses)


NAN = math.nan


@pytest.mark.parametrize("losses", [[1.0] + [NAN] * 6, [NAN, 1.0, 0.5, 0.2, 0.1], [3.0, 2.0, NAN, 1.0, NAN, NAN, NAN, 0.5], [NAN] * 5, [5.0, 4.0, 3.0], [1.0, NAN, NAN, 0.5, 0.4]])
def test_early_stop_with_nan_is_the_plain_loop(spark, losses):
    df = spark.createDataFrame([(1, float(i), x) for i, x in enumerate(losses)], "rank int, epoch double, loss double")
    assert early_stop(df).first().evals_seen == loop(losses)


def test_doubled_replies_do_not_make_a_session_complete(spark):
    rows = [(1, 0, "A"), (1, 0, "A"), (1, 0, "B"), (2, 0, "A"), (2, 0, "B"), (2, 1, "A"), (3, 0, "A"), (3, 0, "B"), (3, 1, "A"), (3, 1, "A")]
    df = spark.createDataFrame(rows, "session int, turn int, agent string").withColumn("valid", F.lit(True))
    good, bad = complete_sessions(df, 2)
    assert [r.session for r in good.collect()] == [2]
    assert {r.session: r.reason for r in bad.collect()} == {1: "missing_reply", 3: "duplicate_reply"}


def test_sessions_asked_for_without_replies(spark):
    df = spark.createDataFrame([(1, 0, "A", True)], "session int, turn int, agent string, valid boolean")
    asked = spark.createDataFrame([(1,), (2,), (2,)], "session int")
    good, bad = complete_sessions(df, 1, asked)
    assert [r.session for r in good.collect()] == [1]
    assert [(r.session, r.reason) for r in bad.collect()] == [(2, "missing_reply")]
    good, bad = complete_sessions(df, 0, asked)
    assert sorted(r.session for r in good.collect()) == [1, 2] and bad.count() == 0
