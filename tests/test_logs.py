"""Log tables (L1-L4), Python float quirks, early stop vs a loop."""

import random

import pytest
from pyspark.sql import functions as F

from trainprep.functions.text import py_float
from trainprep.operators.logs import compare_runs, early_stop, eval_rows, first_dict, log_dicts, parse_dict, train_rows


@pytest.mark.parametrize(
    "text,expected",
    [("1_0", 10.0), ("1d", None), (" 2.5 ", 2.5), ("1__0", None), (".5", 0.5), ("5.", 5.0), ("abc", None),
     ("-inf", float("-inf")), ("1e-05", 1e-05), ("1.0E-4", 1e-04), ("", None)],
)
def test_py_float(spark, text, expected):
    got = spark.createDataFrame([(text,)], "s string").select(py_float("s").alias("f")).first().f
    assert got == expected


def test_dict_parse_and_routing(spark):
    lines = [
        "step: {'loss': '1.5', 'grad_norm': 2.0, 'learning_rate': 5e-05, 'epoch': 0.1} tail",
        "{'eval_loss': 0.7, 'epoch': 0.2}",
        "{'loss': 1.0, 'grad_norm': }",
        "{'loss': {'value': 6.55}, 'epoch': 1}",
        " 10%|#   | 1/10",
        "{'loss': 1.0, 'epoch': 0.3}",
        "{'eval_loss': 'bad', 'epoch': 0.4}",
        "{'loss': 2.0, 'grad_norm': None, 'learning_rate': 1, 'epoch': 1, 'ok': True}",
        "{'loss': 3.0, 'eval_loss': 0.5, 'epoch': 0.5}",
    ]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    d = log_dicts(df)
    train = [tuple(r) for r in train_rows(d).collect()]
    evals = sorted(tuple(r) for r in eval_rows(d).collect())
    assert train == [(1.5, 2.0, 5e-05, 0.1)]
    assert evals == [(0.5, 0.5), (0.7, 0.2)]
    nested = df.select(first_dict("value").alias("m")).collect()[3].m
    assert nested == "{'loss': {'value': 6.55}"
    assert df.select(parse_dict(first_dict("value")).alias("d")).collect()[7].d["ok"] == "true"


def loop_early_stop(losses, patience, threshold):
    best, counter = None, 0
    for i, x in enumerate(losses, start=1):
        if best is None or (x < best and abs(x - best) > threshold):
            counter = 0
        else:
            counter += 1
        best = x if best is None or x < best else best
        if counter >= patience:
            return i
    return None


def loop_early_stop_nan(losses, patience, threshold):
    first_bad, best, counter = losses[0] != losses[0], None, 0
    for i, x in enumerate(losses, start=1):
        better = i == 1 or (not first_bad and best is not None and best - x > threshold)
        counter = 0 if better else counter + 1
        if x == x:
            best = x if best is None else min(best, x)
        if counter >= patience:
            return i
    return None


def test_early_stop_matches_loop(spark):
    rnd = random.Random(3)
    rows, want = [], {}
    for run in range(40):
        n = rnd.randint(1, 30)
        losses = [round(rnd.uniform(0.5, 2.0) - 0.02 * i * rnd.random(), 3) for i in range(n)]
        want[run] = loop_early_stop(losses, 3, 1e-3)
        rows += [(run, float(i), x) for i, x in enumerate(losses)]
    df = spark.createDataFrame(rows, "rank long, epoch double, loss double")
    got = {r.rank: r for r in early_stop(df, patience=3, threshold=1e-3).collect()}
    for run, stop in want.items():
        assert (None if got[run].stop_epoch is None else int(got[run].stop_epoch) + 1) == stop


@pytest.mark.parametrize("parts", [1, 3, 16])
@pytest.mark.parametrize("patience", [1, 3, 7])
def test_early_stop_is_the_loop_at_any_partitioning(spark, parts, patience):
    """A hot run over many range partitions, runs that begin and end inside one,
    plateaus that cross borders, NaN losses."""
    rnd = random.Random(parts * 10 + patience)
    rows, want = [], {}
    for run, n in [(0, 700), *((r, rnd.randint(1, 40)) for r in range(1, 25))]:
        losses = [float("nan") if rnd.random() < 0.05 else round(3.0 - 0.004 * i * rnd.choice([1, 1, 0.2]), 3) for i in range(n)]
        want[run] = loop_early_stop_nan(losses, patience, 1e-3)
        rows += [(run, float(i), x) for i, x in enumerate(losses)]
    df = spark.createDataFrame(rows, "rank long, epoch double, loss double")
    got = early_stop(df, patience=patience, threshold=1e-3, num_partitions=parts).collect()
    assert {r.rank: None if r.stop_epoch is None else int(r.stop_epoch) + 1 for r in got} == want
    sizes = {run: sum(r[0] == run for r in rows) for run in want}
    assert all(r.n_evals == sizes[r.rank] and r.evals_seen == (want[r.rank] or sizes[r.rank]) for r in got)


def test_early_stop_plan_has_no_row_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS rank", "id AS epoch", "1D / (id + 1) AS loss")
    out = early_stop(df)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_runs_without_evaluation_are_last(spark):
    lines = ["1 {'eval_loss': 0.5, 'epoch': 1}", "1 {'eval_loss': 0.5, 'epoch': 2}", "2 {'eval_loss': 1e999, 'epoch': 1}",
             "3 {'loss': 1, 'grad_norm': 1, 'learning_rate': 1, 'epoch': 1}", "4 {'eval_loss': 0.5, 'epoch': 3}"]
    df = spark.createDataFrame([(int(x[0]), x) for x in lines], "rank long, value string")
    got = {r["rank"]: (r.place, r.n_evals, r.n_train, r.best_epoch) for r in compare_runs(log_dicts(df, exact=True)).collect()}
    assert got == {1: (1, 2, None, 1.0), 4: (1, 1, None, 3.0), 2: (3, 1, None, 1.0), 3: (4, None, 1, None)}


def test_duplicate_keys_last_wins(spark):
    df = spark.createDataFrame([("{'loss': 1.0, 'loss': 2.0, 'epoch': 0.5, 'grad_norm': 1, 'learning_rate': 1}",)], "value string")
    assert [r.loss for r in train_rows(log_dicts(df)).collect()] == [2.0]


def test_early_stop_hot_run_across_partitions(spark):
    """One run holds nearly all evaluations and spans many range partitions."""
    rnd = random.Random(9)
    losses = [2.0 - 0.01 * i if i < 250 else 0.5 + rnd.random() * 1e-4 for i in range(400)]
    rows = [(1, float(i), x) for i, x in enumerate(losses)] + [(2, float(i), 1.0) for i in range(5)]
    df = spark.createDataFrame(rows, "rank long, epoch double, loss double")
    got = {r.rank: r for r in early_stop(df, patience=3, threshold=1e-3, num_partitions=16).collect()}
    assert int(got[1].stop_epoch) + 1 == loop_early_stop(losses, 3, 1e-3)
    assert int(got[2].stop_epoch) + 1 == loop_early_stop([1.0] * 5, 3, 1e-3)
