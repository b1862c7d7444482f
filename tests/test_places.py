"""Places of rows and lines without a sort; dict literals by Python's rules."""

import ast
import random

import pytest
from pyspark.sql import functions as F

from trainprep.operators.logs import compare_runs, log_dicts
from trainprep.operators.ordinal import ordered_split, with_ordinal
from trainprep.sources.files import log_lines, run_log_lines
from trainprep.sources.parquet import numbered_scan


@pytest.fixture()
def small_splits(spark):
    """Files are cut into many splits."""
    keys = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "10"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_of_many_files_and_row_groups(spark, tmp_path, small_splits):
    """Order of file names (one with a blank and a plus sign), then rows; row
    groups of a few rows are read by different tasks."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    want = []
    for k, name in enumerate(["a b+c.parquet", "a!.parquet", "a.parquet", "b%20.parquet", "empty.parquet"]):
        texts = [None if i % 7 == 0 else f"{k}-{i}" for i in range(0 if name.startswith("empty") else 50 + 90 * k)]
        pq.write_table(pa.table({"text": pa.array(texts, pa.string()), "other": list(range(len(texts)))}), tmp_path / name, row_group_size=20)
        want.append((name, texts))
    want = [t for _, texts in sorted(want) for t in texts]
    df = numbered_scan(spark, [str(tmp_path)])
    assert df.rdd.getNumPartitions() > 4
    assert [(r.ord, r.text) for r in sorted(df.collect())] == list(enumerate(want))


def test_numbering_moves_no_row(spark, tmp_path):
    spark.range(1000).selectExpr("cast(id as string) text").write.parquet(str(tmp_path / "t"))
    df = numbered_scan(spark, [str(tmp_path / "t")])
    df.collect()
    plan = _plan(df)
    # the only exchanges are those of the footers' counts, below the broadcast
    outer = plan.split("BroadcastExchange")[0] if "BroadcastExchange" in plan else plan
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in outer.split("Initial Plan")[0] and "rangepartitioning" not in plan


def test_missing_column_is_named(spark, tmp_path):
    spark.range(3).selectExpr("cast(id as string) text").write.parquet(str(tmp_path / "t/a"))
    spark.range(3).selectExpr("id x").write.parquet(str(tmp_path / "t/b"))
    with pytest.raises(ValueError, match="required column"):
        numbered_scan(spark, [str(tmp_path / "t/a"), str(tmp_path / "t/b")])


def test_lines_of_many_splits(spark, tmp_path, small_splits):
    rng = random.Random(1)
    want = []
    for name in ["z.log", "a.log", "m n.log"]:
        lines = [f"{name} {i} " + "x" * rng.randrange(60) for i in range(120)]
        (tmp_path / name).write_bytes(b"".join(x.encode() + rng.choice([b"\n", b"\r\n"]) for x in lines) + b"end \xff\xc3")
        want.append((name, lines + ["end ��"]))
    want = [x for _, lines in sorted(want) for x in lines]
    df = log_lines(spark, str(tmp_path))
    assert df.rdd.getNumPartitions() > 4
    assert [(r.line, r.value) for r in sorted(df.collect())] == list(enumerate(want))


def test_lines_are_numbered_by_run(spark, tmp_path):
    for rank in (8, 16):
        (tmp_path / f"train_rank{rank}.log").write_text("".join(f"r{rank} line {i}\n" for i in range(rank)))
    rows = run_log_lines(spark, f"{tmp_path}/train_rank*.log").collect()
    assert sorted((r["rank"], r.line, r.value) for r in rows) == [(k, i, f"r{k} line {i}") for k in (8, 16) for i in range(k)]


def _random_literal(rng):
    number = lambda: rng.choice(["1", "-2.5", ".5", "1e-05", "1_0", "01", "0", "1.", "-0", "3E+2", "0x1f", "12345678901234567890", "nan", "1.50", "+7", "2j"])
    string = lambda: rng.choice(["'a'", '"b c"', "'it\\'s'", "''", "'é漢'", '"\\n"', "'\\\\'", "r'x'", "b'y'", "'a' 'b'"])
    value = lambda: rng.choice([number, number, string, lambda: rng.choice(["None", "True", "False", "true", "null", "[1, 2]", "(1,)", "{}", "", "..."])])()
    items = [f"{rng.choice([string(), string(), string(), number()])}{rng.choice([':', ': ', ' : '])}{value()}" for _ in range(rng.randrange(4))]
    return "{" + rng.choice([", ", ",", " ,"]).join(items) + rng.choice(["", "", ",", " ", ", "]) + "}"


def test_dict_literals_are_what_python_reads(spark):
    """Which lines are dicts, their string keys, and every value as a float."""
    rng = random.Random(6)
    lines = [_random_literal(rng) for _ in range(4000)] + ["{'loss': 1.0, 'epoch': 2}"] * 5
    df = spark.createDataFrame(list(enumerate(lines)), "n long, value string")
    got = {r.n: r.d for r in log_dicts(df).collect()}

    def as_float(v):
        try:
            return float(v)
        except (TypeError, ValueError, OverflowError):
            return None

    plain = 0
    for n, text in enumerate(lines):
        try:
            d = ast.literal_eval(text[: text.index("}") + 1])
        except (ValueError, SyntaxError, TypeError):
            d = None
        if not isinstance(d, dict):
            assert n not in got, text
            continue
        want = {k: v for k, v in d.items() if isinstance(k, str)}
        assert set(got[n]) == set(want), text
        for k, v in want.items():
            a, b = as_float(got[n][k]), as_float(v)
            assert a == b or (a != a and b != b), (text, k)
            assert not isinstance(v, str) or got[n][k] == v
        plain += 1
    assert plain > 500


def test_last_train_loss_of_one_epoch_is_the_last_line(spark):
    rows = [(1, i, f"{{'loss': {loss}, 'grad_norm': 1, 'learning_rate': 1, 'epoch': 2}}") for i, loss in enumerate([3.5, 0.5, 1.5])]
    df = spark.createDataFrame(rows, "rank long, line long, value string").repartition(3)
    assert compare_runs(log_dicts(df)).first().last_train_loss == 1.5


@pytest.mark.parametrize("n", [1, 9, 70, 101])
def test_split_needs_no_count(spark, n):
    ordered = with_ordinal(spark.range(n).select("id"), ["id"], total="n")
    by_column = ordered_split(ordered, "ord", 0.1, n="n")
    by_count = ordered_split(ordered.drop("n"), "ord", 0.1, n=n)
    assert sorted(by_column.collect()) == sorted(by_count.collect()) and "n" not in by_column.columns
