"""Ordinal, split, dedup, shuffle."""

import math

import pytest
from pyspark.sql import functions as F

from trainprep.operators.curate import dedup_first, dedup_stats, seeded_shuffle
from trainprep.operators.ordinal import chunk_by_count, ordered_split, with_ordinal


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_ordinal_partition_independent(spark, parts):
    df = spark.range(0, 500).select((F.col("id") * 7919 % 500).alias("k"))
    out = with_ordinal(df, ["k"], num_partitions=parts).collect()
    assert sorted((r.k, r.ord) for r in out) == [(i, i) for i in range(500)]


@pytest.mark.parametrize("n,test_size", [(1000, 0.1), (70, 0.1), (3, 0.1), (10, 0.25)])
def test_split_sizes_follow_python_float(spark, n, test_size):
    df = with_ordinal(spark.range(n).select(F.col("id").alias("k")), ["k"])
    out = ordered_split(df, "ord", test_size).collect()
    n_test = math.ceil(test_size * n)  # 0.1 * 70 = 7.000000000000001 -> 8
    assert sum(r.split == "test" for r in out) == n_test
    assert all((r.split == "test") == (r.ord >= n - n_test) for r in out)


def test_chunk_by_count(spark):
    df = with_ordinal(spark.range(25).select(F.col("id").alias("k")), ["k"])
    got = sorted((r.ord, r.chunk_id) for r in chunk_by_count(df, "ord", 10).collect())
    assert [c for _, c in got] == [0] * 10 + [1] * 10 + [2] * 5


def test_dedup_keeps_first_and_counts(spark):
    rows = [(5, "a", "x"), (2, "a", "y"), (9, "b", "z"), (3, "a", "w")]
    df = spark.createDataFrame(rows, "ord long, text string, other string")
    out = dedup_first(df, "text", "ord", copies="copies")
    got = {r.text: (r.ord, r.other, r.copies) for r in out.collect()}
    assert got == {"a": (2, "y", 3), "b": (9, "z", 1)}
    s = dedup_stats(out).first()
    assert (s.n_in, s.n_out, s.n_removed) == (4, 2, 2)


def test_hot_duplicate_group(spark):
    """A third of all rows share one text: still one output row, min kept."""
    df = spark.range(3000).select(F.col("id").alias("ord"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text"))
    out = dedup_first(df, "text", "ord", copies="copies")
    hot = out.where("text = 'hot'").first()
    assert (hot.ord, hot.copies) == (0, 1000)
    assert out.count() == 2001


def test_seeded_shuffle_is_reproducible(spark):
    df = spark.createDataFrame([(i, f"t{i}") for i in range(100)], "ord long, text string")
    a = {r.ord: r.pos for r in seeded_shuffle(df, seed=42).collect()}
    b = {r.ord: r.pos for r in seeded_shuffle(df.repartition(7), seed=42).collect()}
    assert a == b and sorted(a.values()) == list(range(100)) and a != {i: i for i in range(100)}


def test_empty_inputs(spark):
    from trainprep.operators.packing import pack_by_chars
    from trainprep.operators.tokens import token_frequency, token_length_distribution

    empty = spark.createDataFrame([], "ord long, text string")
    assert with_ordinal(empty, ["ord"]).count() == 0
    assert ordered_split(with_ordinal(empty, ["ord"]), "ord", 0.1).count() == 0
    assert pack_by_chars(empty, ["ord"], F.length("text"), 10).count() == 0
    assert dedup_first(empty, "text", "ord", copies="c").count() == 0
    assert token_frequency(empty).count() == 0
    assert token_length_distribution(empty).first().n_rows == 0
