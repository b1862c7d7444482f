"""Order-dependent and aggregate queries give the same answer whatever the
number of shuffle partitions."""

import math
from collections import Counter

import pytest

import __spark_entry__ as E
from table_paths import SF_SMALL

QUERIES = [
    "render_sft", "token_freq", "dedup_exact", "seeded_shuffle", "pack_chars", "shard_shuffled",
    "train_test_split", "json_chunks", "early_stop", "rank_compare", "transcript", "openers_clean",
]


def _rows(df):
    def norm(v):
        return "nan" if isinstance(v, float) and math.isnan(v) else v

    cols = sorted(df.columns)
    return Counter(tuple(norm(r[c]) for c in cols) for r in df.collect())


@pytest.mark.parametrize("name", QUERIES)
def test_same_result_any_partitioning(spark, name):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        one = _rows(E.queries()[name](spark, SF_SMALL))
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        many = _rows(E.queries()[name](spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert one == many
