"""Packing (W3/W4): distributed fold vs the row-at-a-time loops."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trainprep.operators.packing import (
    FAN,
    assign_segment,
    compose_summaries,
    fold_summaries,
    pack_by_chars,
    partition_summary,
    sequential_pack,
)


def loop_append_or_flush(lengths, limit):
    out, chunk, cur, items = [], 0, 0, 0
    for x in lengths:
        if cur + x <= limit:
            cur += x
            items += 1
        else:
            if items:
                chunk += 1
            cur, items = x, 1
        out.append(chunk)
    return out


def loop_isolate(lengths, limit):
    out, shard, cur, items = [], -1, 0, 0
    for x in lengths:
        if x >= limit:
            cur, items = 0, 0
            shard += 1
            out.append(shard)
            continue
        if cur + x > limit:
            cur, items = 0, 0
        if not items:
            shard += 1
        cur += x
        items += 1
        out.append(shard)
    return out


def simulate(lengths, limit, isolate, cuts, batch):
    segs, prev = [], 0
    for c in list(cuts) + [len(lengths)]:
        segs.append(np.asarray(lengths[prev:c], dtype=np.int64))
        prev = c
    sums = []
    for p, seg in enumerate(segs):
        if seg.size:
            sums.append(dict(partition_summary(seg, limit, isolate), p=p))
    plan = fold_summaries(sums, limit)
    out = []
    for p, seg in enumerate(segs):
        if not seg.size:
            continue
        _, *state = plan[p]
        state = tuple(state)
        for i in range(0, seg.size, batch):
            ids, state = assign_segment(seg[i : i + batch], limit, isolate, state)
            out += ids.tolist()
    return out


def test_summary_is_run_length_encoded():
    """Varied lengths: chains from different head counts merge, so the
    summary is far smaller than the number of candidate head counts."""
    rnd = random.Random(5)
    lengths = np.asarray([rnd.randint(1, 50) for _ in range(20000)], dtype=np.int64)
    sm = partition_summary(lengths, 2000, False)
    assert (lengths.cumsum() <= 2000).sum() > 50 and len(sm["cnt"]) < (lengths.cumsum() <= 2000).sum() / 5


@settings(max_examples=400, deadline=None)
@given(
    lengths=st.lists(st.sampled_from([0, 0, 1, 2, 3, 5, 7, 10, 11, 12, 30]), max_size=40),
    limit=st.integers(0, 12),
    cuts=st.lists(st.integers(0, 40), max_size=5),
    batch=st.integers(1, 7),
    isolate=st.booleans(),
)
def test_fold_equals_loop(lengths, limit, cuts, batch, isolate):
    cuts = sorted(min(c, len(lengths)) for c in cuts)
    want = (loop_isolate if isolate else loop_append_or_flush)(lengths, limit)
    assert sequential_pack(lengths, limit, isolate) == want
    assert simulate(lengths, limit, isolate, cuts, batch) == want


@settings(max_examples=400, deadline=None)
@given(
    lengths=st.lists(st.sampled_from([0, 0, 1, 2, 3, 5, 7, 10, 11, 12, 30]), min_size=2, max_size=40),
    limit=st.integers(0, 40),
    cuts=st.lists(st.integers(1, 39), max_size=6),
    isolate=st.booleans(),
)
def test_composed_summary_is_the_fold(lengths, limit, cuts, isolate):
    """From every entry state, the composed summary leaves what the parts
    leave one after the other."""
    borders = sorted({0, len(lengths), *(c for c in cuts if c < len(lengths))})
    segs = [np.asarray(lengths[a:b], dtype=np.int64) for a, b in zip(borders, borders[1:])]
    sums = [dict(partition_summary(x, limit, isolate), p=p) for p, x in enumerate(segs)]
    whole = sums[0]
    for sm in sums[1:]:
        whole = compose_summaries(whole, sm, limit)
    end = dict(partition_summary(np.asarray([1], dtype=np.int64), 0, False))
    for is_open, open_len in [(False, 0), *((True, x) for x in range(limit + 3))]:
        entry = (5, is_open, open_len, 7)
        parts = fold_summaries([*sums, dict(end, p=len(sums))], limit, entry)[len(sums)]
        once = fold_summaries([dict(whole, p=0), dict(end, p=1)], limit, entry)[1]
        assert parts == once


@pytest.mark.parametrize("lengths", [[100] * 4000, list(range(1, 200)) * 20, [0] * 500 + [9] * 500], ids=["uniform", "varied", "zeros"])
def test_pack_through_two_levels(spark, lengths):
    """More range partitions than meet in one task, at a limit that spans many."""
    parts = FAN * FAN + 3
    df = spark.createDataFrame(list(enumerate(lengths)), "id long, n long")
    out = pack_by_chars(df, ["id"], "n", 10_000, num_partitions=parts)
    assert [r.chunk_id for r in out.orderBy("id").collect()] == loop_append_or_flush(lengths, 10_000)


@pytest.mark.parametrize("parts", [1, 3, 16])
@pytest.mark.parametrize("isolate", [False, True])
def test_spark_pack_partition_independent(spark, parts, isolate):
    rnd = random.Random(7 + parts)
    lengths = [rnd.choice([0, 1, 4, 9, 10, 25, 3, 3]) for _ in range(300)]
    df = spark.createDataFrame([(i, "x" * n) for i, n in enumerate(lengths)], "id long, text string")
    out = pack_by_chars(df, ["id"], F.length("text"), 10, isolate=isolate, num_partitions=parts)
    got = [r.chunk_id for r in out.orderBy("id").collect()]
    assert got == (loop_isolate if isolate else loop_append_or_flush)(lengths, 10)
    assert [r.ord for r in out.orderBy("id").collect()] == list(range(300))


def test_pack_keeps_text_and_never_cuts(spark):
    df = spark.createDataFrame([(i, f"doc{i}" * (i % 5 + 1)) for i in range(50)], "id long, text string")
    out = pack_by_chars(df, ["id"], F.length("text"), 40).orderBy("id").collect()
    assert [r.text for r in out] == [f"doc{i}" * (i % 5 + 1) for i in range(50)]
