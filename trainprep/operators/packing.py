"""Character-budget packing (W3) and sharding with oversize isolation.

Both are greedy folds in a total order.  They run as an exact distributed
fold in three steps over the range-sorted, checkpointed frame of
:func:`trainprep.operators.ordinal.range_sorted`:

1. ``mapInArrow`` over ``(_rid, length)`` only.  For one partition the
   sequential state coming in matters only through *how many head rows
   ``k`` join the chunk that is still open*; after that every cut is fixed.
   Each partition reports, for each ``k`` that can occur (head rows whose
   total fits the limit), how many chunks it starts and the state it leaves.
2. Summaries of neighbouring partitions compose into summaries of the same
   form and size, so blocks of them meet in a tree of tasks; walking the
   tree down again gives each partition's entry state.  The driver gets
   those states only: four numbers per range partition.
3. ``mapInArrow`` over the full rows again streams each partition batch by
   batch, carrying the open chunk across batches, and appends ``ord`` and
   the chunk id.  Text is never shuffled or joined back; it only passes
   through Arrow buffers untouched.

Rules (``limit`` = C, ``L`` = row length in characters):
- append-or-flush (W3): a row joins the open chunk if the total stays <= C,
  else it opens a new chunk; the first row of a chunk always fits.
- isolate (W4): as W3, but a row with L >= C closes the open chunk and
  forms a closed chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trainprep.functions.text import char_length
from trainprep.operators.ordinal import RID, ROW_BITS, ROW_MASK, range_sorted
from trainprep.session import scratch_dir

LEN = "_len"


# ---------------------------------------------------------------- numpy core


def next_starts(lengths: np.ndarray, limit: int, isolate: bool) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums ``S`` (n+1) and ``nxt[i]`` = first row after a chunk that
    starts at row ``i`` (all rows local to one segment)."""
    n = lengths.size
    s = np.zeros(n + 1, dtype=np.int64)
    np.cumsum(lengths, out=s[1:])
    idx = np.arange(n, dtype=np.int64)
    fit = np.searchsorted(s, s[:-1] + limit, side="right") - 1
    nxt = np.minimum(np.maximum(idx + 1, fit), n)
    if isolate:
        big = lengths >= limit
        first_big = np.minimum.accumulate(np.where(big, idx, n)[::-1])[::-1]
        nxt = np.where(big, idx + 1, np.minimum(nxt, first_big))
    return s, nxt


def chain_stats(nxt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every start row ``i``: chunks on the chain ``i, nxt[i], ...`` and
    its last chunk start.  Pointer jumping: O(n log n) vector work."""
    n = nxt.size
    cnt = np.ones(n, dtype=np.int64)
    last = np.arange(n, dtype=np.int64)
    ptr = nxt.astype(np.int64).copy()
    while True:
        live = np.nonzero(ptr < n)[0]
        if live.size == 0:
            return cnt, last
        hop = ptr[live]
        new_cnt = cnt[live] + cnt[hop]
        new_last = last[hop]
        new_ptr = ptr[hop]
        cnt[live], last[live], ptr[live] = new_cnt, new_last, new_ptr


def head_join_count(s: np.ndarray, k_max: int, open_len: int, limit: int) -> int:
    """Head rows that join an open chunk of ``open_len`` characters."""
    k = int(np.searchsorted(s[: k_max + 1], limit - open_len, side="right")) - 1
    return max(0, min(k, k_max))


def head_limit(lengths: np.ndarray, s: np.ndarray, limit: int, isolate: bool) -> int:
    """Largest number of head rows that could ever join an open chunk."""
    k_max = int(np.searchsorted(s, limit, side="right")) - 1
    if isolate:
        big = np.nonzero(lengths >= limit)[0]
        if big.size:
            k_max = min(k_max, int(big[0]))
    return max(0, min(k_max, lengths.size))


def assign_segment(lengths: np.ndarray, limit: int, isolate: bool, state: tuple[bool, int, int]):
    """Sequential semantics on one segment given ``(open, open_len, open_id)``.

    Returns chunk ids and the state after the segment.  ``open_id`` is the
    id of the open chunk (new chunks get ``open_id + 1, ...``).
    """
    is_open, open_len, open_id = state
    n = lengths.size
    ids = np.empty(n, dtype=np.int64)
    if n == 0:
        return ids, state
    s, nxt = next_starts(lengths, limit, isolate)
    k = head_join_count(s, head_limit(lengths, s, limit, isolate), open_len, limit) if is_open else 0
    ids[:k] = open_id
    if k == n:
        return ids, (True, open_len + int(s[n]), open_id)
    starts = [k]
    while starts[-1] < n:
        starts.append(int(nxt[starts[-1]]))
    starts_arr = np.asarray(starts[:-1], dtype=np.int64)
    rows = np.arange(k, n, dtype=np.int64)
    ids[k:] = open_id + np.searchsorted(starts_arr, rows, side="right")
    tail = int(starts_arr[-1])
    closed = isolate and lengths[tail] >= limit
    return ids, (not closed, int(s[n] - s[tail]), open_id + starts_arr.size)


def sequential_pack(lengths: Sequence[int], limit: int, isolate: bool = False) -> list[int]:
    """Row-at-a-time reference semantics, for tests (0-based chunk ids)."""
    out: list[int] = []
    chunk, cur, buffered = -1, 0, False
    for x in lengths:
        if isolate and x >= limit:
            chunk += 1
            out.append(chunk)
            cur, buffered = 0, False
            continue
        if buffered and cur + x > limit:
            buffered = False
        if not buffered:
            chunk += 1
            cur, buffered = 0, True
        cur += x
        out.append(chunk)
    return out


# ------------------------------------------------------- distributed passes

_SUMMARY = T.StructType(
    [
        T.StructField("p", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("total", T.LongType()),
        T.StructField("whole", T.BooleanType()),
        T.StructField("start", T.ArrayType(T.LongType())),
        T.StructField("cnt", T.ArrayType(T.LongType())),
        T.StructField("tail_len", T.ArrayType(T.LongType())),
        T.StructField("tail_closed", T.ArrayType(T.BooleanType())),
    ]
)

_ENTRY = "p long, row_offset long, open boolean, open_len long, open_id long"


def _runs(start, cnt, tail_len, closed) -> dict:
    """The four columns with neighbouring equal outcomes as one entry."""
    change = np.ones(start.size, dtype=bool)
    change[1:] = (cnt[1:] != cnt[:-1]) | (tail_len[1:] != tail_len[:-1]) | (closed[1:] != closed[:-1])
    return {"start": start[change], "cnt": cnt[change], "tail_len": tail_len[change], "tail_closed": closed[change]}


def partition_summary(lengths: np.ndarray, limit: int, isolate: bool) -> dict:
    """What one partition does for each room ``b`` (``limit`` less the open
    chunk's length; -1: no open chunk) it can be entered with: the chunks it
    starts and the chunk it leaves.

    ``whole`` and ``b >= total``: every row joins the open chunk.  Otherwise
    the last entry with ``start <= b`` holds.  The outcome is constant over
    long ranges (chains from nearby starts merge); there are never more
    entries than head rows that fit the budget.
    """
    n = lengths.size
    s, nxt = next_starts(lengths, limit, isolate)
    cnt, last = chain_stats(nxt)
    k_max = head_limit(lengths, s, limit, isolate)
    ks = np.arange(min(k_max, n - 1) + 1, dtype=np.int64)
    # of head counts with one prefix sum (rows without length) the largest holds
    ks = ks[np.append(s[ks][1:] != s[ks][:-1], True)] if n else ks
    start = s[ks]
    c, t = cnt[ks], last[ks]
    if ks[0] != 0:  # entered with no open chunk, no row joins
        ks, start, c, t = (np.insert(x, 0, y) for x, y in ((ks, 0), (start, 0), (c, cnt[0]), (t, last[0])))
        start[0] = -1
    else:
        # b = 0 and b = -1 alike: the first row does not join
        start[0] = -1
    closed = (lengths[t] >= limit) & isolate
    return {"n": n, "total": int(s[n]), "whole": k_max >= n, **_runs(start, c, s[n] - s[t], closed)}


def _lookup(sm: dict, room: np.ndarray) -> np.ndarray:
    return np.searchsorted(sm["start"], room, side="right") - 1


def compose_summaries(f: dict, g: dict, limit: int) -> dict:
    """The summary of two neighbouring stretches, ``f`` before ``g``."""
    # entries of f, carried through g
    keep = f["start"] < f["total"] if f["whole"] else np.ones(f["start"].size, dtype=bool)
    keep[0] = True
    start, cnt, tail, closed = f["start"][keep], f["cnt"][keep], f["tail_len"][keep], f["tail_closed"][keep]
    room = np.where(closed, -1, np.maximum(limit - tail, -1))
    joins = (room >= g["total"]) & g["whole"]
    j = _lookup(g, room)
    cnt = cnt + np.where(joins, 0, g["cnt"][j])
    closed = np.where(joins, False, g["tail_closed"][j])
    tail = np.where(joins, tail + g["total"], g["tail_len"][j])
    if f["whole"]:
        # room for all of f: the entries of g, further up
        start = np.append(start, f["total"] + np.maximum(g["start"], 0))
        cnt, tail, closed = np.append(cnt, g["cnt"]), np.append(tail, g["tail_len"]), np.append(closed, g["tail_closed"])
    return {"n": f["n"] + g["n"], "total": f["total"] + g["total"], "whole": f["whole"] and g["whole"], **_runs(start, cnt, tail, closed)}


def _summarize(limit: int, isolate: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rids, lens = [], []
        for b in batches:
            if b.num_rows:
                rids.append(b.column(RID).to_numpy(zero_copy_only=False))
                lens.append(b.column(LEN).to_numpy(zero_copy_only=False))
        if not rids:
            return
        rid = np.concatenate(rids)
        lengths = np.concatenate(lens).astype(np.int64)
        order = np.argsort(rid, kind="stable")
        summary = partition_summary(lengths[order], limit, isolate)
        summary["p"] = int(rid[order][0]) >> ROW_BITS
        yield pa.RecordBatch.from_pylist([summary], schema=_SUMMARY_ARROW)

    return run


_SUMMARY_ARROW = pa.schema(
    [
        ("p", pa.int64()),
        ("n", pa.int64()),
        ("total", pa.int64()),
        ("whole", pa.bool_()),
        ("start", pa.list_(pa.int64())),
        ("cnt", pa.list_(pa.int64())),
        ("tail_len", pa.list_(pa.int64())),
        ("tail_closed", pa.list_(pa.bool_())),
    ]
)

NO_ROWS = (0, False, 0, -1)


def fold_summaries(summaries: list[dict], limit: int, entry: tuple[int, bool, int, int] = NO_ROWS) -> dict[int, tuple[int, bool, int, int]]:
    """``p -> (row_offset, open, open_len, open_id)``: the state each of the
    neighbouring stretches starts in, ``entry`` being that of the first."""
    plan = {}
    offset, is_open, open_len, open_id = entry
    for sm in sorted(summaries, key=lambda r: r["p"]):
        plan[sm["p"]] = (offset, is_open, open_len, open_id)
        offset += sm["n"]
        room = max(limit - open_len, -1) if is_open else -1
        if sm["whole"] and room >= sm["total"]:
            open_len += sm["total"]  # every row joins the open chunk
            continue
        j = int(_lookup(sm, room))
        open_id += int(sm["cnt"][j])
        open_len = int(sm["tail_len"][j])
        is_open = not sm["tail_closed"][j]
    return plan


#: Summaries that meet in one task of the tree.
FAN = 16


def _compose_block(limit: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = pdf.sort_values("p").to_dict("records")
        whole = rows[0]
        for sm in rows[1:]:
            whole = compose_summaries(whole, sm, limit)
        return pd.DataFrame([{**whole, "p": rows[0]["p"] // FAN}])[_SUMMARY.fieldNames()]

    return run


def _enter_block(limit: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        first = pdf.iloc[0]
        entry = (int(first["row_offset"]), bool(first["open"]), int(first["open_len"]), int(first["open_id"]))
        plan = fold_summaries(pdf[_SUMMARY.fieldNames()].to_dict("records"), limit, entry)
        rows = [(p, *state) for p, state in plan.items()]
        return pd.DataFrame(rows, columns=["p", "row_offset", "open", "open_len", "open_id"])

    return run


def entry_states(summaries: DataFrame, partitions: int, limit: int) -> DataFrame:
    """``(p, row_offset, open, open_len, open_id)`` of every partition, from
    the summaries of ``partitions`` range partitions.

    No task holds more than :data:`FAN` summaries.  Levels of the tree are
    written to the shared folder, each a :data:`FAN`-th of the one below.
    """
    spark = summaries.sparkSession
    block = F.floor(F.col("p") / FAN).cast("long")
    levels = [summaries]
    while partitions > FAN:
        path = scratch_dir(spark, "packing")
        levels[-1].write.parquet(path)
        levels[-1] = spark.read.parquet(path)
        levels.append(levels[-1].groupBy(block.alias("b")).applyInPandas(_compose_block(limit), _SUMMARY))
        partitions = -(-partitions // FAN)
    offset, is_open, open_len, open_id = NO_ROWS
    state = {"row_offset": F.lit(offset), "open": F.lit(is_open), "open_len": F.lit(open_len), "open_id": F.lit(open_id)}
    entries = levels.pop().withColumns(state).groupBy(F.lit(0).alias("b")).applyInPandas(_enter_block(limit), _ENTRY)
    while levels:
        above = entries.withColumnRenamed("p", "b")
        entries = levels.pop().withColumn("b", block).join(above, "b").groupBy("b").applyInPandas(_enter_block(limit), _ENTRY)
    return entries


def _assign(limit: int, isolate: bool, plan, names: list[str]):
    """``plan`` is a broadcast of :func:`entry_states` by partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        offset = 0
        prev = -1
        for b in batches:
            if b.num_rows == 0:
                continue
            rid = b.column(RID).to_numpy(zero_copy_only=False)
            if state is None:
                offset, *entry = plan.value[int(rid[0]) >> ROW_BITS]
                state = tuple(entry)
            if rid[0] <= prev or np.any(np.diff(rid) <= 0):
                raise RuntimeError("rows left their range-partition order")
            prev = int(rid[-1])
            lengths = b.column(LEN).to_numpy(zero_copy_only=False).astype(np.int64)
            ids, state = assign_segment(lengths, limit, isolate, state)
            ords = offset + (rid & ROW_MASK)
            cols = [b.column(i) for i in range(b.num_columns)] + [pa.array(ords, pa.int64()), pa.array(ids, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return run


def pack_by_chars(
    df: DataFrame,
    order_by: Sequence[str | Column],
    length: str | Column,
    limit: int,
    isolate: bool = False,
    ord_name: str = "ord",
    chunk_name: str = "chunk_id",
    num_partitions: int | None = None,
    persist_input: bool = False,
) -> DataFrame:
    """Add ``ord`` and a 0-based chunk id packed by a character budget.

    ``length`` is the per-row size (e.g. ``char_length("text")``);
    ``isolate=False`` is append-or-flush (W3), ``True`` isolates rows of
    length >= ``limit`` (W4).  Rows are never cut.
    """
    if limit < 0:
        raise ValueError("limit must be >= 0")
    length_col = F.col(length) if isinstance(length, str) else length
    ranged = range_sorted(df.withColumn(LEN, length_col.cast("long")), order_by, num_partitions, persist_input)
    summaries = ranged.select(RID, LEN).mapInArrow(_summarize(limit, isolate), _SUMMARY)
    entries = entry_states(summaries, ranged.rdd.getNumPartitions(), limit)
    # four numbers per range partition, shipped once per executor
    plan = df.sparkSession.sparkContext.broadcast({r["p"]: tuple(r)[1:] for r in entries.collect()})
    out_struct = T.StructType(
        ranged.schema.fields + [T.StructField(ord_name, T.LongType()), T.StructField(chunk_name, T.LongType())]
    )
    packed = ranged.mapInArrow(_assign(limit, isolate, plan, out_struct.fieldNames()), out_struct)
    return packed.drop(RID, LEN)


def chunk_stats(df: DataFrame, chunk: str = "chunk_id", text: str = "text", length: str | None = None) -> DataFrame:
    """Rows and characters per chunk (A5); ``length`` names a precomputed
    length column (then the text need not be there)."""
    size = F.col(length) if length else char_length(text)
    return df.groupBy(chunk).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(size).cast("long").alias("n_chars"))
