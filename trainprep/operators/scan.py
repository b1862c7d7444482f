"""Early stopping as ordered scans over range partitions.

A window ``partitionBy(run).orderBy(...)`` puts a whole run in one task; a run
holding a third of all rows would then be one task.  Here rows lie in range
partitions of ``(run, order)``, so only a partition's first run can have begun
before it.  One pass reports where each partition's last run stands (a record
of fixed size per partition), which gives every partition its entry state;
a second pass reports each ``(run, partition)`` piece.  No row is shuffled
after the range exchange.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from trainprep.operators.ordinal import RID, ROW_BITS

#: (rows seen, lowest loss so far or None, first loss is no number)
FRESH = (0, None, False)


def _segments(batch: pa.RecordBatch) -> Iterator[tuple[object, pa.Array, np.ndarray]]:
    """``(run, orders, losses)`` of each stretch of one run in a batch."""
    runs, orders = batch.column(0), batch.column(1)
    losses = batch.column(2).to_numpy(zero_copy_only=False).astype(np.float64)
    codes = runs.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    cuts = [0, *(np.flatnonzero(codes[1:] != codes[:-1]) + 1).tolist(), len(codes)]
    for a, z in zip(cuts, cuts[1:]):
        yield runs[a].as_py(), orders.slice(a, z - a), losses[a:z]


def _advance(state, losses: np.ndarray):
    """State after more losses of one run."""
    seen, best, bad_first = state
    if seen == 0:
        bad_first = bool(np.isnan(losses[0]))
    known = losses[~np.isnan(losses)]
    if known.size:
        low = float(known.min())
        best = low if best is None else min(best, low)
    return seen + losses.size, best, bad_first


def _tails(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """One record per partition: its last run, and that run's state counted
    from the partition's start (``alone``: the partition has no other run)."""
    part, run, state, alone = None, None, FRESH, True
    for b in batches:
        if b.num_rows == 0:
            continue
        if part is None:
            part = b.column(3)[0].as_py() >> ROW_BITS
            run = b.column(0)[0].as_py()
        for r, _orders, losses in _segments(b):
            if r != run:
                run, state, alone = r, FRESH, False
            state = _advance(state, losses)
    if part is not None:
        row = dict(zip(schema.names, (part, run, alone, *state)))
        yield pa.RecordBatch.from_pylist([row], schema=schema)


def entry_states(tails: list) -> dict[int, tuple]:
    """``p -> (run, state)``: the run that may go on in partition ``p`` and its
    state there; a tuple of fixed size per partition."""
    out, run, state = {}, None, FRESH
    for p, last, alone, seen, best, bad_first in sorted(tails, key=lambda t: t[0]):
        out[p] = (run, state)
        if alone and last == run and state[0]:
            lows = [x for x in (state[1], best) if x is not None]
            state = (state[0] + seen, min(lows) if lows else None, state[2])
        else:
            run, state = last, (seen, best, bad_first)
    return out


def _improved(state, losses: np.ndarray, threshold: float) -> np.ndarray:
    """Which losses beat the lowest before them by more than ``threshold``.  No
    comparison with NaN holds: a NaN improves nothing, and nothing improves
    on a NaN that came first.  A run's first loss always counts."""
    seen, best, bad_first = state
    lows = np.fmin.accumulate(np.append(np.nan if best is None else best, losses))[:-1]
    bad = bad_first if seen else bool(np.isnan(losses[0]))
    out = np.zeros(losses.size, dtype=bool) if bad else lows - losses > threshold
    if seen == 0:
        out[0] = True
    return out


def _pieces(batches, entries, patience: int, threshold: float, schema: pa.Schema):
    """One record per (run, partition): rows, first row number, first and last
    improvement, the first stop after a local improvement, and the orders of
    the first ``patience`` rows (a stop before it falls among these)."""
    state, piece, run, entered = FRESH, None, None, False
    done = []
    for b in batches:
        if b.num_rows == 0:
            continue
        if not entered:
            run, state = entries.value[b.column(3)[0].as_py() >> ROW_BITS]
            entered = True
        for r, orders, losses in _segments(b):
            if piece is None or r != run:
                if piece is not None:
                    done.append(piece)
                if r != run:
                    state = FRESH
                run = r
                piece = dict.fromkeys(schema.names)
                piece.update(run=r, n=0, first=state[0] + 1, head=[])
            at = state[0] + 1 + np.arange(losses.size)
            hits = at[_improved(state, losses, threshold)]
            if piece["stop"] is None and (piece["last_imp"] is not None or hits.size):
                # distance of each row to the last improvement before or at it
                marks = hits if piece["last_imp"] is None else np.append(piece["last_imp"], hits)
                j = np.searchsorted(marks, at, side="right") - 1
                over = np.nonzero((j >= 0) & (at - marks[j] >= patience))[0]
                if over.size:
                    piece.update(stop=int(at[over[0]]), stop_order=orders[int(over[0])].as_py())
            if hits.size:
                piece["first_imp"] = int(hits[0]) if piece["first_imp"] is None else piece["first_imp"]
                piece["last_imp"] = int(hits[-1])
            piece["n"] += losses.size
            piece["head"] += orders.slice(0, max(0, patience - len(piece["head"]))).to_pylist()
            state = _advance(state, losses)
        if len(done) >= 1000:
            yield pa.RecordBatch.from_pylist(done, schema=schema)
            done = []
    if piece is not None:
        yield pa.RecordBatch.from_pylist([*done, piece], schema=schema)


def stop_points(ranged: DataFrame, run: str, order: str, loss: str, patience: int, threshold: float) -> DataFrame:
    """``(run, n, stop, stop_order)`` per run of a :func:`range_sorted` frame on
    ``(run, order)``: rows, and the row number and order value of the first
    row at which ``patience`` rows in a row did not improve."""
    key, by = ranged.schema[run].dataType, ranged.schema[order].dataType
    rows = ranged.select(F.col(run).alias("run"), order, F.col(loss).cast("double").alias("loss"), RID)
    tail = T.StructType().add("p", "long").add("last", key).add("alone", "boolean")
    tail = tail.add("seen", "long").add("best", "double").add("bad_first", "boolean")
    tail_arrow = to_arrow_schema(tail)
    tails = rows.mapInArrow(lambda bs: _tails(bs, tail_arrow), tail).collect()  # one row per range partition
    entries = ranged.sparkSession.sparkContext.broadcast(entry_states([tuple(t) for t in tails]))

    piece = T.StructType().add("run", key).add("n", "long").add("first", "long").add("first_imp", "long").add("last_imp", "long")
    piece = piece.add("stop", "long").add("stop_order", by).add("head", T.ArrayType(by))
    piece_arrow = to_arrow_schema(piece)
    pieces = rows.mapInArrow(lambda bs: _pieces(bs, entries, patience, threshold, piece_arrow), piece)

    # an improvement in an earlier piece can run out in a later one's head
    before = Window.partitionBy("run").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    due = F.last("last_imp", ignorenulls=True).over(before) + F.lit(patience)
    end = F.coalesce(F.col("first_imp"), F.col("first") + F.col("n"))
    carried = (F.col("due") >= F.col("first")) & (F.col("due") < end)
    at = F.struct(
        F.when(carried, F.col("due")).otherwise(F.col("stop")).alias("stop"),
        F.when(carried, F.try_element_at("head", (F.col("due") - F.col("first") + 1).cast("int"))).otherwise(F.col("stop_order")).alias("order"),
    )
    stops = pieces.withColumn("due", due).withColumn("at", F.when(carried | F.col("stop").isNotNull(), at))
    per_run = stops.groupBy("run").agg(F.sum("n").alias("n"), F.min("at").alias("at"))
    return per_run.select(F.col("run").alias(run), "n", F.col("at.stop").alias("stop"), F.col("at.order").alias("stop_order"))
