"""Global ordinal (W1): each row's position in a total order, no gaps.

Plan: one range exchange on the order keys, a sort inside each range
partition, ``monotonically_increasing_id`` (partition id in the upper 31
bits, row number inside the partition in the lower 33), a reliable
``checkpoint()`` into ``spark.checkpoint.dir`` so every later pass sees
exactly the same partitions (and survives lost executors), then per-
partition counts turned into offsets.  The offsets table has one row per
range partition -- a bound we choose -- so broadcasting it is safe.  Never
an un-partitioned ``row_number()``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trainprep.session import ensure_checkpoint_dir

ROW_BITS = 33
ROW_MASK = (1 << ROW_BITS) - 1
RID = "_rid"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def range_sorted(
    df: DataFrame,
    order_by: Sequence[str | Column],
    num_partitions: int | None = None,
    persist_input: bool = False,
) -> DataFrame:
    """Range-partition and sort by ``order_by``; add ``_rid``; checkpoint.

    ``order_by`` must be a total order (append a unique tie-breaker).  The
    range exchange first samples its whole input in a separate job; with
    ``persist_input`` a narrow but costly input (keys and lengths computed
    from a file scan) is kept for that second read instead of recomputed.
    """
    ensure_checkpoint_dir(df.sparkSession)
    if persist_input:
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            return range_sorted(df, order_by, num_partitions)
        finally:
            df.unpersist()
    keys = [_col(c) for c in order_by]
    # Without an explicit count, AQE sizes the range partitions from the
    # measured data; it only merges neighbouring ranges, so order is kept.
    ranged = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    ranged = ranged.sortWithinPartitions(*keys).withColumn(RID, F.monotonically_increasing_id())
    return ranged.checkpoint(eager=True)


def partition_of(rid: str | Column = RID) -> Column:
    return F.shiftrightunsigned(_col(rid), ROW_BITS)


def row_in_partition(rid: str | Column = RID) -> Column:
    return _col(rid).bitwiseAND(F.lit(ROW_MASK))


def partition_offsets(ranged: DataFrame) -> DataFrame:
    """``(_p, _offset, _total)``: rows in all earlier partitions, and in all.
    One row per partition."""
    counts = ranged.groupBy(partition_of().alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("_n").over(Window.partitionBy()).alias("_total")
    return counts.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).cast("long").alias("_offset"), total)


def with_ordinal(
    df: DataFrame,
    order_by: Sequence[str | Column],
    name: str = "ord",
    num_partitions: int | None = None,
    persist_input: bool = False,
    total: str | None = None,
) -> DataFrame:
    """Add ``name`` = 0-based position of the row in ``order_by`` order, and
    ``total`` (if named) = the number of rows, known from the same offsets."""
    ranged = range_sorted(df, order_by, num_partitions, persist_input)
    offsets = partition_offsets(ranged)
    joined = ranged.withColumn("_p", partition_of()).join(F.broadcast(offsets), "_p")
    if total:
        joined = joined.withColumn(total, F.col("_total"))
    return joined.withColumn(name, F.col("_offset") + row_in_partition()).drop("_p", "_offset", "_total", RID)


def chunk_by_count(df: DataFrame, ord_col: str, files_per_chunk: int, name: str = "chunk_id") -> DataFrame:
    """Fixed-count chunking (W2): ``files_per_chunk`` rows per chunk, last partial."""
    if files_per_chunk < 1:
        raise ValueError("files_per_chunk must be >= 1")
    return df.withColumn(name, F.floor(F.col(ord_col) / F.lit(files_per_chunk)).cast("long"))


def ordered_split(df: DataFrame, ord_col: str, test_size: float = 0.1, n: int | str | None = None, name: str = "split") -> DataFrame:
    """Ordered train/test split (W5): the last ``ceil(test_size * n)`` rows are
    ``test``, the rest ``train``; no shuffle, no sort once ``ord`` exists.

    ``n`` is the row count, or the name of a column that holds it (as
    :func:`with_ordinal` adds it; the column is dropped).  It is counted
    when not given.
    """
    if not 0 < test_size < 1:
        raise ValueError("test_size must be in (0, 1)")
    if n is None:
        n = df.count()
    if isinstance(n, str):
        n_train = F.col(n) - F.ceil(F.lit(float(test_size)) * F.col(n))
    else:
        n_train = F.lit(n - math.ceil(float(test_size) * n))
    split = df.withColumn(name, F.when(F.col(ord_col) < n_train, "train").otherwise("test"))
    return split.drop(n) if isinstance(n, str) else split
