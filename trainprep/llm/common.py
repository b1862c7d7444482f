"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trainprep.session import scratch_dir


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def id_crc(column: str = "doc_id") -> Column:
    """Unsigned crc32 of the id written as text."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def fold_is(modulus: int, remainder: int, column: str = "doc_id") -> Column:
    """True where ``crc32(id as text) mod modulus = remainder``; a null id is false."""
    return F.coalesce(id_crc(column) % modulus == remainder, F.lit(False))


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back.  Later jobs read
    the committed files, so a lost executor never recomputes ``df``."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(df: DataFrame, text: str = "text") -> int:
    """UTF-8 bytes of all texts; sizes blocks and tiles to the data."""
    return int(df.agg(F.sum(F.octet_length(text))).first()[0] or 0)


def parts_for(total: int, per_part: int) -> int:
    return max(1, -(-total // per_part))


def sliced(batches: Iterator[pa.RecordBatch], column: int, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds at most ``max_bytes`` of the string
    column (one longer text makes a batch alone)."""
    import numpy as np

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        ends = np.cumsum(byte_lengths(batch.column(column)))
        at = 0
        while at < n:
            base = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
            yield batch.slice(at, stop - at)
            at = stop


def byte_lengths(texts: pa.Array):
    import numpy as np
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
