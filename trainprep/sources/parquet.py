"""Parquet text sources."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _files_missing(column: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.parquet as pq
        from pyarrow import fs

        for pdf in batches:
            missing = []
            for path in pdf["path"]:
                filesystem, inner = fs.FileSystem.from_uri(path)
                with filesystem.open_input_file(inner) as f:
                    if column not in pq.read_schema(f).names:
                        missing.append(path)
            yield pd.DataFrame({"path": missing}, dtype=object)

    return run


def file_rows(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``(path, rows)`` of every parquet file that has rows.  No column is
    read: the scan takes the counts of the row groups from the footers."""
    return spark.read.parquet(*paths).groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("rows"))


def require_column(spark: SparkSession, paths: Sequence[str], column: str) -> None:
    """Fail when any parquet file that has rows lacks ``column``.  Listing and
    footers are the tasks' work; the driver gets a count and one path."""
    listing = file_rows(spark, paths).select("path")
    bad = listing.mapInPandas(_files_missing(column), "path string").agg(F.count("*").alias("n"), F.min("path").alias("path")).first()
    if bad.n:
        raise ValueError(f"{bad.n} files without required column {column!r}, the first {bad.path}")


def plain_path(path: str | Column) -> Column:
    """A metadata path as the file system names it, for ordering by name."""
    c = F.col(path) if isinstance(path, str) else path
    return F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)


def numbered_scan(spark: SparkSession, paths: Sequence[str], columns: Sequence[str] = ("text",), name: str = "ord", check: bool = True) -> DataFrame:
    """All rows in (file name, row) order with their 0-based position in it
    (S4 with W1): ``name`` and ``columns``.

    A row's place in its file is known to the reader, and the rows of the
    files before it are a prefix sum over footer counts; so nothing is
    sorted, shuffled or written, and the rows stay in the tasks that read
    them.  The sums, one row per file, go to the tasks as a broadcast: at
    128 MB a file, 100 TB are 800,000 rows.
    """
    if check:
        for column in columns:
            require_column(spark, paths, column)
    path = F.col("_metadata.file_path")
    rows = spark.read.parquet(*paths).select(*columns, path.alias("_path"), F.col("_metadata.row_index").alias("_row"))
    before = Window.orderBy(plain_path("path")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = file_rows(spark, paths).select(F.col("path").alias("_path"), F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("_before"))
    return rows.join(F.broadcast(offsets), "_path").select((F.col("_before") + F.col("_row")).cast("long").alias(name), *columns)


def corpus_scan(spark: SparkSession, paths: Sequence[str], column: str = "text", check: bool = True) -> DataFrame:
    """All parquet files under ``paths``, only ``column`` (S4).  Every file
    must carry the column; only that column is read from storage."""
    if check:
        require_column(spark, paths, column)
    return spark.read.parquet(*paths).select(column)
