"""Sinks (K1-K6).

Chunk and shard sinks are partitioned parquet writes: the chunk number is
the partition value (``chunk=chunk_000000``, ``shard=part_0001``), gzip,
rows of a chunk sorted by their ordinal.  One-file-per-row sinks (session
JSON, converted exports, text-file folders) are written by the executors
through ``pyarrow.fs`` into a staging folder and moved onto their names when
all of them are there.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trainprep.functions.text import zero_pad
from trainprep.session import scratch_dir


def chunk_name(chunk_id: str | Column, prefix: str = "chunk", width: int = 6, base: int = 0) -> Column:
    """``chunk_000000`` (0-based, six digits) or ``part_0001`` (base 1, four)."""
    c = F.col(chunk_id) if isinstance(chunk_id, str) else chunk_id
    return F.concat(F.lit(f"{prefix}_"), zero_pad(c + F.lit(base), width))


def write_chunks(
    df: DataFrame,
    path: str,
    chunk_col: str,
    order_col: str,
    columns: list[str],
    partition_name: str = "chunk",
    prefix: str = "chunk",
    width: int = 6,
    base: int = 0,
    mode: str = "overwrite",
    range_ordered: bool = False,
    layout: str = "folders",
) -> None:
    """Numbered chunk sink (K1) / shard sink (K2), gzip parquet.

    ``layout="folders"``: one folder per chunk (``chunk=chunk_000000``), as
    the reference has one file per chunk.  A chunk is bounded by its
    packing limit, so clustering each chunk into one task is safe; rows
    keep their order inside the chunk.  With ``range_ordered=True`` (the
    output of ``pack_by_chars``: partitions are consecutive ranges of the
    order) no shuffle is needed: a chunk that straddles two partitions gets
    two files, named in partition order.

    ``layout="sorted"``: the chunk name stays a column and every file holds
    a contiguous run of chunks sorted by ``(chunk, order)``; readers select
    a chunk by row-group statistics.  Use it when chunks are many (millions
    of folders are a burden for any file system).
    """
    if layout not in ("folders", "sorted"):
        raise ValueError("layout must be 'folders' or 'sorted'")
    named = df.withColumn(partition_name, chunk_name(chunk_col, prefix, width, base))
    if layout == "sorted":
        ordered = named if range_ordered else named.repartitionByRange(F.col(chunk_col), F.col(order_col))
        (
            ordered.sortWithinPartitions(chunk_col, order_col)
            .select(partition_name, *columns)
            .write.mode(mode)
            .option("compression", "gzip")
            .parquet(path)
        )
        return
    clustered = named if range_ordered else named.repartition(partition_name)
    (
        clustered.sortWithinPartitions(partition_name, order_col)
        .select(*columns, partition_name)
        .write.mode(mode)
        .partitionBy(partition_name)
        .option("compression", "gzip")
        .parquet(path)
    )


def _stage(staging: str, binary: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from pyspark import TaskContext

        ctx = TaskContext.get()
        # a folder for each attempt: tasks that make files in one folder wait for each other
        attempt = f"{ctx.partitionId()}-{ctx.taskAttemptId()}"
        filesystem, root = fs.FileSystem.from_uri(staging)
        filesystem.create_dir(f"{root}/{attempt}", recursive=True)
        at = 0
        for batch in batches:
            names, contents = batch.column(0), batch.column(1)
            if not binary:
                contents.validate(full=True)  # UTF-8
            staged, sizes = [], []
            # written from the batch's own memory: texts are not copied into Python
            for name, content in zip(names.to_pylist(), contents):
                data = content.as_buffer()
                if name is None or data is None:
                    raise ValueError(f"no content for {name}")
                staged.append(f"{attempt}/{at}")
                at += 1
                with filesystem.open_output_stream(f"{root}/{staged[-1]}") as out:
                    out.write(data)
                sizes.append(data.size)
            yield pa.RecordBatch.from_arrays([names, pa.array(staged, pa.string()), pa.array(sizes, pa.int64())], names=["name", "staged", "bytes"])
            batch = names = contents = content = data = None  # let go of before the next one comes

    return run


def _publish(staging: str, folder: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        filesystem, source = fs.FileSystem.from_uri(staging)
        _, root = fs.FileSystem.from_uri(folder)
        for pdf in batches:
            for staged, name in zip(pdf["staged"], pdf["name"]):
                # a repeated attempt finds what the one before has moved
                if filesystem.get_file_info(f"{source}/{staged}").type == fs.FileType.File:
                    filesystem.move(f"{source}/{staged}", f"{root}/{name}")
            yield pdf[["name", "bytes"]]

    return run


def write_files(df: DataFrame, folder: str, name: str = "name", content: str = "content", binary: bool = False) -> DataFrame:
    """Write each row's ``content`` to ``folder/<name>``; returns the totals
    ``(files, bytes)`` as one row.

    A job of two steps.  Tasks write into a hidden staging folder, and Spark
    commits the list of what the successful attempts wrote; then that list is
    checked, and tasks move its files onto their names.  Rows that share a
    name, and null contents, are errors found before any name is touched: a
    failing job leaves the folder as it was, and retried or speculative
    attempts leave nothing behind.
    """
    from pyarrow import fs

    spark = df.sparkSession
    folder = folder.rstrip("/")
    staging = f"{folder}/.staging-{uuid.uuid4().hex[:12]}"
    written = scratch_dir(spark, "written")
    rows = df.select(F.col(name).alias("name"), F.col(content).alias("content"))
    try:
        rows.mapInArrow(_stage(staging, binary), "name string, staged string, bytes long").write.parquet(written)
        listed = spark.read.schema("name string, staged string, bytes long").parquet(written)
        said = F.concat(F.lit("several rows share a file name: "), F.min("name"))
        twice = listed.groupBy("name").count().where("count > 1").agg(F.when(F.count(F.lit(1)) > 0, F.raise_error(said)))
        twice.collect()
        done = listed.mapInPandas(_publish(staging, folder), "name string, bytes long")
        totals = done.agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes")).first()
    finally:
        filesystem, root = fs.FileSystem.from_uri(staging)
        if filesystem.get_file_info(root).type == fs.FileType.Directory:
            filesystem.delete_dir(root)
    return spark.createDataFrame([tuple(totals)], "files long, bytes long")


def write_json_documents(df: DataFrame, folder: str, name: str, document: str | Column) -> DataFrame:
    """Session JSON (K4) / converted export (K5): one JSON text per file."""
    doc = F.col(document) if isinstance(document, str) else document
    return write_files(df.select(F.col(name).alias("name"), doc.alias("content")), folder)


def write_log_table(df: DataFrame, path: str, columns: list[str], fmt: str = "csv") -> None:
    """Log table sink (K6): fixed column order, one file per task, each CSV
    file with the header; an empty result still writes its header (CSV) or
    schema (parquet), as Spark's first task always writes a file."""
    writer = df.select(*columns).write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", "true").csv(path)
    else:
        writer.parquet(path)
