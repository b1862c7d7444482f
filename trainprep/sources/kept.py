"""Mapped datasets kept on disk (S10 with P2).

Loading a dataset through a mapper writes the mapped rows once, under a name
that is a digest of what they were made from: the input files (path, length,
time of change), the format, and the mapper's code and arguments.  A later load
of the same reads the written rows and runs no mapper; a changed file or
mapper makes another name, so stale rows are never read.
"""

from __future__ import annotations

import hashlib
import marshal
import types
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trainprep.operators.chat import apply_mapper
from trainprep.session import ensure_checkpoint_dir
from trainprep.sources.files import load_dataset


def input_state(spark: SparkSession, path: str) -> str:
    """Digest of the files under ``path``: their number, and sums over
    hashes of (path, length, time of change), so that no list of files is
    gathered anywhere."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length", "modificationTime")
    sums = [F.sum(F.xxhash64(F.lit(salt), "path", "length", F.unix_micros("modificationTime")).cast("decimal(38,0)")) for salt in (1, 2)]
    return str(tuple(files.agg(F.count(F.lit(1)), F.sum("length"), *sums).first()))


def _code_state(value) -> bytes:
    """What decides a mapper's results: its code, constants and arguments."""
    if isinstance(value, types.CodeType):
        inner = b"".join(_code_state(c) for c in value.co_consts)
        return value.co_code + inner + repr((value.co_names, value.co_varnames, value.co_freevars)).encode()
    if isinstance(value, types.FunctionType):
        cells = b"".join(_code_state(c.cell_contents) for c in value.__closure__ or ())
        return _code_state(value.__code__) + _code_state(value.__defaults__) + cells
    if isinstance(value, types.MethodType):
        return _code_state(value.__func__)
    try:
        return marshal.dumps(value)
    except ValueError:
        return repr(value).encode()


def load_mapped(
    spark: SparkSession,
    path: str,
    mapper: Callable[..., DataFrame] | None = None,
    load_from_cache: bool = False,
    cache_dir: str | None = None,
    fmt: str | None = None,
    schema=None,
    **mapper_args,
) -> DataFrame:
    """The dataset at ``path``, mapped and kept under ``cache_dir`` (by
    default beside the checkpoints).  ``mapper(df, **mapper_args)`` returns
    the mapped frame, without the source columns it drops.  With
    ``load_from_cache`` rows written before from the same files by the same
    mapper are read; without it they are written anew."""
    key = hashlib.sha256(repr((path, fmt, str(schema), input_state(spark, path))).encode())
    for part in (mapper, sorted(mapper_args.items())):
        key.update(_code_state(part))
    base = (cache_dir or f"{ensure_checkpoint_dir(spark).rstrip('/')}/mapped").rstrip("/")
    target = f"{base}/{key.hexdigest()[:32]}"
    if not (load_from_cache and _complete(spark, target)):
        df = load_dataset(spark, path, fmt, schema)
        (apply_mapper(df, mapper, **mapper_args) if mapper else df).write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def _complete(spark: SparkSession, target: str) -> bool:
    """Spark's committer marks a finished write."""
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{target}/_SUCCESS")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)
