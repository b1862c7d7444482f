"""Corpus curation: exact dedup (first kept), seeded shuffle, union."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trainprep.operators.ordinal import with_ordinal


def dedup_first(df: DataFrame, key: str | Sequence[str] = "text", ord_col: str = "ord", copies: str | None = None) -> DataFrame:
    """Exact dedup keeping the first row (smallest ``ord``) of each ``key``.

    One aggregate: ``min(struct(ord, ...))`` is computed partially on the
    map side, so a key repeated in a third of all rows is reduced to one
    row per task before the shuffle.  ``dropDuplicates`` would keep an
    arbitrary row instead of the first.  ``copies`` names an optional
    column with the number of input rows per key.  ``key`` may be several
    columns: where the texts themselves are not needed, a digest and a
    length keep them out of the shuffle.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in (*keys, ord_col)]
    count = [F.count(F.lit(1)).alias(copies)] if copies else []
    if not rest:
        # fixed-width buffer: stays a HashAggregate (no sort of the keys)
        return df.groupBy(*keys).agg(F.min(ord_col).alias(ord_col), *count)
    first = F.min(F.struct(F.col(ord_col), *[F.col(c) for c in rest])).alias("_first")
    out = [*keys, *[F.col(f"_first.{c}").alias(c) for c in (ord_col, *rest)]] + ([copies] if copies else [])
    return df.groupBy(*keys).agg(first, *count).select(*out)


def dedup_stats(deduped: DataFrame, copies: str = "copies") -> DataFrame:
    """``(n_in, n_out, n_removed)`` as one row, from ``dedup_first(..., copies=)``."""
    return deduped.agg(
        F.sum(copies).cast("long").alias("n_in"),
        F.count(F.lit(1)).alias("n_out"),
        (F.sum(copies) - F.count(F.lit(1))).cast("long").alias("n_removed"),
    )


def shuffle_key(text: str = "text", seed: int = 42):
    """Reproducible random order: ``md5(seed || ':' || text)``.

    Independent of partitioning and of the engine (DuckDB computes the same
    key); ties between equal texts are broken by the caller's ordinal.
    """
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(text)))


def seeded_shuffle(
    df: DataFrame,
    text: str = "text",
    ord_col: str = "ord",
    seed: int = 42,
    name: str = "pos",
    keep: Sequence[str] | None = None,
    key: str | None = None,
) -> DataFrame:
    """Full permutation by ``(shuffle_key, ord)``; ``name`` is the new position.
    ``key`` names a column that holds the shuffle key already.

    ``keep`` projects the columns to carry before the ordering, so the
    checkpoint behind the ordinal holds only them and the key.
    """
    keyed = df.withColumn("_shuffle_key", F.col(key) if key else shuffle_key(text, seed))
    if keep is not None:
        keyed = keyed.select(*dict.fromkeys([*keep, ord_col]), "_shuffle_key")
    return with_ordinal(keyed, [F.col("_shuffle_key"), F.col(ord_col)], name=name).drop("_shuffle_key")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenation by column name (``pd.concat(..., ignore_index=True)``)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
