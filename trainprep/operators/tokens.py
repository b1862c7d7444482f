"""Token tables: frequency (A2), distinct count (A3), length distribution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trainprep.functions.tokenizers import readable_token, tokenize


def text_column(df: DataFrame, column: str = "text", require_rows: bool = False) -> DataFrame:
    """The named column as string, nulls dropped (``IsNotNull`` reaches the scan).

    ``require_rows`` fails when no text is left at all (one cheap probe for
    a first row); an input that is empty only in some files is fine.
    """
    if column not in df.columns:
        raise ValueError(f"column {column!r} not found")
    out = df.where(F.col(column).isNotNull()).select(F.col(column).cast("string").alias("text"))
    if require_rows and out.isEmpty():
        raise ValueError("no text in the input")
    return out


def token_frequency(df: DataFrame, text: str = "text", tokenizer: str = "word") -> DataFrame:
    """``(token, text, count)``: occurrences of every token.

    explode + ``groupBy(token).count()``: Spark counts partially inside each
    task (the per-worker Counter) and merges after one shuffle on the
    token, so a token that is a third of all tokens is already collapsed
    to one row per task.  The readable form is computed once per distinct
    token, after the aggregate.
    """
    toks = df.select(F.explode(tokenize(text, tokenizer)).alias("token"))
    counts = toks.groupBy("token").agg(F.count(F.lit(1)).alias("count"))
    return counts.select("token", readable_token("token", tokenizer).alias("text"), "count")


def distinct_tokens(df: DataFrame, text: str = "text", tokenizer: str = "word", approx_rsd: float | None = None) -> DataFrame:
    """One row: the number of distinct tokens; exact by default, or a
    HyperLogLog++ estimate with relative error ``approx_rsd`` (no shuffle of
    the tokens, fixed-size sketches merged)."""
    toks = df.select(F.explode(tokenize(text, tokenizer)).alias("token"))
    if approx_rsd is not None:
        return toks.agg(F.approx_count_distinct("token", approx_rsd).alias("n_distinct_tokens"))
    return toks.agg(F.count_distinct("token").alias("n_distinct_tokens"))


def token_length_distribution(
    df: DataFrame,
    text: str = "text",
    tokenizer: str = "word",
    percentiles: Sequence[float] = (0.5, 0.9, 0.99),
) -> DataFrame:
    """Tokens per row, then count / min / mean / percentiles / max, one row.

    ``percentile`` is exact; its buffer holds one counter per *distinct*
    token length, which the longest text bounds, not the row count.
    """
    lens = df.select(F.size(tokenize(text, tokenizer)).cast("long").alias("n_tokens"))
    aggs = [
        F.count(F.lit(1)).alias("n_rows"),
        F.min("n_tokens").alias("min_tokens"),
        F.avg("n_tokens").alias("mean_tokens"),
        F.max("n_tokens").alias("max_tokens"),
        F.sum("n_tokens").cast("long").alias("total_tokens"),
    ]
    aggs += [F.percentile("n_tokens", p).alias(f"p{int(round(p * 100))}_tokens") for p in percentiles]
    return lens.agg(*aggs)
