"""Tokenizers as column functions.

Native tokenizers are regular expressions evaluated JVM-side; the patterns
are written so Java regex and RE2 (the SQL oracle) agree.  A pretrained
``tokenizer.json`` is loaded from a path inside each Python worker, once
per task, by an iterator pandas UDF -- the tokenizer object is never
pickled from the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Native tokenizer patterns (one token per match).
NATIVE_PATTERNS = {
    "word": r"[\p{L}\p{N}]+",
    "whitespace": r"[^ \t\n\r\f]+",
    "char": r"(?s).",
}


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def native_tokens(text: str | Column, kind: str = "word") -> Column:
    """``array<string>`` of tokens for a native tokenizer."""
    if kind not in NATIVE_PATTERNS:
        raise ValueError(f"unknown native tokenizer {kind!r}; choose from {sorted(NATIVE_PATTERNS)}")
    return F.regexp_extract_all(_col(text), F.lit(NATIVE_PATTERNS[kind]), 0)


def _load(path: str):
    from tokenizers import Tokenizer  # gated: only needed for pretrained tokenizers

    return Tokenizer.from_file(path)


def pretrained_tokens_udf(tokenizer_path: str):
    """Iterator pandas UDF: text -> token strings (no ids), tokenizer loaded per task."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tok = _load(tokenizer_path)
        for texts in batches:
            present = [t for t in texts if t is not None]
            encoded = iter(tok.encode_batch(present, add_special_tokens=False)) if present else iter(())
            yield pd.Series([None if t is None else next(encoded).tokens for t in texts], dtype=object)

    return tokens


def pretrained_readable_udf(tokenizer_path: str):
    """Iterator pandas UDF: token -> readable text (the decoder on one token),
    lossy UTF-8 so lone surrogates become U+FFFD."""

    @F.pandas_udf(T.StringType())
    def readable(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tok = _load(tokenizer_path)
        dec = tok.decoder
        for toks in batches:
            vals = [dec.decode([t]) if dec is not None else t for t in toks]
            yield pd.Series([v.encode("utf-8", errors="replace").decode("utf-8") for v in vals])

    return readable


def tokenize(text: str | Column, tokenizer: str = "word") -> Column:
    """Token strings for ``tokenizer``: a native name or a ``tokenizer.json`` path."""
    if tokenizer in NATIVE_PATTERNS:
        return native_tokens(text, tokenizer)
    return pretrained_tokens_udf(tokenizer)(_col(text))


def readable_token(token: str | Column, tokenizer: str = "word") -> Column:
    """Readable text of a token: identity for native tokenizers."""
    if tokenizer in NATIVE_PATTERNS:
        return _col(token)
    return pretrained_readable_udf(tokenizer)(_col(token))
