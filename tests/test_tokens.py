"""Tokenizers and token tables."""

import re
from collections import Counter

import numpy as np

from trainprep.operators.tokens import distinct_tokens, text_column, token_frequency, token_length_distribution

TEXTS = ["Hello, wörld! 42 times", "hello\tworld\nagain", "日本語 テキスト", ""]


def test_word_frequency_matches_counter(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    want = Counter(tok for t in TEXTS for tok in re.findall(r"[^\W_]+", t))
    got = {r.token: r["count"] for r in token_frequency(df).collect()}
    assert got == dict(want)
    assert distinct_tokens(df).first().n_distinct_tokens == len(want)


def test_whitespace_and_char(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    ws = {r.token: r["count"] for r in token_frequency(df, tokenizer="whitespace").collect()}
    assert ws == dict(Counter(tok for t in TEXTS for tok in t.split()))
    ch = {r.token: r["count"] for r in token_frequency(df, tokenizer="char").collect()}
    assert ch == dict(Counter(c for t in TEXTS for c in t))


def test_length_distribution(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    r = token_length_distribution(df).first()
    lens = [len(re.findall(r"[^\W_]+", t)) for t in TEXTS]
    assert (r.n_rows, r.min_tokens, r.max_tokens, r.total_tokens) == (4, min(lens), max(lens), sum(lens))
    assert r.p50_tokens == float(np.percentile(lens, 50))


def test_text_column_drops_nulls(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "v long")
    assert [r.text for r in text_column(df, "v").collect()] == ["1", "3"]


def test_pretrained_tokenizer(spark, tmp_folder):
    from tokenizers import Tokenizer, models, pre_tokenizers, trainers

    tok = Tokenizer(models.WordLevel(unk_token="[UNK]"))
    tok.pre_tokenizer = pre_tokenizers.Whitespace()
    tok.train_from_iterator(["hello world", "hello again"], trainers.WordLevelTrainer(special_tokens=["[UNK]"]))
    path = tmp_folder.replace("file:", "") + "/tok.json"
    import os

    os.makedirs(os.path.dirname(path), exist_ok=True)
    tok.save(path)
    df = spark.createDataFrame([("hello world hello",), ("again unknownword",)], "text string")
    got = {r.token: (r.text, r["count"]) for r in token_frequency(df, tokenizer=path).collect()}
    assert got["hello"][1] == 2 and got["world"][1] == 1 and got["[UNK]"][1] == 1


def test_empty_input_fails_only_when_wholly_empty(spark):
    import pytest

    empty = spark.createDataFrame([(None,), (None,)], "text string")
    with pytest.raises(ValueError):
        text_column(empty, "text", require_rows=True)
    mixed = spark.createDataFrame([(None,), ("a",)], "text string")
    assert text_column(mixed, "text", require_rows=True).count() == 1


def test_approximate_distinct_is_close(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    exact = distinct_tokens(df).first().n_distinct_tokens
    approx = distinct_tokens(df, approx_rsd=0.02).first().n_distinct_tokens
    assert abs(approx - exact) <= 0.06 * exact
