from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from trainprep.llm import byte_bpe, token_files
from trainprep.llm.pretokens import pretokens
from trainprep.llm.queries import QUERIES, vocabulary_path

P = pytest.importorskip("public_tokenizers")
HARD = ["", None, " ", "  a", "a  ", "don't we'll 's '' 're'llx", "a\n\n b\t c", "I'M i'm\n's", "é ü 漢字 12½ ٣", " x y \x1cz\x85", "x" * 5000,
        "<|endoftext|> hi", "a <|endoftext|> b<|endoftext|><|endoftext|>", " <|", "endoftext|> <|endoftext |>", "' s ''s 've", "\U0001f600\U0001f601 a", "the the the", "the the the", " 's", "a's's", "\r\n \r\n x"]


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.read_ranks(vocabulary_path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def library(ranks):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def bpe(ranks):
    return byte_bpe.ByteBPE(ranks)


def _tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("aB é漢'srtvelmd \n\t  \x1c\x85.1½—😀\r"), max_size=24), max_size=6))
def test_pretokens_are_the_matches_of_the_pattern(texts):
    import regex

    pattern = regex.compile(P.PATTERN.replace(r"\s", r"\p{White_Space}").replace(r"(?!\S)", r"(?=\p{White_Space}|\Z)").replace(r"[^\p{White_Space}", r"[^\p{White_Space}"))
    pieces, first = pretokens(pa.array(texts, pa.string()))
    got = [p.decode() for p in pieces.to_pylist()]
    for i, t in enumerate(texts):
        assert got[first[i] : first[i + 1]] == pattern.findall(t)


def test_ids_equal_the_library_for_every_code_point(bpe, library):
    points = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{c}b {c}1{c} " for c in points[at : at + 400]) for at in range(0, len(points), 400)]
    ids, offsets = bpe.encode_column(pa.array(texts, pa.string()))
    bad = [i for i, t in enumerate(texts) if library.encode_ordinary(t) != ids[offsets[i] : offsets[i + 1]].tolist()]
    assert not bad


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_ids_equal_the_library(bpe, library, text):
    ids, _ = bpe.encode_column(pa.array([text], pa.string()))
    assert ids.tolist() == library.encode_ordinary(text)


def test_perfect_hash_is_minimal(ranks):
    table = byte_bpe.PerfectHash(sorted(ranks)[:5000])
    assert sorted(table.slots(sorted(ranks)[:5000])) == list(range(5000))
    assert table.slots([b"no such piece here"]) == [-1]
    assert byte_bpe.PerfectHash([]).slots([b"a"]) == [-1]


def test_query_round_trip(spark, make_docs, sf_dir, library):
    docs = make_docs([*HARD, "ab " * 40_000])
    got = QUERIES["op3_byte_bpe"](spark, sf_dir(documents=docs.unionByName(docs.limit(3)))).collect()
    assert len(got) == len(HARD) + 4
    want = {}
    for r in docs.collect():
        ids = library.encode_ordinary(r.text or "")
        body = (r.text or "").encode()
        want[r.doc_id] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(body).hexdigest())
    assert all((r.n_tokens, r.ids_sha256, r.decoded_sha256) == want[r.doc_id] for r in got)


def test_decode_from_ids_alone(spark, make_docs, ranks):
    docs = make_docs(HARD)
    back = byte_bpe.decode(byte_bpe.encode(docs, ranks, extra=["text"]), ranks)
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in back.collect())


def test_decode_refuses_unknown_ids(bpe):
    with pytest.raises(ValueError):
        bpe.decode_column(np.array([10**6], np.uint32), np.array([0, 1]))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=70))
def test_pack_and_unpack(values):
    v = np.array(values, np.uint32)
    control, data = token_files.pack(v)
    assert token_files.unpack(control, data, len(v)).tolist() == values
    assert len(control) == -(-len(values) // 4)


def test_file_query_equals_the_library(spark, make_docs, sf_dir):
    rng = random.Random(5)
    texts = [*HARD, *(" ".join(rng.choices(["alpha", "beta", "Γάμμα", "12", "x'll"], k=rng.randrange(60))) for _ in range(60)), "ab " * 500_000]
    docs = make_docs(texts).orderBy("text")
    got = sorted(QUERIES["op8_token_files"](spark, sf_dir(documents=docs)).collect())
    library, at = _tokenizer(), 0
    assert len(got) == len(texts)
    for r, text in zip(got, texts):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_file_query_null_ids_repeats_and_empty(spark, make_docs, sf_dir):
    docs = spark.createDataFrame([(None, "b"), (7, "a"), (7, "a"), (7, "c d"), (None, None)], "doc_id long, text string")
    rows = QUERIES["op8_token_files"](spark, sf_dir(documents=docs)).collect()
    assert sorted((r.start, r.doc_id is None) for r in rows)[:2] == [(0, True), (1, True)]
    assert sum(r.n_tokens for r in rows) == max(r.start + r.n_tokens for r in rows)
    assert QUERIES["op8_token_files"](spark, sf_dir(documents=docs.limit(0))).collect() == []
    assert QUERIES["op3_byte_bpe"](spark, sf_dir(documents=docs.limit(0))).collect() == []


def test_added_tokens_are_cut_out_first(spark, make_docs, sf_dir):
    """Also in the midst of texts whose pre-tokens are known already."""
    texts = [f"x{'y' * i} a <|endoftext|> b <|endoftext" + "|>" * (i % 2) for i in range(40)] + ["a b", " <|endo", "text|>"]
    got = sorted(QUERIES["op8_token_files"](spark, sf_dir(documents=make_docs(texts))).collect())
    library = _tokenizer()
    assert library.encode("a <|endoftext|> b", add_special_tokens=False).ids.count(50256) == 1
    for r, text in zip(got, texts):
        ids = library.encode(text, add_special_tokens=False).ids + [2]
        assert (r.n_tokens, r.ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))


def test_frequent_ids_take_one_byte(spark, make_docs):
    with open(vocabulary_path("byte_bpe_50k.json"), encoding="utf-8") as f:
        path = token_files.write(make_docs(["the the the cat", "the"]), f.read(), end_id=2)
    files = spark.read.parquet(f"{path}/chunks").collect()
    # one byte each, filled up to whole control bytes
    assert all(len(r["data"]) == -(-r["n_ids"] // 4) * 4 for r in files)
    # nothing but the files is needed to read them
    assert token_files.read(spark.newSession(), path).count() == 2
