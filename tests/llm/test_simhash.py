from __future__ import annotations

import random

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from trainprep.llm import simhash
from trainprep.llm.queries import QUERIES


def brute_fp(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).replace("\x0b", " ")
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", words)
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else ([" ".join(words)] if words else [])
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps, ids, radius=2):
    parent = list(range(len(fps)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                parent[root(i)] = root(j)
    least = {}
    for i, d in enumerate(ids):
        r = root(i)
        least[r] = min(least.get(r, d), d)
    return [least[root(i)] for i in range(len(ids))]


def corpus(n=60, seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["É", "ÀB", "Mixed"]
    texts = []
    for _ in range(n):
        t = rng.choices(words, k=rng.choice([1, 2, 3, 50, 400]))
        texts.append(" ".join(t))
        for _ in range(rng.randrange(4)):
            u = list(t)
            u[rng.randrange(len(u))] = rng.choice(words)
            texts.append("  ".join(u) + "\n")
    return texts + ["", None, " \t", "a", "A", "x y z\x1fq"] + texts[:5]


def test_query_equals_brute_force(spark, make_docs, sf_dir):
    texts = corpus()
    rows = sorted(QUERIES["op10_simhash"](spark, sf_dir(documents=make_docs(texts, 100))).collect())
    fps = [brute_fp(t) for t in texts]
    assert [int(r.fingerprint, 16) for r in rows] == fps
    assert all(len(r.fingerprint) == 16 for r in rows)
    assert [r.component_id for r in rows] == brute_components(fps, range(100, 100 + len(texts)))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=30), st.integers(0, 4), st.integers(0, 2**64 - 1))
def test_bk_tree_finds_all_within_the_radius(values, radius, probe):
    tree = simhash.BKTree()
    near = [probe ^ (1 << (v % 64)) ^ (1 << (v % 7)) for v in values]
    for v in values + near:
        tree.add(v)
    assert sorted(tree.within(probe, radius)) == sorted({v for v in values + near if bin(v ^ probe).count("1") <= radius})


@pytest.mark.parametrize("tree_rows", [4, 10_000])
def test_chains_and_split_trees(spark, tree_rows):
    rng = random.Random(1)
    fps, now = [], 0
    for _ in range(40):  # a long chain: neighbours two bits apart
        now ^= (1 << rng.randrange(64)) | (1 << rng.randrange(64))
        fps.append(now)
    fps += [rng.getrandbits(64) for _ in range(40)] + [0, 1, 3, (1 << 64) - 1]
    fps = sorted(set(fps))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    roots = {r.node: r.root for r in simhash.components(simhash.near_links(df, 2, tree_rows)).collect()}
    got = [roots.get(f, f) for f in signed]
    want = brute_components(fps, list(range(len(fps))))
    assert all((got[i] == got[j]) == (want[i] == want[j]) for i in range(len(fps)) for j in range(i))


def test_many_fingerprints_on_one_value(spark):
    """200 fingerprints that agree on all but 12 bits: many trees on one value,
    no link between two of them lost."""
    rng = random.Random(5)
    fps = sorted(rng.sample(range(1 << 12), 200))
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    want = brute_components(fps, list(range(len(fps))))
    for tree_rows in (7, 64):
        roots = {r.node: r.root for r in simhash.components(simhash.near_links(df, 2, tree_rows)).collect()}
        got = [roots.get(f, f) for f in fps]
        assert all((got[i] == got[j]) == (want[i] == want[j]) for i in range(len(fps)) for j in range(i))


def test_empty_nulls_and_repeats(spark, sf_dir):
    docs = spark.createDataFrame([(None, "a b c d"), (5, "a b c d"), (5, "a b c d"), (None, "zz yy xx ww vv"), (9, None)], "doc_id long, text string")
    rows = QUERIES["op10_simhash"](spark, sf_dir(documents=docs)).collect()
    assert len(rows) == 5
    assert sum(r.component_id == 5 for r in rows) == 3
    assert [r.component_id for r in rows if r.doc_id == 9] == [9]
    assert QUERIES["op10_simhash"](spark, sf_dir(documents=docs.limit(0))).collect() == []
