from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trainprep.llm import decontaminate, exact_topk, sharding
from trainprep.llm.queries import ORACLES, QUERIES

VEC = "vec_id long, embedding array<float>, label int, row string"


def brute_topk(rows, k, query):
    ok = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (q, x) in enumerate(ok):
        if query(q):
            near = sorted((-sum(m * n for m, n in zip(x, y)), c) for b, (c, y) in enumerate(ok) if a != b and len(x) == len(y))
            out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(near[:k])]
    return sorted(out)


def vectors(n=400, seed=2):
    rng = random.Random(seed)
    rows = [(i, [rng.choice([0.0, 0.25, -0.5, rng.uniform(-1, 1)]) for _ in range(8)]) for i in range(n)]
    rows += [(n + i, rows[i][1]) for i in range(60)]  # ties
    rows += [(50, [1.0] * 8), (50, [1.0] * 8), (None, [1.0] * 8), (1000, None), (1050, [None] * 8), (1100, [math.nan] * 8), (1150, [math.inf] * 8),
             (1200, [0.5] * 3), (1201, [0.25] * 3), (1250, [1.0] * 5), (1300, []), (1350, [3e5] * 8)]
    return rows


@pytest.mark.parametrize("tile", [16, 2048])
def test_topk_equals_brute_force(spark, tile):
    rows = vectors()
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], VEC).repartition(3)
    got = exact_topk.top_k(df, F.col("vec_id") % 50 == 0, 5, tile=tile, group_tiles=1, shard_tiles=1, fan_in=2).collect()
    assert sorted(tuple(r) for r in got) == brute_topk(rows, 5, lambda i: i % 50 == 0)


def test_topk_beyond_float64(spark):
    rows = [(50, [3e8, 1.0]), (1, [3e8, 2.0]), (2, [3e8, 1.0]), (3, [-3e8, 1.0])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], VEC)
    got = exact_topk.top_k(df, F.col("vec_id") % 50 == 0, 5).collect()
    want = [(q, r, c, max(min(s, 2**63 - 1), -(2**63))) for q, r, c, s in brute_topk(rows, 5, lambda i: i % 50 == 0)]
    assert sorted(tuple(r) for r in got) == want


def test_topk_query_and_sql(spark, sf_dir, tmp_path):
    import duckdb

    rows = [r for r in vectors() if r[0] != 50 and (r[1] is None or len(r[1]) == 8)]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], VEC)
    got = QUERIES["op9_exact_topk"](spark, sf_dir(embeddings=df))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet' WHERE vec_id IS NOT NULL")
    cols = "query_id, rank, vec_id, score"
    assert sorted(tuple(r) for r in got.select(*cols.split(", ")).collect()) == sorted(con.execute(f"SELECT {cols} FROM ({ORACLES['op9_exact_topk']})").fetchall())
    assert QUERIES["op9_exact_topk"](spark, sf_dir(embeddings=df.limit(0))).collect() == []


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 50), min_size=1, max_size=40), st.integers(1, 6))
def test_differencing_keeps_every_item_once(sizes, shards):
    parts = [[(s, [i])] for i, s in enumerate(sizes)]
    out = sharding.difference(parts, shards)
    assert len(out) <= shards
    assert sorted(i for _, members in out for i in members) == list(range(len(sizes)))
    assert all(s == sum(sizes[i] for i in members) for s, members in out)


def test_differencing_beats_greedy_on_the_textbook_case():
    out = sharding.difference([[(s, [s])] for s in (8, 7, 6, 5, 4)], 2)
    assert [s for s, _ in out] == [16, 14]


def check_shards(rows, docs, shards):
    assert len(rows) == len(docs)
    place = {}
    for r in rows:
        t = docs[r.doc_id]
        assert (r.size, r.text_crc32) == (len((t or "").encode()) + 8, zlib.crc32((t or "").encode()))
        assert place.setdefault(t, r.shard) == r.shard and 0 <= r.shard < shards
        assert r.law == "bytes" and r.grown_shard is None
    for s in range(shards):
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert slots == list(range(len(slots)))
    return [sum(r.size for r in rows if r.shard == s) for s in range(shards)]


def test_shard_query_balances(spark, make_docs, sf_dir):
    rng = random.Random(3)
    texts = ["é" * rng.randrange(1, 400) + str(i) for i in range(3000)] + [None, "", "", "same text"] + ["same text"] * 40
    rows = QUERIES["op7_sharding"](spark, sf_dir(documents=make_docs(texts))).collect()
    sums = check_shards(rows, dict(enumerate(texts)), 24)
    assert max(sums) - min(sums) < 0.002 * max(sums)


def test_heavy_groups_leave_room(spark, make_docs):
    rng = random.Random(4)
    texts = ["copy " * 50] * 700 + ["x" * rng.randrange(1, 300) + str(i) for i in range(2000)]
    df = sharding.shard(make_docs(texts), 4, block_groups=300, unit_rows=100).selectExpr("*", "'bytes' law", "cast(null as int) grown_shard")
    sums = check_shards(df.collect(), dict(enumerate(texts)), 4)
    heavy = 700 * (250 + 8)
    rest = sorted(sums)[:-1] if max(sums) >= heavy else sums
    assert max(rest) - min(rest) < 0.01 * max(rest)


def test_light_blocks_are_differenced_in_levels(spark, make_docs):
    rng = random.Random(5)
    texts = ["x" * rng.randrange(1, 300) + str(i) for i in range(2500)]
    df = sharding.shard(make_docs(texts), 3, block_groups=10).selectExpr("*", "'bytes' law", "cast(null as int) grown_shard")
    sums = check_shards(df.collect(), dict(enumerate(texts)), 3)
    assert max(sums) - min(sums) < 0.002 * max(sums)


def test_shard_nulls_repeats_empty(spark, sf_dir):
    docs = spark.createDataFrame([(None, "a"), (None, "a"), (4, "a"), (4, "a"), (4, None)], "doc_id long, text string")
    rows = QUERIES["op7_sharding"](spark, sf_dir(documents=docs)).collect()
    assert len(rows) == 5 and len({(r.shard, r.slot) for r in rows}) == 5
    assert QUERIES["op7_sharding"](spark, sf_dir(documents=docs.limit(0))).collect() == []


def brute_distance(item, doc):
    best = len(item)
    row = [0] * (len(doc) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(doc, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(best, *row)


def leak_case(seed=9):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)] + ["the", "of", "and", "Ä"] * 60
    items = [rng.choices(words, k=rng.randrange(14, 60)) for _ in range(30)] + [["only", "three", "words"], ["single"], list("aaaaaaaaaaaaaa")]
    docs = []
    for i in range(200):
        body = rng.choices(words, k=rng.randrange(0, 200))
        if i % 2:
            leak = list(rng.choice(items[:30]))
            for _ in range(rng.randrange(0, len(leak) // 6)):
                at = rng.randrange(len(leak))
                kind = rng.randrange(3)
                leak[at : at + (kind != 1)] = [] if kind == 0 else [rng.choice(words)]
            at = rng.randrange(len(body) + 1)
            body[at:at] = leak
        docs.append(rng.choice([" ", ", ", "\n"]).join(body).title() if i % 5 == 0 else " ".join(body))
    return items, docs


def test_decontamination_against_brute_force(spark, make_docs, sf_dir):
    items, docs = leak_case()
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)] + [(90, None), (91, ""), (None, "w1 w2")], "item_id long, text string")
    rows = sorted(QUERIES["op2_decontamination"](spark, sf_dir(documents=make_docs([*docs, "", None]), benchmark=bench)).collect())
    assert len(rows) == len(docs) + 2
    want = found = 0
    low = [[w.lower() for w in t] for t in items]
    for r in rows:
        words = [w.strip(",").lower() for w in (docs[r.doc_id].split() if r.doc_id < len(docs) else [])]
        true = {i: d for i, t in enumerate(low) if (d := brute_distance(t, words)) <= int(0.2 * len(t) + 1e-9)}
        got = dict(zip(r.item_ids, r.edits))
        assert got.items() <= true.items() or all(true.get(i, 99) <= d for i, d in got.items())
        assert r.contaminated == bool(got) and set(got) <= set(true)
        want += len(true)
        found += len(got)
        assert all(i in got for i, d in true.items() if d == 0)  # whole copies are never missed
    assert want > 60 and found / want >= 0.95


def test_decontamination_in_passes_and_edges(spark, make_docs):
    items, docs = leak_case()
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    df = make_docs(docs)
    one = decontaminate.contamination(df, bench).orderBy("doc_id").collect()
    many = decontaminate.contamination(df, bench, max_index_bytes=60_000).orderBy("doc_id").collect()
    assert one == many and any(r.contaminated for r in one)
    none = decontaminate.contamination(df, bench.limit(0)).collect()
    assert len(none) == len(docs) and not any(r.contaminated for r in none)
    assert decontaminate.contamination(df.limit(0), bench).collect() == []


@pytest.mark.parametrize("n_words", [5, 10, 12, 13, 15, 16, 18, 20, 24, 31])
def test_short_items_are_found_at_their_own_limit(n_words):
    import pyarrow as pa

    rng = random.Random(n_words)
    limit = n_words // 5
    items = [[f"i{k}w{i}" for i in range(n_words)] for k in range(100)]
    texts = []
    for words in items:
        t = list(words)
        for n, at in enumerate(sorted(rng.sample(range(n_words), limit), reverse=True)):
            t[at : at + 1] = rng.choice([[f"x{n}"], [], [t[at], f"y{n}"]])
        texts.append(" ".join(["before"] * 9 + t + ["after"] * 9))
    index = decontaminate.ItemIndex(list(range(100)), [" ".join(w) for w in items], 0.8, 3, 5, 16, 7)
    found = decontaminate._matches(index, pa.array(texts))
    assert [i for i, f in enumerate(found) if i not in f] == []
    assert all(f[i] <= limit for i, f in enumerate(found))


@pytest.mark.parametrize("heavy", [[], [0.6], [0.03] * 10 + [0.2] * 10 + [0.011 * i for i in range(1, 11)]])
def test_many_blocks_and_large_groups_stay_even(spark, heavy):
    """500 blocks, sizes up to a shard's 64th, large groups of every size."""
    rng = random.Random(len(heavy))
    light = [int(rng.paretovariate(0.8) * 100) for _ in range(5000)]
    top = sum(light) // (24 * 64)
    light = [min(s, top) for s in light]
    fair = sum(light) / 24
    sizes = light + [int(h * fair) for h in heavy] + ([int(3 * fair)] if len(heavy) == 1 else [])
    groups = spark.createDataFrame([(b"%d" % i, s) for i, s in enumerate(sizes)], "key binary, size long")
    rows = sharding.assign(groups, 24, block_groups=10).collect()
    assert sorted(int(r.key) for r in rows) == list(range(len(sizes)))
    sums = [0] * 24
    for r in rows:
        sums[r.shard] += sizes[int(r.key)]
    if max(sizes) > sum(sizes) / 24:
        sums.remove(max(sizes))  # alone in its shard
    assert max(sums) < 1.01 * sum(sums) / len(sums)


def test_few_groups_get_plain_differencing(spark):
    rng = random.Random(9)
    sizes = [rng.randrange(1, 10_000) for _ in range(300)]
    keys = [b"%03d" % i for i in range(300)]
    rows = sharding.assign(spark.createDataFrame(list(zip(keys, sizes)), "key binary, size long"), 4).collect()
    order = sorted(range(300), key=lambda i: -sizes[i])
    want = sharding.difference([[(sizes[i], [i])] for i in order], 4)
    got = [0] * 4
    for r in rows:
        got[r.shard] += sizes[int(r.key)]
    assert sorted(got) == sorted(s for s, _ in want)


def brute_words(text):
    import regex

    alone = r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]"
    return [w.encode() for w in regex.findall(rf"(?V1)[{alone}&&[\p{{L}}\p{{M}}\p{{N}}]]|[[\p{{L}}\p{{M}}\p{{N}}]--{alone}]+", text)]


@given(st.lists(st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("aZ9 éÊ中文かナไท—’́ 😀ẞſ")), max_size=30), max_size=6))
@settings(max_examples=200, deadline=None)
def test_unicode_words_equal_a_pattern(texts):
    import pyarrow as pa
    import pyarrow.compute as pc

    from trainprep.llm import textbytes as tb

    column = pa.array([*texts, None], pa.string())
    data, starts, ends, first = tb.unicode_words(column)
    raw = data.tobytes()
    got = [[raw[s:e] for s, e in zip(starts[a:b], ends[a:b])] for a, b in zip(first, first[1:])]
    assert got == [brute_words(t or "") for t in pc.utf8_lower(column).to_pylist()]


def test_items_in_any_script_case_and_punctuation(spark, make_docs):
    """Items inside a paragraph without spaces, in other case, between
    typographic quotes and dashes; a passage over its limit stays clean."""
    items = ["今天天气很好我们一起去公园散步吧", "la fête était très animée à l’école hier soir", "it was said that nobody knew the answer", "ein Bär größer als Öl und Äpfel im Übermaß"]
    docs = ["早上他说:" + items[0] + "。大家都同意了。", items[1].upper().replace("’", "'"), "“It was said—that nobody knew the answer…”", items[3].upper().replace("SS", "ẞ"),
            "今天天气不好他们明天去商店买东西", "la fête"]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = decontaminate.contamination(make_docs(docs), bench).orderBy("doc_id").collect()
    assert [r.item_ids for r in got] == [[0], [1], [2], [3], [], []]
    assert [r.edits[0] for r in got[:3]] == [0, 0, 0]


def test_one_item_of_two_texts_and_a_very_long_text(spark, make_docs):
    """An id in two passes is reported once, by its fewest edits; a text of
    5 MB is searched whole."""
    a, b = (" ".join(f"{c}{i}" for i in range(40)) for c in "xy")
    bench = spark.createDataFrame([(1, a), (1, b), (1, a), (2, b)], "item_id long, text string")
    docs = make_docs([f"{a} and {b.replace('y7 ', '')}", "filler words " * 400_000 + b])
    for bound in (64 << 20, 4_000):
        got = decontaminate.contamination(docs, bench, max_index_bytes=bound).orderBy("doc_id").collect()
        assert [(r.item_ids, r.edits) for r in got] == [([1, 2], [0, 1]), ([1, 2], [0, 0])]


def test_walks_find_short_items_too():
    """Every item that allows an edit is in the index of the walks."""
    texts = [" ".join(f"i{k}w{j}" for j in range(n)) for k, n in enumerate((3, 5, 9, 12, 20, 31, 32, 60))]
    index = decontaminate.ItemIndex(list(range(len(texts))), texts, 0.8, 3, 5, 16, 7)
    walked = {int(i) for t in index.tables for _, items, _, _ in t.values() for i in items}
    assert walked == {1, 2, 3, 4, 5, 6, 7}


@pytest.mark.parametrize("top,cell", [(100.0, "<i2"), (1e6, "<i4"), (1e12, "<f8")])
def test_tiles_are_kept_narrow(top, cell):
    mat = np.array([[top, -top], [1.0, 0.0]])
    row = exact_topk._tile(2, 1, np.array([4, 2]), np.array([0, 1]), np.array([True, False]), mat).to_pylist()[0]
    assert row["cell"] == cell
    opened = exact_topk._opened(row)
    assert opened["mat"].tolist() == [[1.0, 0.0], [top, -top]] and opened["ids"].tolist() == [2, 4]
