from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest

from trainprep.llm import prefix_trie

TURNS = "conv_id long, turn long, role string, text string, id string, words int, entry string, seq string, key string, depth int"


def rebuilt_by_hand(rows, every=20, most=4):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))

    def digest(role, text):
        return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()

    for conv, turns in own.items():
        turns.sort(key=lambda t: (t[0], t[1], digest(t[2], t[3])))
        own[conv] = [t[2:] for t in turns]
    out = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % most
        base = conv - (abs(conv) % every if conv >= 0 else -(abs(conv) % every))
        out[conv] = own.get(base, [])[:h] + turns[h:]
    return out


def trie_by_hand(convs):
    members, ends = {}, {}
    for conv, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(conv)
        ends.setdefault(tuple(turns), []).append(conv)
    children = {}
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)

    def below(path):
        todo = [path]
        while todo:
            one = todo.pop()
            yield one
            todo += children.get(one, [])

    out = []
    for path, own in members.items():
        under = list(below(path))
        saved = sum((len(members[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) for p in under if p)
        ids = ",".join(map(str, sorted(ends.get(path, []))))
        out.append((min(own), len(path), min(members[path[:-1]]) if path else None, len(own), len(children.get(path, [])),
                    sum(p not in children for p in under), saved, hashlib.sha256(ids.encode()).hexdigest()))
    return sorted(out, key=str)


def _turns(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "i", 1, "e", "s", "k", 2) for r in rows], TURNS).repartition(parts)


def _rows(rng):
    """Copies, shared beginnings of any length, ends inside others, nulls."""
    rows = []
    shared = [("user", f"turn {i} of  a long\tcommon beginning") for i in range(30)]
    for conv in range(-25, 140):
        kind = rng.randrange(5)
        if kind == 0:
            turns = [("user", "hello"), ("bot", "hi there"), ("user", "bye")]
        elif kind == 1:
            turns = shared[: rng.choice([5, 29, 30])] + [("user", f"end {rng.randrange(3)}")] * rng.randrange(2)
        elif kind == 2:
            turns = [(rng.choice(["user", "bot", None]), rng.choice(["a", "b c", "", None, "é 漢字 x"])) for _ in range(rng.randrange(1, 7))]
        elif kind == 3:
            turns = [("user", "only one")]
        else:
            turns = shared[:3] + [("bot", str(conv))]
        if conv % 20 == 0 and rng.random() < 0.3:
            continue  # a base that is absent
        rows += [(conv, i, *t) for i, t in enumerate(turns)]
    return rows + [(None, 0, "user", "no conversation"), (7, None, "sys", "first of all"), (7, None, "sys", "first of all"), (8, 2, None, None), (8, 2, "x", "y")]


@pytest.mark.parametrize("container", [1, 5, 256])
def test_trie_equals_plain_python(spark, container):
    rows = _rows(random.Random(container))
    convs = prefix_trie.share_beginnings(prefix_trie.sequences(_turns(spark, rows)))
    got = [tuple(r) for r in prefix_trie.trie(convs, container).collect()]
    assert sorted(got, key=str) == trie_by_hand(rebuilt_by_hand(rows))


def test_copies_take_no_round_of_their_own(spark):
    """Thousands of copies and a beginning of 300 turns burst once."""
    common = [("u", f"t{i}") for i in range(300)]
    rows = [(c, i, *t) for c in range(0, 2000, 100) for i, t in enumerate(common[:3])]
    rows += [(10_000 + c, i, *t) for c in range(6) for i, t in enumerate([*common, ("u", f"own {c}")])]
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    convs = prefix_trie.sequences(_turns(spark, rows))
    got = sorted((tuple(r) for r in prefix_trie.trie(convs, 2).collect()), key=str)
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    own = {}
    for c, _, role, text in rows:
        own.setdefault(c, []).append((role, text))
    assert got == trie_by_hand(own)


def test_no_rows_and_one_empty_conversation(spark):
    assert prefix_trie.trie(prefix_trie.share_beginnings(prefix_trie.sequences(_turns(spark, [])))).collect() == []
    # conversation 41 loses its only turn to an absent base
    conv = next(c for c in range(41, 60) if zlib.crc32(str(c).encode()) % 4)
    got = prefix_trie.trie(prefix_trie.share_beginnings(prefix_trie.sequences(_turns(spark, [(conv, 0, "u", "gone")])))).collect()
    assert [tuple(r) for r in got] == [(conv, 0, None, 1, 0, 1, 0, hashlib.sha256(str(conv).encode()).hexdigest())]


def test_a_digest_over_many_tasks(spark):
    ids = spark.range(0, 50_000).selectExpr("cast('k' as binary) as entry", "id as conv_id").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = prefix_trie._digests(ids).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert [(bytes(r.entry), r.ends_sha256) for r in got] == [(b"k", hashlib.sha256(",".join(map(str, range(50_000))).encode()).hexdigest())]
