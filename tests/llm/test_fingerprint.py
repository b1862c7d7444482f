from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from trainprep.llm import fingerprint as fp

M = (1 << 64) - 1


def mix(h):
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        h ^= h >> 33
        h = h * factor & M
    return h ^ (h >> 33)


def parse_by_hand(text):
    """Names of every round, one name at a time."""
    names = [mix(ord(c) + 1) for c in text]
    out = [names]
    while len(names) > 1:
        joined, i = [], 0
        while i < len(names):
            j = i
            while j < len(names) and names[j] == names[i]:
                j += 1
            joined.append(names[i] if j - i == 1 else mix((names[i] * 0xD6E8FEB86659FD93 + j - i) & M))
            i = j
        colour = joined
        for _ in range(fp.TOSSES):
            new = []
            for i, c in enumerate(colour):
                before = colour[i - 1] if i else c ^ 1
                place = ((c ^ before) & -(c ^ before)).bit_length() - 1
                new.append(2 * place + (c >> place & 1))
            colour = new
        assert all(a != b for a, b in zip(colour, colour[1:])) and max(colour) < 6
        starts = [0] + [i for i in range(2, len(colour) - 1) if colour[i - 1] < colour[i] > colour[i + 1]]
        names = []
        for a, b in zip(starts, starts[1:] + [len(joined)]):
            weights = [mix(k + 1) | 1 for k in range(b - a)]
            names.append(joined[a] if b - a == 1 else mix((sum(x * w for x, w in zip(joined[a:b], weights)) + b - a) & M))
        out.append(names)
    return out


def sketch_by_hand(text):
    levels = parse_by_hand(text)
    begin = max(0, min(fp.ROUND, len(levels) - 1 - fp.BEFORE_LAST))
    own = {mix(x ^ 0x9E3779B97F4A7C15) >> 32 for level in levels[begin:] for x in level}
    root = levels[-1][0] if text else 0
    return root.to_bytes(8, "big") + b"".join(x.to_bytes(4, "big") for x in sorted(own)[: fp.SKETCH]), own


LETTERS = st.text(st.sampled_from("aab é漢\U0001f600\n"), max_size=120)


@settings(max_examples=200, deadline=None)
@given(st.lists(LETTERS, max_size=5), st.sampled_from([3, 8, 1 << 18]))
def test_rounds_and_fingerprints_equal_plain_python(texts, chunk):
    old, fp.CHUNK = fp.CHUNK, chunk
    try:
        points, sizes = fp.code_points(texts)
        got = [[] for _ in texts]
        for names, place, now in fp.rounds(points, sizes):
            ends = np.cumsum(now)
            assert (np.diff(place) > 0).all()
            for i, (a, b) in enumerate(zip(ends - now, ends)):
                got[i].append(names[a:b].tolist())
        for text, levels in zip(texts, got):
            want = parse_by_hand(text)
            assert levels[: len(want)] == want and all(x == want[-1] for x in levels[len(want) :])
        assert fp.fingerprints(texts) == [sketch_by_hand(t)[0] for t in texts]
    finally:
        fp.CHUNK = old


def _text(rng, n):
    return "".join(rng.choices("etaoin shrdlu", k=n))


def test_equal_substrings_share_inner_phrases_at_any_offset():
    rng = random.Random(2)
    middle = _text(rng, 3000)
    seen = []
    for before in ("", "x", _text(rng, 777)):
        points, sizes = fp.code_points([before + middle + _text(rng, 400)])
        rounds = list(fp.rounds(points, sizes))
        # phrases that begin well inside the common part, by place in it
        seen.append([{(int(p) - len(before), int(n)) for n, p in zip(names, place) if 300 <= p - len(before) < 2500} for names, place, _ in rounds[:5]])
    for k in range(5):
        assert seen[0][k] == seen[1][k] == seen[2][k] and seen[0][k]


def test_likeness_estimates_the_share_of_common_phrases():
    rng = random.Random(4)
    errors = []
    for n in (40, 300, 2000, 20000):
        for _ in range(10):
            a = _text(rng, n)
            b = fp.edited(a, _text(rng, n))
            (x, own), (y, other) = sketch_by_hand(a), sketch_by_hand(b)
            true = len(own & other) / len(own | other)
            errors.append(abs(fp.likeness(x, y) - true))
            if len(own) < fp.SKETCH > len(other):
                assert errors[-1] == 0
    assert np.mean(errors) < 0.05 and max(errors) < 0.25
    assert fp.likeness(x, x) == 1.0 and fp.likeness(*fp.fingerprints(["", "abc"])) == 0.0


def by_hand(rows):
    """compare_with_next over ``(id, text)``, texts of equal ids equal."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for k, (i, t) in enumerate(rows):
        follow = rows[(k + 1) % len(rows)][1]
        changed = t[: len(t) - len(t) // 3] + follow[: len(t) // 3]
        (a, _), (b, _), (c, _) = (sketch_by_hand(x) for x in (t, changed, follow))
        out.append((i, len(t), hashlib.sha256(changed.encode()).hexdigest(), a.hex(), b.hex(), fp.likeness(a, b), fp.likeness(a, c)))
    return sorted(map(str, out))


WIDE = "doc_id long, text string, part int, edge string, id string, h long, tie long, next_text string, fingerprint string"


@pytest.mark.parametrize("parts", [1, 2, 7])
def test_compared_with_the_next_document(spark, parts):
    """Nulls, empty texts, copies, one repeated id, names that clash."""
    rng = random.Random(3)
    rows = [(i * 3 - 20, _text(rng, rng.randrange(200))) for i in range(40)] + [(None, "the end of it all"), (500, None), (501, ""), (502, "x")]
    rows += [(7000, "same text of one id")] * 9 + [(7001, "same text of one id")]
    docs = spark.createDataFrame([(*r, 1, "e", "i", 2, 3, "n", "f") for r in rows], WIDE).repartition(parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(parts == 1).lower())
    try:
        got = fp.compare_with_next(docs).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted(str(tuple(r)) for r in got) == by_hand(rows)


def test_one_row_no_rows_and_a_long_text(spark):
    docs = spark.createDataFrame([], WIDE)
    assert fp.compare_with_next(docs).collect() == [] and fp.fingerprint(docs).collect() == [] and fp.phrases(docs).collect() == []
    one = spark.createDataFrame([(1, "abcdef", 1, "", "", 1, 1, "", "")], WIDE)
    assert [str(tuple(r)) for r in fp.compare_with_next(one).collect()] == by_hand([(1, "abcdef")])
    long = ["a" * 3_000_000, "ab" * 1_000_000 + "".join(random.Random(1).choices("abcdefgh ", k=2_000_000))]
    twice = fp.fingerprints([*long, long[1]])
    assert twice[1] == twice[2] and twice[0] != twice[1]


def test_phrases_name_every_round(spark, make_docs):
    rows = fp.phrases(make_docs(["the cat sat on the mat", "", None, "zz"])).collect()
    for i, text in enumerate(["the cat sat on the mat", "", "", "zz"]):
        want = parse_by_hand(text)
        for k, names in enumerate(want):
            assert [r.name & M for r in sorted((r for r in rows if r.doc_id == i and r.round == k), key=lambda r: r.place)] == names
