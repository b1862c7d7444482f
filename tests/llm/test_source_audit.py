from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from trainprep.llm import source_audit

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def by_hand(rows, min_docs, top, scale):
    """The audit by dictionaries over ``(text, lang, source)``."""
    count, df = {}, {}
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        own = Counter(TERM.findall(lower(text or "")))
        count.setdefault(lang, {}).setdefault(source, Counter()).update(own)
        df.setdefault(lang, Counter()).update(own.keys())
    out = []
    for lang, sources in count.items():
        kept = [t for t, n in df[lang].items() if n >= min_docs]

        def shares(counter):
            n = sum(counter[t] for t in kept)
            return {t: 1 + scale * (counter[t] + 5) // (n + 5 * len(kept)) for t in kept}

        p = {s: shares(c) for s, c in sources.items()}
        whole = Counter()
        for c in sources.values():
            whole.update(c)
        q = shares(whole)
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(p[s][t] - q[t], t) for t in kept if sources[s][t] > 0 and p[s][t] > q[t]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                for rank, (value, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode()))[:limit], 1):
                    out.append((lang, s, part, item, value, rank))
    return sorted(out)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aZbÉé漢 \n.1@[`{\x85\xa0\x00"), max_size=60), st.integers(1, 9))
def test_terms_are_the_matches_of_the_pattern(text, piece):
    got = [w.decode() for part in source_audit.words(text.encode(), piece) for w in part]
    assert got == TERM.findall(lower(text))


def test_a_long_text_is_cut_into_pieces():
    text = ("x" * 3_000_000 + " " + "Ab é " * 400_000).encode()
    got = Counter(w for part in source_audit.words(text) for w in part)
    assert got == {b"x" * 3_000_000: 1, b"ab": 400_000, "é".encode(): 400_000}


def _documents(spark, rows):
    wide = [(i, *r, "t", "v", 1, 2) for i, r in enumerate(rows)]
    return spark.createDataFrame(wide, "doc_id long, text string, lang string, source string, term string, value string, place int, rank int")


@pytest.mark.parametrize("tile, bucket_terms, entries", [(64, 4096, 200_000), (2, 3, 5), (1, 1, 1)])
def test_audit_equals_plain_python(spark, monkeypatch, tile, bucket_terms, entries):
    """Hot source, nulls, empty texts, equal rows, ties, names that clash;
    tiles, buckets and counters of every size give the same rows."""
    rng = random.Random(5)
    vocabulary = ["The", "the", "cat", "Éa", "éa", "漢字", "dog", "x1y", "q"] + [f"w{chr(97 + i)}" for i in range(12)]
    rows = [(" ".join(rng.choices(vocabulary, k=rng.randrange(12))), rng.choice(["en", "de"]), "hot" if rng.random() < 0.4 else f"s{rng.randrange(5)}") for _ in range(160)]
    rows += [(None, None, None), ("", "en", "empty"), ("cat cat", None, "a"), ("cat cat", "", "a"), ("rare", "xx", "a"), ("12 34", "xx", "b")]
    rows += [("the cat", "en", "copies")] * 7
    counted = source_audit.count_terms
    monkeypatch.setattr(source_audit, "count_terms", lambda *a: counted(*a, entries=entries))
    got = source_audit.audit(_documents(spark, rows).repartition(3), min_docs=4, top=5, scale=10**9, tile=tile, bucket_terms=bucket_terms)
    assert sorted(map(tuple, got.collect())) == by_hand(rows, 4, 5, 10**9)


def test_counts_beyond_64_bits_of_product_are_exact(spark):
    from pyspark.sql import functions as F

    n, total, v = 10**12 + 7, 9 * 10**15 + 3, 1234567
    got = spark.range(1).select(source_audit.share(F.lit(n), F.lit(total), F.lit(v), 10**9).alias("p")).first().p
    assert got == 1 + 10**9 * (n + 5) // (total + 5 * v)


def test_no_rows_and_no_terms(spark):
    empty = _documents(spark, [])
    assert source_audit.audit(empty).collect() == []
    got = source_audit.audit(_documents(spark, [("a b", "en", "x"), ("c", "en", "y"), (None, "en", "z")]))
    assert sorted(map(tuple, got.collect())) == by_hand([("a b", "en", "x"), ("c", "en", "y"), (None, "en", "z")], 30, 50, 10**9)
