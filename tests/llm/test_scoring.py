from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from trainprep.llm import langid, lm_scoring, toxicity
from trainprep.llm.queries import QUERIES, vocabulary_path


def crc(i):
    return zlib.crc32(str(i).encode())


def lm_texts(n=300, seed=4):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(80)]
    weights = [1 / (i + 1) for i in range(80)]
    out = []
    for _ in range(n):
        t = rng.choices(words, weights, k=rng.randrange(0, 40))
        for i in range(1, len(t)):
            if rng.random() < 0.5:
                t[i] = f"n{t[i - 1]}"  # bigrams that tell something
        out.append(" \x0b".join(t).replace("w1 ", "W1\n"))
    return out + ["", None, "É é É", "unseen-word-here " * 3, "w0\x1fw1\x85w2"] + out[:9]


def brute_tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def test_lm_query_base_and_counts(spark, make_docs, sf_dir):
    texts = lm_texts()
    rows = sorted(QUERIES["op1_lm_scoring"](spark, sf_dir(documents=make_docs(texts))).collect())
    assert len(rows) == len(texts)
    count = Counter(t for i, x in enumerate(texts) if crc(i) % 7 != 2 for t in brute_tokens(x))
    n, v = sum(count.values()), len(count)
    for i, (r, text) in enumerate(zip(rows, texts)):
        tokens = brute_tokens(text)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (crc(i) % 7 == 2, len(tokens), sum(count[t] > 0 for t in tokens), n)
        assert r.base_score == pytest.approx(sum(math.log10((count[t] + 1) / (n + v + 1)) for t in tokens), abs=1e-9)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_lm_blocks_do_not_matter(spark, make_docs):
    from pyspark.sql import functions as F

    texts = [f"{a} {b}" for a in "abc" for b in "abcde"] * 8 + ["a b c d e"] * 5
    words = sorted({w for t in texts for w in t.split()})
    probes = [" ".join(x) for x in [["a"], *[["a", w] for w in [*words, "zzz"]]]]
    df = make_docs(texts + probes).repartition(3)
    train = F.col("doc_id") < len(texts)
    rows = sorted(lm_scoring.score(df, train, held_share=3).collect())[len(texts) :]
    again = sorted(lm_scoring.score(df, train, held_share=3, block_bytes=40).collect())[len(texts) :]
    assert [r.score for r in rows] == pytest.approx([r.score for r in again])
    assert all(r.score < 0 for r in rows)


def brute_scores(texts, training, held):
    """Deleted interpolation by dictionaries over lists of tokens."""
    token_lists = [brute_tokens(t) for t in texts]

    def counted(keep):
        words, pairs = Counter(), Counter()
        for tokens, k in zip(token_lists, keep):
            if k:
                words.update(tokens)
                pairs.update(zip([None, *tokens], tokens))
        return words, pairs, sum(words.values()), len(words)

    def bucket(c):
        return min(int(math.log2(c)) + 1, lm_scoring.BUCKETS - 1) if c else 0

    def parts(words, pairs, n, v, tokens):
        for before, t in zip([None, *tokens], tokens):
            yield bucket(words[before]), pairs[before, t] / words[before] if words[before] else 0.0, words[t] / max(n, 1), 1 / (v + 1)

    steps = lm_scoring.STEPS_PER_OCTAVE
    rounded = lambda p: 2.0 ** (round(steps * math.log2(p)) / steps) if p else 0.0
    kept = counted([t and not h for t, h in zip(training, held)])
    cells = Counter()
    for tokens, h in zip(token_lists, held):
        if h:
            cells.update((b, rounded(p2), rounded(p1)) for b, p2, p1, _ in parts(*kept, tokens))
    uniform = 1 / (kept[3] + 1)

    def em(rows):
        w = [1 / 3] * 3
        for _ in range(40):
            sums = [0.0] * 3
            for (_, p2, p1), k in rows:
                share = [w[0] * p2, w[1] * p1, w[2] * uniform]
                for i in range(3):
                    sums[i] += k * share[i] / sum(share)
            w = [x / sum(sums) for x in sums]
        return w

    weights = {}
    for b in range(lm_scoring.BUCKETS):
        rows = [c for c in cells.items() if c[0][0] == b]
        w = [max(x, 1e-6) for x in em(rows or list(cells.items()))]
        if b == 0:
            w[0] = 0.0
        weights[b] = [x / sum(w) for x in w]
    whole = counted(training)
    return [sum(math.log10(sum(x * y for x, y in zip(weights[b], p))) for b, *p in parts(*whole, tokens)) for tokens in token_lists]


@pytest.mark.parametrize("fan, block_bytes", [(512, 4 << 20), (2, 100), (3, 400)])
def test_lm_scores_equal_plain_python(spark, make_docs, fan, block_bytes):
    """One block, or a tree of many levels; a very long text among them."""
    from pyspark.sql import functions as F

    texts = [*lm_texts(150), "w0 w1 nw1 " * 3_000]
    df = make_docs(texts).repartition(3)
    train = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2)
    held = {r[0]: r[1] for r in df.select("doc_id", train & (F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(10)) == 0)).collect()}
    rows = sorted(lm_scoring.score(df, train, block_bytes=block_bytes, fan=fan).collect())
    want = brute_scores(texts, [crc(i) % 7 != 2 for i in range(len(texts))], [held[i] for i in range(len(texts))])
    assert any(held.values())
    assert [r.score for r in rows] == pytest.approx(want, rel=1e-9)


def test_lm_estimates_sum_to_one():
    """Over all words, the end and one unknown word, after any context."""
    weights = lm_scoring.learn_weights(np.array([[1.0, 0.5, 0.1, 4], [2.0, 0.0, 0.2, 3]]), 0.01)
    bigrams, words = Counter({("a", "a"): 3, ("a", "b"): 1}), Counter({"a": 4, "b": 5, None: 2})
    n, v = sum(words.values()), len(words)
    for context, total in (("a", 4), ("zz", 0)):
        w = weights[lm_scoring.context_bucket(np.array([total]))[0]]
        mass = sum(w[0] * (bigrams[context, x] / total if total else 0) + w[1] * words[x] / n + w[2] / (v + 1) for x in [*words, "unknown"])
        assert mass == pytest.approx(1)


def test_lm_em_raises_the_likelihood():
    rng = np.random.default_rng(1)
    table = np.stack([rng.integers(0, 5, 400), rng.random(400) * (rng.random(400) < 0.6), rng.random(400) / 10, rng.integers(1, 9, 400)], axis=1)

    def likelihood(weights):
        w = weights[table[:, 0].astype(int)]
        return (table[:, 3] * np.log(w[:, 0] * table[:, 1] + w[:, 1] * table[:, 2] + w[:, 2] * 1e-3)).sum()

    steps = [likelihood(lm_scoring.learn_weights(table, 1e-3, r)) for r in (0, 1, 3, 40)]
    assert steps == sorted(steps)
    assert lm_scoring.learn_weights(table, 1e-3).sum(axis=1) == pytest.approx(1)


def test_lm_empty_and_nothing_to_learn(spark, make_docs, sf_dir):
    docs = make_docs(["a b", "c"])
    from pyspark.sql import functions as F

    assert QUERIES["op1_lm_scoring"](spark, sf_dir(documents=docs.limit(0))).collect() == []
    rows = lm_scoring.score(docs, F.lit(False)).collect()
    assert [(r.train_tokens, r.n_known, r.base_score, r.score) for r in rows] == [(0, 0, 0.0, 0.0)] * 2
    odd = spark.createDataFrame([(None, None), (None, "a"), (3, "a"), (3, "a")], "doc_id long, text string")
    assert len(QUERIES["op1_lm_scoring"](spark, sf_dir(documents=odd)).collect()) == 4


INSULTS = ["moron", "scum", "trash", "idiot"]


def toxic_corpus(n=600, seed=8):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(200)]
    texts, toxic = [], []
    for i in range(n):
        t = rng.choices(words, k=rng.randrange(1, 80))
        bad = i % 6 == 0
        if bad:
            for w in rng.sample(INSULTS, rng.randrange(1, 4)):
                t.insert(rng.randrange(len(t) + 1), rng.choice([w, w.upper(), w + "!"]))
        texts.append(" ".join(t))
        toxic.append(int(bad))
    return texts, toxic


def brute_tfidf(model, text):
    words = Counter(re.findall(rb"[a-z0-9\x80-\xff]+", (text or "").lower().encode()))
    v = np.array([(1 + math.log(words[t])) * model.idf[i] if words[t] else 0.0 for i, t in enumerate(model.terms)])
    return v / np.linalg.norm(v) if v.any() else v


def test_toxicity_equals_brute_force_neighbours(spark, make_docs):
    texts, toxic = toxic_corpus()
    docs = make_docs([*texts, "", None, "x" * 100_000 + " moron"])
    labels = spark.createDataFrame([(i, t) for i, t in enumerate(toxic)], "doc_id long, toxic int")
    model = toxicity.fit(toxicity.training_sample(docs, labels), block=16)
    assert {t.decode() for t in model.terms} == set(INSULTS)
    example = {int(i): brute_tfidf(model, texts[i]) for i in model.ids}
    bare = [y for i, y in enumerate(toxic) if i not in example]
    assert model.base == pytest.approx((sum(bare) + sum(toxic) / len(toxic)) / (len(bare) + 1))
    rows = sorted(toxicity.score(docs, model, evidence=50).collect())
    for r, text in zip(rows, [*texts, "", None, "moron"]):
        q = brute_tfidf(model, text)
        near = sorted(((-round(float(q @ v), 12), i) for i, v in example.items() if q @ v > 0))[: model.k]
        weight = sum(c * c for c, _ in near)
        want = (sum(c * c * toxic[i] for c, i in near) + model.smooth * model.base) / (weight + model.smooth)
        assert r.score == pytest.approx(want)
        assert [round(e.cosine, 9) for e in r.evidence] == [round(-c, 9) for c, _ in near]
        assert r.predicted == (r.score >= 0.5)


def test_toxicity_query_held_out_accuracy(spark, make_docs, sf_dir):
    texts, toxic = toxic_corpus(900)
    docs = make_docs(texts)
    labels = spark.createDataFrame([(i, 1, t) for i, t in enumerate(toxic)] + [(10**6, 1, 1), (0, 1, None)], "doc_id long, quality int, toxic int")
    rows = sorted(QUERIES["op4_toxicity"](spark, sf_dir(documents=docs, labels=labels)).collect())
    held = [(r, y) for r, y in zip(rows, toxic) if r.held_out]
    assert len(held) > 100 and all(r.held_out == (crc(r.doc_id) % 5 == 0) for r in rows)
    assert sum(r.predicted == y for r, y in held) / len(held) > 0.97
    none = QUERIES["op4_toxicity"](spark, sf_dir(documents=docs, labels=labels.limit(0))).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.0, 0)}
    assert QUERIES["op4_toxicity"](spark, sf_dir(documents=docs.limit(0), labels=labels)).collect() == []


def test_toxicity_whole_vocabulary_in_small_samples(spark, make_docs, sf_dir):
    """Words with few toxic documents count, at any size of the sample."""
    rng = random.Random(5)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(300)], k=40)) for _ in range(70)]
    toxic = [int(i % 7 == 0) for i in range(70)]
    texts = [t + " scum" * y for t, y in zip(texts, toxic)]
    probes = ["w1 w2 scum w3", "w1 w2 w3 w4", "unseen", None]
    docs = make_docs([*texts, *probes])
    labels = spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int")
    rows = sorted(QUERIES["op4_toxicity"](spark, sf_dir(documents=docs, labels=labels)).collect())[len(texts) :]
    assert [r.predicted for r in rows] == [1, 0, 0, 0]
    model = toxicity.fit(toxicity.training_sample(docs, labels), block=4, whole=True)
    has, bad = Counter(), Counter()
    for t, y in zip(texts, toxic):
        has.update(set(t.encode().split()))
        bad.update(set(t.encode().split()) if y else [])
    assert set(model.terms) == {w for w in has if bad[w] * 70 != has[w] * sum(toxic)}  # all but words independent of the label
    example = [brute_tfidf(model, texts[i]) for i in model.ids]
    for r, text in zip(sorted(toxicity.score(docs, model, evidence=50).collect()), [*texts, *probes]):
        near = sorted((-round(float(brute_tfidf(model, text) @ v), 12), i) for i, v in enumerate(example))
        near = [(c, i) for c, i in near if c < 0][: model.k]
        weight = sum(c * c for c, _ in near)
        assert r.score == pytest.approx((sum(c * c * toxic[i] for c, i in near) + model.smooth * model.base) / (weight + model.smooth))
        assert [round(e.cosine, 9) for e in r.evidence] == [round(-c, 9) for c, _ in near]


def test_toxicity_block_max_index_is_exact_and_skips(spark, make_docs):
    rng = np.random.default_rng(12)
    texts, toxic = [], []
    for i in range(3000):
        if i % 10 == 9:  # repeated examples: ties go to the smaller id
            texts.append(texts[i - 7])
            toxic.append(toxic[i - 7])
            continue
        topic, bad = int(rng.integers(40)), int(rng.integers(8) == 0)
        words = [f"t{topic}x{j}" for j in rng.integers(0, 12, 8)] + [f"c{j}" for j in rng.integers(0, 200, 30)]
        words += [f"bad{j}" for j in rng.integers(0, 12, 2)] * bad
        texts.append(" ".join(words))
        toxic.append(bad)
    labels = spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int")
    model = toxicity.fit(toxicity.training_sample(make_docs(texts), labels), whole=True)
    asked = [*texts[:200], "bad1", "c5 bad2", "t3x1 t3x2", "unseen words"]
    text, term, count = toxicity.term_counts(pa.array(asked), model.lookup())
    weight = toxicity._unit(text, term, count, model.idf, len(asked))
    cuts = np.r_[np.searchsorted(text, np.unique(text)), len(text)]
    seen: list = []
    got = toxicity.neighbours(model, cuts, term, weight, seen)
    table = np.zeros((len(model.ids), len(model.idf)))
    held = np.repeat(np.arange(len(model.idf)), np.diff(model.first))
    table[model.rows, held] = (1 + np.log(model.counts.astype(float))) * model.idf[held] / model.norms[model.rows]
    assert len(got) == len(np.unique(text)) == len(asked) - 1
    for (rows, cosines), a, b in zip(got, cuts, cuts[1:]):
        cos = np.round(table[:, term[a:b]] @ weight[a:b], 12)
        want = np.lexsort((np.arange(len(cos)), -cos))[: model.k]
        want = want[cos[want] > 0]
        assert np.abs(cosines - cos[want]).max(initial=0) < 1e-9
        sure = np.abs(cos[want] - cos[want[-1]]) > 1e-9  # a tie at the end may round apart
        assert set(want[sure].tolist()) <= set(rows.tolist())
    read, every = (sum(x) for x in zip(*seen))
    assert read < every / 2


def test_toxicity_sample_holds_one_row_per_id(spark, make_docs):
    docs = make_docs(["b", "c", None]).unionByName(make_docs(["a", None] * 50).selectExpr("cast(0 as long) doc_id", "text", "lang", "source", "n_chars", "row", "fp", "kind"))
    labels = spark.createDataFrame([(0, 0), (0, 1), (1, 0), (2, 0), (9, 1)], "doc_id long, toxic int")
    assert sorted(map(tuple, toxicity.training_sample(docs, labels).collect())) == [(0, "a", 1), (1, "c", 0), (2, None, 0)]
    assert toxicity.training_sample(docs.where("doc_id = 0"), labels.where("doc_id = 0"), max_examples=1).count() == 1


@pytest.fixture(scope="module")
def pieces():
    pytest.importorskip("public_tokenizers")
    return langid.read_pieces(vocabulary_path("piece_bpe_32k.model"))


def test_forward_sums_all_segmentations(pieces):
    import pyarrow as pa

    rng = np.random.default_rng(2)
    probs = rng.dirichlet(np.ones(len(pieces)), 2).T
    index = {p: i for i, p in enumerate(pieces)}
    words = ["the", "Straße", "a", "漢字x", "ing" * 70, "zz\x00q"]
    got = langid.forward(langid.Lattice(pieces), pa.array([w.encode() for w in words]), probs)
    for w, row in zip(words, got):
        body = langid.MARK + w.encode()
        for lang in range(2):
            logs = [0.0] + [-math.inf] * len(body)
            for end in range(1, len(body) + 1):
                ways = [logs[at] + math.log(probs[index[body[at:end]], lang]) for at in range(max(0, end - 48), end) if body[at:end] in index]
                top = max(ways)
                logs[end] = top + math.log(sum(math.exp(x - top) for x in ways))
            assert row[lang] == pytest.approx(logs[-1], rel=1e-9)


def test_expected_pieces_are_the_posterior(pieces):
    import pyarrow as pa

    few = [b"a", b"b", b"ab", langid.MARK, langid.MARK + b"a", *(bytes([b]) for b in langid.MARK)]
    probs = np.random.default_rng(3).dirichlet(np.ones(len(few)), 1).T
    got = langid.forward(langid.Lattice(few), pa.array([b"ab"]), probs, np.array([2.0]), np.array([0]))[0]
    ways = []

    def grow(rest, used):
        if not rest:
            ways.append(used)
        for i, p in enumerate(few):
            if rest.startswith(p):
                grow(rest[len(p) :], [*used, i])

    grow(langid.MARK + b"ab", [])
    weight = [np.prod(probs[u, 0]) for u in ways]
    want = np.zeros(len(few))
    for u, w in zip(ways, weight):
        for i in u:
            want[i] += 2 * w / sum(weight)
    assert got == pytest.approx(want)


def test_expected_pieces_of_long_words(pieces):
    """Words of any length count, with numbers far below those of a float."""
    import pyarrow as pa

    rng = random.Random(11)
    words = ["".join(rng.choices("日本語の文章今天氣很好我們去公園", k=n)).encode() for n in (30, 700)] + [b"short", "ab".encode() * 2000]
    probs = np.random.default_rng(4).dirichlet(np.ones(len(pieces)), 2).T
    index = {p: i for i, p in enumerate(pieces)}
    langs = np.array([0, 1, 1, 0])
    want = np.zeros((2, len(pieces)))
    for w, lang, n in zip(words, langs, (2.0, 1.0, 3.0, 1.0)):
        body = langid.MARK + w
        arcs = [(i, j, index[body[i:j]]) for i in range(len(body)) for j in range(i + 1, min(len(body), i + 48) + 1) if body[i:j] in index]
        up, down = np.full(len(body) + 1, -np.inf), np.full(len(body) + 1, -np.inf)
        up[0] = down[-1] = 0
        for i, j, p in arcs:
            up[j] = np.logaddexp(up[j], up[i] + math.log(probs[p, lang]))
        for i, j, p in reversed(arcs):
            down[i] = np.logaddexp(down[i], down[j] + math.log(probs[p, lang]))
        for i, j, p in arcs:
            want[lang, p] += n * math.exp(up[i] + math.log(probs[p, lang]) + down[j] - up[-1])
    got = langid.forward(langid.Lattice(pieces), pa.array(words), probs, np.array([2.0, 1.0, 3.0, 1.0]), langs)
    assert got == pytest.approx(want, rel=1e-7, abs=1e-12)


def test_languages_without_spaces_are_told_apart(spark, sf_dir, pieces):
    letters = {"ja": "日本語の文章を書いています公園に行きました", "zh": "今天天氣很好我們去公園散步他們喜歡學習"}
    rng = random.Random(12)
    rows = [(i, "".join(rng.choices(letters[lang], k=60)) + "。", lang) for i, lang in enumerate(["ja", "zh"] * 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = QUERIES["op5_language_id"](spark, sf_dir(documents=docs)).collect()
    held = [r.lang_pred == rows[r.doc_id][2] for r in got if r.held_out]
    assert len(held) > 10 and all(held)


SAMPLES = {
    "en": "the house and the garden were with this thing that should have been there when they came home from working",
    "de": "das haus und der garten waren mit dieser sache die nicht hätte sein sollen als sie nach hause gekommen sind",
    "fr": "la maison et le jardin étaient avec cette chose qui aurait dû être là quand ils sont rentrés du travail",
    "es": "la casa y el jardín estaban con esta cosa que debería haber estado allí cuando ellos volvieron del trabajo",
}


def test_language_query(spark, sf_dir, pieces):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choices(SAMPLES[lang].split(), k=rng.randrange(8, 30))), lang) for i, lang in enumerate(list(SAMPLES) * 80)]
    n = len(rows)
    rows += [(n, None, "en"), (n + 1, "123 456 !!", "en"), (n + 2, "", None), (n + 3, "漢字", None), (n + 4, "the " * 30_000, None), (None, "the house", "en"), (0, "das haus", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "'x' as l", "1 as score")
    got = QUERIES["op5_language_id"](spark, sf_dir(documents=docs)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got if r.doc_id not in (None, 0)}
    held = [by[i].lang_pred == rows[i][2] for i in range(1, n) if by[i].held_out]
    assert len(held) > 40 and sum(held) / len(held) > 0.97
    assert all(by[n + k].lang_pred == "und" and by[n + k].score == 0 for k in range(3))
    assert by[n + 3].lang_pred in SAMPLES and by[n + 4].lang_pred == "en"
    assert all(0 <= r.score <= 1 for r in got)
    none = QUERIES["op5_language_id"](spark, sf_dir(documents=docs.selectExpr("doc_id", "text", "cast(null as string) as lang").limit(9))).collect()
    assert {r.lang_pred for r in none} == {"und"}
    assert QUERIES["op5_language_id"](spark, sf_dir(documents=docs.limit(0))).collect() == []


def test_language_sample_is_bounded_whatever_the_ids(spark, pieces, monkeypatch):
    """A repeated or null id, and copies of one row, bring no more rows."""
    rows = [(1, f"wort und satz {i}", "de") for i in range(300)] + [(None, f"the word of {i}", "en") for i in range(300)] + [(7, "le mot", "fr")] * 600
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    taken = []
    staged = langid.staged
    monkeypatch.setattr(langid, "staged", lambda df, name: taken.append(df) or staged(df, name))
    for max_rows in (50, 10_000):
        model = langid.fit(docs, pieces, max_rows=max_rows, rounds=1)
        words = Counter()
        for r in taken[-1].collect():
            words[r.lang] += r.n
        # three to four words a row, twice as many with their marks at most
        assert sum(words.values()) <= max_rows * 5
        if max_rows == 10_000:
            assert model.languages == ["de", "en", "fr"] and words["fr"] == 2
            assert words["de"] == 300 * 4 and words["en"] == 300 * 4
