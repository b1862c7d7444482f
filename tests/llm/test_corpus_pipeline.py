from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

import corpus_pipeline
from trainprep.llm import byte_bpe
from trainprep.llm.queries import vocabulary_path


def test_one_document_of_each_component(spark, make_docs, sf_dir):
    """Repeated and null ids: no component is lost, none is kept twice."""
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcd")
    rows = [(3, a), (5, a), (5, b), (7, c), (7, d), (None, c), (None, "e f g"), (None, "e f g"), (None, "h i j"), (9, d), (9, d)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    kept = corpus_pipeline.keep_one_per_group(spark, docs, "").collect()
    want = [(3, a), (5, b), (7, c), (7, d), (None, "e f g"), (None, "h i j")]
    assert sorted(map(str, map(tuple, kept))) == sorted(map(str, want))


CLASH = ["_row", "row", "contaminated", "item_ids", "edits", "_hits", "score", "predicted", "evidence", "_body", "spans", "payload", "carried", "start", "kind", "key", "fp", "id", "keep", "end"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASH)


def _row(i, text, lang="en"):
    return (i, text, lang, "s", None if text is None else len(text), *(f"{c}-{i}" for c in CLASH))


def _words(rng, n):
    return " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randrange(3, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def planted():
    """(documents, labels, benchmark, rows that stay with their text then)."""
    rng = random.Random(11)
    vile = ["vilewordone", "vilewordtwo", "vilewordthree"]
    docs, labels, stay = [], [], {}
    for i in range(200):  # labelled: every tenth is toxic
        bad = i % 10 == 3
        text = _words(rng, 60)
        if bad:
            text = " ".join(w for x in text.split() for w in (x, rng.choice(vile)))
        docs.append((i, text))
        labels.append((i, 1, int(bad)))
        if not bad:
            stay[i, text] = text
    items = [_words(rng, n) for n in (20, 40, 60)]
    for k, item in enumerate(items):  # contaminated: whole, in capitals, and with a tenth of its words changed
        changed = item.split()
        changed[5::10] = ["qqq"] * len(changed[5::10])
        for j, body in enumerate((item, item.upper(), " ".join(changed))):
            docs.append((300 + 10 * k + j, f"{_words(rng, 30)} {body} {_words(rng, 30)}"))
    copy, other = _words(rng, 80), _words(rng, 80)
    docs += [(400 + j, copy) for j in range(7)] + [(410, copy.upper()), (None, copy)]
    stay[400, copy] = copy
    docs += [(420, other), (420, other), (421, _words(rng, 50))]  # a row that stands twice, a text of a repeated id
    docs.append((421, "short"))
    stay[420, other] = other
    stay[421, docs[-2][1]] = docs[-2][1]
    stay[421, "short"] = "short"
    secret = f"{_words(rng, 30)} password: hunter2hunter2XY {_words(rng, 30)}"
    docs.append((430, secret))
    stay[430, secret] = re.sub("password: hunter2hunter2XY", "[SECRET]", secret)
    docs += [(440, None), (441, ""), (442, " \n ")]
    stay[440, None] = None  # the empty texts are one component
    docs.append((None, lone := _words(rng, 40)))
    stay[None, lone] = lone
    return docs, labels, items, stay


def _tables(spark, sf_dir, docs, labels, items):
    return sf_dir(
        documents=spark.createDataFrame([_row(*d) for d in docs], SCHEMA).repartition(5),
        labels=spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
        benchmark=spark.createDataFrame(list(enumerate(items)), "item_id long, text string"),
    )


def test_run_equals_plain_python(spark, sf_dir, planted):
    """Planted toxic, copied, contaminated and secret rows; the ids of what
    stays by the public library."""
    tiktoken = pytest.importorskip("tiktoken")
    public = pytest.importorskip("public_tokenizers")
    docs, labels, items, stay = planted
    library = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=byte_bpe.read_ranks(vocabulary_path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    got = corpus_pipeline.run(spark, _tables(spark, sf_dir, docs, labels, items)).collect()
    want = []
    for (i, _), text in stay.items():
        ids = np.array(library.encode_ordinary(text or ""), "<u4").tobytes()
        want.append((i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    rows = [(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got]
    # a mask's exact extent is the scanner's matter, tested there
    plain = lambda found: sorted(str(r) for r in found if r[0] != 430)
    assert plain(rows) == plain(want) and len(rows) == len(want)


def test_stages_leave_the_columns_of_clashing_names(spark, sf_dir, planted):
    docs, labels, items, stay = planted
    at = _tables(spark, sf_dir, docs, labels, items)
    now = spark.read.parquet(f"{at}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = spark.createDataFrame(stage(spark, now, at).collect(), now.schema)
        assert now.columns == [c.split()[0].strip("`") for c in SCHEMA.split(", ")], name
        for r in now.collect():
            assert [r[c] for c in CLASH] == [f"{c}-{r.doc_id}" for c in CLASH], name
            assert r.n_chars == (None if r.text is None else len(r.text)), name
    masked = [r.text for r in now.collect() if r.doc_id == 430]
    assert len(masked) == 1 and "hunter2" not in masked[0]
    assert sorted(str(r.doc_id) for r in now.collect()) == sorted(str(i) for i, _ in stay)


def test_run_on_empty_tables(spark, sf_dir):
    assert corpus_pipeline.run(spark, _tables(spark, sf_dir, [], [], [])).collect() == []
    # documents alone
    got = corpus_pipeline.run(spark, _tables(spark, sf_dir, [(1, "a b c"), (2, None), (3, "a b c")], [], [])).collect()
    assert sorted((r.doc_id, r.n_tokens) for r in got) == [(1, 3), (2, 0)]
