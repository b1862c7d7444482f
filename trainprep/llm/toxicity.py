"""Toxicity by nearest labelled examples under exact TF-IDF cosine.

Model (:func:`fit`): a bounded sample of labelled training documents
(``max_examples``, drawn by a hash of the id) gives the document frequencies
of all its words.  With ``whole`` every word of every example is a term, its
weight idf times the mutual information of word and label (G-squared over
twice the rows, so no size of sample switches a word on or off); a word of no
information weighs nothing.  Without ``whole`` only the ``max_terms`` words
most associated with the toxic label (G-squared of at least ``min_g2``, at
least ``min_docs`` toxic documents) are terms, with plain idf.  Each example
is a unit vector of (1 + log tf) * weight in an inverted index.  Words are those of
``textbytes.unicode_words``; a text is held whole by one task.

Scoring (:func:`score`): the k nearest examples are found by a block-max
inverted index and are exact.  Examples lie in blocks; the lists of rare terms
are summed first, their greatest sum in a block and the maxima of the common
terms there bound the cosines in it.  The blocks of the highest bounds are read
first; of the others only those whose bound reaches the k-th best cosine so
far.  Votes are weighted by cosine and smoothed towards the rate of
toxic labels among the examples without any term, which is also the score of
documents without any term; so a score is a calibrated share of toxic
neighbours.  The neighbours are returned as evidence.

Model size is bounded by the sample, so it is broadcast.  Defined results:
null and empty texts score as documents without terms; without training
labels every score is 0; equal cosines go to the smaller example id; rows
with equal ids each give a row; labels that contradict for one id count as
toxic; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from trainprep.llm import textbytes as tb
from trainprep.llm.common import sliced


DENSE = 384  # terms
LISTED = 64  # a common term is in more than one of so many examples
BLOCK = 16  # examples


@dataclass
class ToxicModel:
    terms: list[bytes]  # in a worker: their bytes and sizes
    idf: np.ndarray  # weight of each term
    base: float  # toxic rate of examples without any term
    k: int
    smooth: float
    ids: np.ndarray  # of examples, ascending
    labels: np.ndarray
    first: np.ndarray  # of each term in rows and counts
    rows: np.ndarray  # examples
    counts: np.ndarray  # of the term in the example
    norms: np.ndarray  # of the examples
    block: int  # documents in one product

    def lookup(self):
        """Sorted hashes of the terms, for :func:`term_counts`."""
        if not hasattr(self, "_sorted"):
            joined, sizes = self.terms if isinstance(self.terms, tuple) else _joined(self.terms)
            ends = np.cumsum(sizes)
            hashes = tb.span_hash(tb.prefix_hash(joined), ends - sizes, ends)
            order = np.argsort(hashes)
            self._sorted = hashes[order], order, joined, ends - sizes, sizes
        return self._sorted

    def blocks(self):
        """The block-max index: the weights of all ``rows``; the place of each
        term among the ``DENSE`` most common ones (the others -1); the order of
        the examples, those with one strongest term side by side; the places of
        ``rows`` in it; for every
        block of ``BLOCK`` examples the weights of the common terms; and their
        maxima in it.  The list of any other term is shorter than one example
        a block, so its entries are their own maxima."""
        if not hasattr(self, "_blocks"):
            n, held = len(self.ids), np.diff(self.first)
            weights = np.log(self.counts, dtype=np.float64)
            weights += 1
            weights *= np.repeat(self.idf, held)
            strongest, top = np.zeros(n, np.int64), np.zeros(n)
            for at in range(0, len(weights), 1 << 18):
                some = slice(at, at + (1 << 18))
                weights[some] /= self.norms[self.rows[some]]
                np.maximum.at(top, self.rows[some], weights[some])
            for at in range(0, len(weights), 1 << 18):
                some = slice(at, at + (1 << 18))
                is_top = np.flatnonzero(weights[some] == top[self.rows[some]]) + at
                strongest[self.rows[is_top]] = np.searchsorted(self.first, is_top, "right") - 1
            order = np.lexsort((top, strongest))
            spot = np.empty(n, np.int64)
            spot[order] = np.arange(n)
            common = np.argsort(-held, kind="stable")[:DENSE]
            common = common[held[common] * LISTED > n]
            place = np.full(len(held), -1, np.int64)
            place[common] = np.arange(len(common))
            table = np.zeros((-(-n // BLOCK), len(common), BLOCK))
            for i, t in enumerate(common.tolist()):
                at = spot[self.rows[self.first[t] : self.first[t + 1]]]
                table[at // BLOCK, i, at % BLOCK] = weights[self.first[t] : self.first[t + 1]]
            self._blocks = weights, place, order, spot.astype(np.int32)[self.rows], table, table.max(axis=2).T.copy()
        return self._blocks

    def __getstate__(self):
        state = {k: v for k, v in self.__dict__.items() if k not in ("_sorted", "_blocks")}
        return state | {"terms": _joined(self.terms) if isinstance(self.terms, list) else self.terms}  # a worker holds no object per term


def _joined(terms: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(terms), np.uint8), np.array([len(t) for t in terms], np.int64)


def _ragged(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions ``first[i] : first[i] + sizes[i]``, end to end."""
    before = np.cumsum(sizes) - sizes
    return np.arange(sizes.sum()) + np.repeat(first - before, sizes)


def term_counts(texts: pa.Array, lookup) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, count) of every term that occurs, by text then term."""
    known, order, joined, begin, sizes = lookup
    none = np.empty(0, np.int64)
    low, starts, ends, first = tb.unicode_words(texts)
    if not len(starts) or not len(known):
        return none, none, none
    hashes = tb.span_hash(tb.prefix_hash(low), starts, ends)
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    word = np.flatnonzero(known[at] == hashes)
    term = order[at[word]]
    same = sizes[term] == ends[word] - starts[word]
    word, term = word[same], term[same]
    if not len(word):
        return none, none, none
    n = sizes[term]
    differ = low[_ragged(starts[word], n)] != joined[_ragged(begin[term], n)]
    same = ~np.logical_or.reduceat(differ, np.cumsum(n) - n)
    word, term = word[same], term[same]
    doc = np.searchsorted(first, word, "right") - 1
    key, count = np.unique(doc * len(known) + term, return_counts=True)
    return key // len(known), key % len(known), count


def _unit(text, term, count, idf, n) -> np.ndarray:
    weight = (1 + np.log(count)) * idf[term]
    norm = np.sqrt(np.bincount(text, weight**2, n))
    return weight / norm[text]


def _word_lists(sample: DataFrame) -> pa.Table:
    """``(i, y, words, n)`` of each row: its different words, and how often
    each occurs."""

    def run(batches):
        for batch in sliced(batches, 0, 1 << 20):
            low, starts, ends, first = tb.unicode_words(batch.column(0))
            words = tb.gather(low, starts, ends).dictionary_encode()
            codes = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            doc = np.repeat(np.arange(len(batch)), np.diff(first))
            key, count = np.unique(doc * max(1, len(words.dictionary)) + codes, return_counts=True)
            offsets = pa.array(np.searchsorted(key, np.arange(len(batch) + 1) * max(1, len(words.dictionary))), pa.int32())
            each = words.dictionary.cast(pa.binary()).take(pa.array(key % max(1, len(words.dictionary))))
            lists = pa.ListArray.from_arrays(offsets, each), pa.ListArray.from_arrays(offsets, pa.array(count, pa.int32()))
            rows = pa.RecordBatch.from_arrays([batch.column(2), batch.column(1), *lists], names=["i", "y", "words", "n"])
            out = pa.BufferOutputStream()
            with pa.ipc.new_stream(out, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                writer.write_batch(rows)
            yield pa.RecordBatch.from_arrays([pa.array([out.getvalue().to_pybytes()], pa.binary())], names=["rows"])

    schema = pa.schema([("i", pa.int64()), ("y", pa.int32()), ("words", pa.list_(pa.binary())), ("n", pa.list_(pa.int32()))])
    packed = sample.mapInArrow(run, "rows binary").toArrow()["rows"]
    return pa.Table.from_batches([b.cast(schema) for p in packed for b in pa.ipc.open_stream(p.as_buffer())], schema)


def _g2(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """G-squared of each word and the label."""
    n = n_toxic + n_clean

    def part(x, row, col):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(x > 0, x * np.log(x * n / (row * float(col))), 0.0)

    has, lacks = toxic + clean, n - toxic - clean
    return 2 * (part(toxic, has, n_toxic) + part(clean, has, n_clean) + part(n_toxic - toxic, lacks, n_toxic) + part(n_clean - clean, lacks, n_clean))


def fit(
    labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    max_terms: int = 2048, min_g2: float = 60.0, min_docs: int = 5, k: int = 25, smooth: float = 0.5, block: int = 128,
    whole: bool = False,
) -> ToxicModel:
    """Model from a bounded frame of labelled documents (see :func:`training_sample`)."""
    sample = labelled.select(F.col(text_col).cast("string").alias("t"), F.col(label_col).cast("int").alias("y"), F.col(id_col).cast("long").alias("i"))
    found = _word_lists(sample.where(F.col("y").isin(0, 1)))
    labels, ids = found["y"].to_numpy().astype(np.int64), found["i"].to_pylist()
    n, n_toxic = len(labels), int(labels.sum())
    n_clean = n - n_toxic
    sizes = pc.fill_null(pc.list_value_length(found["words"]), 0).to_numpy().astype(np.int64)
    # a few values per word of the sample: narrow, and dropped once used
    count = pc.list_flatten(found["n"]).to_numpy()
    flat = pc.list_flatten(found["words"])
    del found
    coded = flat.dictionary_encode().combine_chunks()
    del flat
    words, term = tb.to_bytes(coded.dictionary), coded.indices.to_numpy(zero_copy_only=False)
    del coded
    pa.default_memory_pool().release_unused()
    row = np.repeat(np.arange(n, dtype=np.int32), sizes)
    df = np.bincount(term, minlength=len(words))
    toxic = np.bincount(term[labels[row] == 1], minlength=len(words))
    chosen = np.empty(0, np.int64)
    if n_toxic and n_clean:
        g2 = _g2(toxic, df - toxic, n_toxic, n_clean)
        if whole:
            chosen = np.flatnonzero(g2 > 1e-9)
        else:
            chosen = np.flatnonzero((toxic * n_clean > (df - toxic) * n_toxic) & (toxic >= min_docs) & (g2 >= min_g2))
            chosen = np.array(sorted(chosen.tolist(), key=lambda w: (-g2[w], words[w]))[:max_terms], np.int64)
    chosen = np.array(sorted(chosen.tolist(), key=words.__getitem__), np.int64)
    idf = np.log((1 + n) / (1 + df[chosen])) + 1
    if whole and len(chosen):
        idf *= g2[chosen] / (2 * n)
    terms = [words[w] for w in chosen.tolist()]
    number = np.full(len(words), -1, np.int32)
    number[chosen] = np.arange(len(chosen))
    del words
    term = number[term]
    kept = term >= 0
    row, term, count = row[kept], term[kept], count[kept]
    square = np.zeros(n)
    for at in range(0, len(row), 1 << 20):
        some = slice(at, at + (1 << 20))
        square += np.bincount(row[some], ((1 + np.log(count[some])) * idf[term[some]]) ** 2, n)
    held = np.bincount(row, minlength=n)
    rate = n_toxic / n if n else 0.0
    base = (int(labels[held == 0].sum()) + rate) / (int((held == 0).sum()) + 1) if n else 0.0
    # examples by id and label, equal ones by what they hold
    names = [(i is None, i or 0, y) for i, y in zip(ids, labels.tolist())]
    often, end = Counter(names), np.cumsum(held)
    own = []
    for r in np.flatnonzero(held).tolist():
        body = slice(end[r] - held[r], end[r])
        own.append((names[r], sorted(zip(term[body].tolist(), count[body].tolist())) if often[names[r]] > 1 else [], r))
    examples = np.array([x[-1] for x in sorted(own)], np.int64)
    del kept
    rank = np.zeros(n, np.int32)
    rank[examples] = np.arange(len(examples))
    row = rank[row]
    order = np.argsort(term, kind="stable")
    first = np.searchsorted(term[order], np.arange(len(terms) + 1)).astype(np.int64)
    narrow = np.min_scalar_type(int(count.max())) if len(count) else np.uint8
    return ToxicModel(
        terms, idf, base, k, smooth, np.array([-1 if ids[r] is None else ids[r] for r in examples.tolist()], np.int64), labels[examples],
        first, row[order], count.astype(narrow)[order], np.sqrt(square[examples]), block,
    )


def training_sample(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_examples: int = 20_000
) -> DataFrame:
    """Labelled documents, at most ``max_examples`` rows: ids by order of a
    hash, of rows with one id the least text."""
    ids = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    ids = ids.groupBy(F.col(id_col).cast("long").alias("_i")).agg(F.max(F.col(label_col).cast("int")).alias("_y"))
    ids = ids.orderBy(F.xxhash64("_i"), "_i").limit(max_examples)
    texts = docs.select(F.col(id_col).cast("long").alias("_i"), F.col(text_col).alias("_t"))
    # at most max_examples rows of 12 bytes
    rows = texts.join(F.broadcast(ids), "_i").groupBy("_i").agg(F.min("_t").alias("_t"), F.first("_y").alias("_y"))
    return rows.select(F.col("_i").alias(id_col), F.col("_t").alias(text_col), F.col("_y").alias(label_col))


def _add_blocks(total: np.ndarray, asked: np.ndarray, table: np.ndarray, pairs: np.ndarray) -> None:
    """Adds the common terms of every (document, block) marked in ``pairs``."""
    block, doc = np.nonzero(pairs.T)
    cuts = np.flatnonzero(np.r_[True, block[1:] != block[:-1], True]) if len(block) else [0]
    for a, z in zip(cuts[:-1], cuts[1:]):
        b, docs = block[a], doc[a:z]
        total[docs, b * BLOCK : (b + 1) * BLOCK] += asked[docs] @ table[b]


def neighbours(
    model: ToxicModel, cuts: np.ndarray, term: np.ndarray, weight: np.ndarray, seen: list | None = None
) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, cosines) of the exact k nearest examples that share a term, for
    each document ``d`` with terms ``cuts[d]:cuts[d + 1]``.  ``seen`` collects
    (blocks read, blocks) per group of documents."""
    every, place, order, spots, table, most = model.blocks()
    n, n_blocks, out = len(model.ids), len(table), []
    common = place[term] >= 0
    for at in range(0, len(cuts) - 1, model.block):
        some = cuts[at : at + model.block + 1]
        own = np.flatnonzero(common[some[0] : some[-1]]) + some[0]
        asked = np.zeros((len(some) - 1, len(most)))
        asked[np.searchsorted(some, own, "right") - 1, place[term[own]]] = weight[own]
        totals = np.zeros((len(some) - 1, n_blocks * BLOCK))
        for total, a, b in zip(totals, some.tolist(), some[1:].tolist()):
            rare = np.flatnonzero(~common[a:b]) + a
            if len(rare):
                begin, end = model.first[term[rare]], model.first[term[rare] + 1]
                lists = list(zip(begin.tolist(), end.tolist()))
                rows = np.concatenate([spots[x:y] for x, y in lists])
                weights = np.concatenate([every[x:y] for x, y in lists])
                weights *= np.repeat(weight[rare], end - begin)
                total += np.bincount(rows, weights, len(total))
        # no example of a block scores above its bound
        bounds = totals.reshape(len(totals), n_blocks, BLOCK).max(axis=2)
        bounds += asked @ most
        # the most promising blocks first: they tell what the others must reach
        ahead = min(n_blocks, -(-model.k // BLOCK) * 3)
        best = np.argpartition(-bounds, ahead - 1, axis=1)[:, :ahead]
        read = np.zeros(bounds.shape, bool)
        np.put_along_axis(read, best, True, axis=1)
        _add_blocks(totals, asked, table, read)
        floor = np.zeros(len(totals))
        if ahead * BLOCK >= model.k:
            first = np.take_along_axis(totals.reshape(len(totals), n_blocks, BLOCK), best[:, :, None], axis=1).reshape(len(totals), -1)
            floor = np.partition(first, first.shape[1] - model.k, axis=1)[:, -model.k]
        more = ~read & (bounds > 0) & (bounds >= floor[:, None] - 1e-9)
        _add_blocks(totals, asked, table, more)
        if seen is not None:
            seen.append((int(read.sum() + more.sum()), read.size))
        for total in totals:
            least = np.partition(total, len(total) - model.k)[-model.k] if n > model.k else 0.0
            near = np.flatnonzero((total >= least - 1e-11) & (total > 0))
            cosines, near = np.round(total[near], 12), order[near]
            best = np.lexsort((near, -cosines))[: model.k]
            best = best[cosines[best] > 0]
            out.append((near[best], cosines[best]))
    return out


def _vote(model: ToxicModel, rows: np.ndarray, cosines: np.ndarray) -> float:
    weight = cosines**2
    return float((weight @ model.labels[rows] + model.smooth * model.base) / (weight.sum() + model.smooth))


def score(
    docs: DataFrame, model: ToxicModel, id_col: str = "doc_id", text_col: str = "text", extra: list[str] | None = None, evidence: int = 3
) -> DataFrame:
    """id and ``extra`` columns with ``score double``, ``predicted int`` and
    ``evidence array<struct<example, cosine, toxic>>``; one row per row."""
    keep = list(dict.fromkeys([id_col, *(extra or [])]))
    # a text that is kept goes to the workers once
    kept_text = text_col in keep and docs.schema[text_col].dataType == StringType()
    df = docs.select(*keep) if kept_text else docs.select(*keep, F.col(text_col).cast("string").alias("_body"))
    body = keep.index(text_col) if kept_text else len(keep)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    shape = docs.select(*keep).schema.add("score", "double").add("predicted", "integer")
    shape = shape.add("evidence", ArrayType(StructType().add("example", "long").add("cosine", "double").add("toxic", "integer")))
    kind = pa.list_(pa.struct([("example", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())]))

    def run(batches):
        m = shared.value
        memo: dict = {}
        for batch in sliced(batches, body, 1 << 19):
            values, why = [m.base] * len(batch), [[] for _ in range(len(batch))]
            if len(m.ids):
                text, term, count = term_counts(batch.column(body), m.lookup())
                weight = _unit(text, term, count, m.idf, len(batch))
                cuts = np.flatnonzero(np.r_[True, text[1:] != text[:-1]]) if len(text) else np.empty(0, np.int64)
                ends = np.r_[cuts[1:], len(text)]
                if len(memo) > 10_000:
                    memo.clear()
                keys = [sha256(term[a:b].tobytes() + count[a:b].tobytes()).digest() for a, b in zip(cuts.tolist(), ends.tolist())]
                new = {key: d for d, key in enumerate(keys) if key not in memo}  # equal documents once
                some = np.array(list(new.values()), np.int64)
                sizes = ends[some] - cuts[some]
                at = _ragged(cuts[some], sizes)
                for key, (rows, cos) in zip(new, neighbours(m, np.append(0, np.cumsum(sizes)), term[at], weight[at])):
                    memo[key] = _vote(m, rows, cos), [
                        {"example": int(m.ids[r]), "cosine": float(c), "toxic": int(m.labels[r])} for r, c in zip(rows[:evidence], cos)
                    ]
                for d, key in zip(text[cuts].tolist(), keys):
                    values[d], why[d] = memo[key]
            column = pa.array(values, pa.float64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(keep))), column, pc.cast(pc.greater_equal(column, 0.5), pa.int32()), pa.array(why, kind)],
                names=[*keep, "score", "predicted", "evidence"],
            )

    return df.mapInArrow(run, shape)
