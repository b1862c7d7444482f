"""Language identification by segmentation-marginalised unigrams.

A fixed public piece vocabulary is shared by all languages; each language
has its own probability for every piece.  The probability of a word (with a
leading word mark) is the sum over all its segmentations into pieces,
computed by a forward pass; a text's is the product over its words.  Piece
probabilities are learned by expectation-maximisation: forward-backward
gives the expected count of each piece in each training word.

Training takes a bounded sample of labelled rows (``max_rows``, by a hash of
the id).  Word counts per language are a Spark aggregate; every round of EM
is a Spark job over them, and only the piece table (vocabulary x languages,
bounded) returns to the driver.  Scoring walks each distinct word of a batch
once, all words in step, in numpy.

Defined results: ``und`` and score 0 where the text is null, holds no letter,
or nothing was learned; equal scores go to the first language by name;
a long word is scored whole; rows with equal ids each give a row; extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trainprep.llm import textbytes as tb
from trainprep.llm.common import sliced, staged
from trainprep.llm.pretokens import Recent

MARK = "▁".encode()
MEMO = 100_000  # words that a worker keeps, in each of two generations
LONG = 64  # bytes; the numbers of longer words are kept in range as they are walked


def read_pieces(path: str) -> list[bytes]:
    """Pieces of a public vocabulary file as bytes, without control pieces;
    byte pieces are the bytes themselves."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = set()
    for i in range(sp.get_piece_size()):
        if sp.is_byte(i):
            pieces.add(bytes([int(sp.id_to_piece(i)[3:5], 16)]))
        elif not (sp.is_control(i) or sp.is_unknown(i)):
            pieces.add(sp.id_to_piece(i).encode())
    return sorted(pieces | {bytes([b]) for b in range(256)})


class Lattice:
    """Finds every piece at every position of a batch of words."""

    def __init__(self, pieces: list[bytes]) -> None:
        self.pieces = pieces
        self.widths = {}
        by_width: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            by_width.setdefault(len(p), []).append(i)
        for width, ids in sorted(by_width.items()):
            joined = np.frombuffer(b"".join(pieces[i] for i in ids), np.uint8)
            starts = np.arange(len(ids)) * width
            hashes = tb.span_hash(tb.prefix_hash(joined), starts, starts + width)
            order = np.argsort(hashes)
            bitmap = np.zeros(1 << 18, bool)
            bitmap[(hashes >> np.uint64(46)).astype(np.int64)] = True
            self.widths[width] = hashes[order], np.array(ids)[order], bitmap

    def arcs(self, data: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, piece) byte positions of all pieces; ``left`` is the
        number of bytes from a position to the end of its word."""
        prefix = tb.prefix_hash(data)
        all_starts, all_ends, all_pieces = [], [], []
        for width, (known, ids, bitmap) in self.widths.items():
            at = np.flatnonzero(left >= width)
            if not len(at):
                break
            hashes = tb.span_hash(prefix, at, at + width)
            maybe = bitmap[(hashes >> np.uint64(46)).view(np.int64)]
            at, hashes = at[maybe], hashes[maybe]
            k = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            hit = known[k] == hashes
            all_starts.append(at[hit])
            all_ends.append(at[hit] + width)
            all_pieces.append(ids[k[hit]])
        none = np.empty(0, np.int64)
        return tuple(np.concatenate([none, *x]) for x in (all_starts, all_ends, all_pieces))


def _marked(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word bytes with the word mark before each; offsets."""
    data, offsets = tb.buffer_of(words)
    n, m = len(offsets) - 1, len(MARK)
    new = offsets + m * np.arange(n + 1)
    out = np.empty(new[-1], np.uint8)
    for i, b in enumerate(MARK):
        out[new[:-1] + i] = b
    at = np.arange(len(data)) + m * (np.repeat(np.arange(n), np.diff(offsets)) + 1)
    out[at] = data
    return out, new


def forward(lattice: Lattice, words: pa.Array, probs: np.ndarray, counts: np.ndarray | None = None, langs: np.ndarray | None = None):
    """Natural log probability of each word in each language; with ``counts``
    and ``langs``, the expected pieces ``(language, piece, count)`` instead."""
    data, offsets = _marked(words)
    sizes = np.diff(offsets)
    n_lang = probs.shape[1]
    word = np.repeat(np.arange(len(sizes)), sizes)
    inside = np.arange(len(data)) - offsets[word]
    starts, ends, pieces = lattice.arcs(data, sizes[word] - inside)
    own = word[starts]
    # nodes: one before each byte, one after the last of a word
    a, b = starts + own, ends + own
    step = inside[starts] + (ends - starts)
    order = np.argsort(step.astype(np.int32), kind="stable")
    a, b, pieces, own, step = a[order], b[order], pieces[order], own[order], step[order]
    cuts = np.searchsorted(step, np.arange(1, (step[-1] if len(step) else 0) + 2))
    nodes = len(data) + len(sizes)
    first, last = offsets[:-1] + np.arange(len(sizes)), offsets[1:] + np.arange(len(sizes))
    reach = max(lattice.widths)
    if counts is not None:
        return _expected(a, b, pieces, own, cuts, nodes, probs, first, last, reach, counts, langs)
    alpha = np.zeros((nodes, n_lang))
    alpha[first] = 1.0
    scale = np.zeros((len(sizes), n_lang))
    for t, (i, j) in enumerate(zip(cuts[:-1], cuts[1:]), 1):
        if i == j:
            continue
        to, w = b[i:j], own[i:j]
        new, inverse = _runs(to)
        gain = alpha[a[i:j]] * probs[pieces[i:j]]
        for l in range(n_lang):
            alpha[new, l] = np.bincount(inverse, gain[:, l], len(new))
        if t % 16 == 0:  # long words: keep the numbers in range
            live = np.unique(w)
            span = first[live][:, None] + np.arange(max(0, t - reach), t + 1)
            top = alpha[span].max(axis=1)
            top[top == 0] = 1.0
            alpha[span] /= top[:, None, :]
            scale[live] += np.log(top)
    with np.errstate(divide="ignore"):
        return np.log(alpha[last]) + scale


def _runs(to: np.ndarray):
    """Distinct values and inverse of a few ascending runs, which a merge sort joins."""
    order = np.argsort(to, kind="stable")
    ranked = to[order]
    change = np.ones(len(to), bool)
    change[1:] = ranked[1:] != ranked[:-1]
    inverse = np.empty(len(to), np.int64)
    inverse[order] = np.cumsum(change) - 1
    return ranked[change], inverse


def _rescale(values, level, scale, live, span):
    """Divides the nodes ``span`` of the words ``live`` by their largest
    value, whose logarithm goes into their level."""
    top = values[span].max(axis=1)
    top[top == 0] = 1.0
    values[span] /= top[:, None]
    level[span] += np.log(top)[:, None]
    scale[live] += np.log(top)


def _expected(a, b, pieces, own, cuts, nodes, probs, first, last, reach, counts, langs):
    """Forward-backward in the word's own language.  In words over LONG bytes
    a value stands for itself times exp(its level)."""
    lang = langs[own]
    p = probs[pieces, lang]
    long = last - first > LONG
    any_long = bool(long.any())
    alpha, up, scale = np.zeros(nodes), np.zeros(nodes), np.zeros(len(first))
    alpha[first] = 1.0
    for t, (i, j) in enumerate(zip(cuts[:-1], cuts[1:]), 1):
        if i == j:
            continue
        new, inverse = _runs(b[i:j])
        alpha[new] = np.bincount(inverse, alpha[a[i:j]] * p[i:j], len(new))
        if any_long:
            up[b[i:j]] = scale[own[i:j]]
            if t % 16 == 0:
                live = np.unique(own[i:j])
                live = live[long[live]]
                _rescale(alpha, up, scale, live, first[live][:, None] + np.arange(max(0, t - reach), t + 1))
    with np.errstate(divide="ignore"):
        whole = np.log(alpha[last]) + up[last]
    beta, down, scale = np.zeros(nodes), np.zeros(nodes), np.zeros(len(first))
    beta[last] = 1.0
    # backward by descending start: arcs sorted by start position in the word
    rel = a - first[own]
    order = np.argsort(-rel, kind="stable")
    steps = np.searchsorted(-rel[order], np.arange(-(rel.max() if len(rel) else 0), 2))
    for i, j in zip(steps[:-1], steps[1:]):
        k = order[i:j]
        if len(k):
            new, inverse = _runs(a[k])
            beta[new] = np.bincount(inverse, p[k] * beta[b[k]], len(new))
            if any_long:
                down[a[k]] = scale[own[k]]
                if rel[k[0]] % 16 == 0:
                    live = np.unique(own[k])
                    live = live[long[live]]
                    span = first[live][:, None] + rel[k[0]] + np.arange(reach + 1)
                    _rescale(beta, down, scale, live, np.minimum(span, last[live][:, None]))
    share = np.zeros(len(a))
    ok = np.isfinite(whole)
    k = np.flatnonzero(ok[own] & ~long[own])
    share[k] = alpha[a[k]] * p[k] * beta[b[k]] / np.exp(whole[own[k]]) * counts[own[k]]
    k = np.flatnonzero(ok[own] & long[own])
    with np.errstate(divide="ignore"):
        logs = np.log(alpha[a[k]]) + np.log(p[k]) + np.log(beta[b[k]])
    share[k] = np.exp(logs + up[a[k]] + down[b[k]] - whole[own[k]]) * counts[own[k]]
    key = lang * len(probs) + pieces
    return np.bincount(key, share, probs.shape[1] * len(probs)).reshape(probs.shape[1], len(probs))


class LanguageModel:
    def __init__(self, languages: list[str], pieces: list[bytes], probs: np.ndarray) -> None:
        self.languages, self.pieces, self.probs = languages, pieces, probs
        self._lattice, self._memo = None, Recent(MEMO)

    def log_probs(self, words: pa.Array) -> np.ndarray:
        """As :func:`forward`; words seen lately are not walked again."""
        plain = tb.to_bytes(words)
        each = [self._memo.get(w) for w in plain]
        new = [i for i, e in enumerate(each) if e is None]
        for at in range(0, len(new), 10_000):  # bounded arcs at a time
            some = new[at : at + 10_000]
            for i, row in zip(some, forward(self.lattice(), words.take(pa.array(some)), self.probs)):
                each[i] = row.tobytes()
                if len(plain[i]) <= 64:
                    self._memo.put(plain[i], each[i])
        return np.frombuffer(b"".join(each)).reshape(len(plain), len(self.languages))

    def lattice(self) -> Lattice:
        if self._lattice is None:
            self._lattice = Lattice(self.pieces)
        return self._lattice

    def __getstate__(self):
        return {"languages": self.languages, "pieces": self.pieces, "probs": self.probs, "_lattice": None, "_memo": self._memo}


def _words(texts: pa.Array):
    data, offsets = tb.buffer_of(texts)
    starts, ends, first = tb.words_in(data, offsets, ~tb.SPACES[data])
    words = tb.gather(data, starts, ends).dictionary_encode()
    return words.dictionary, words.indices.to_numpy(zero_copy_only=False).astype(np.int64), first


def fit(
    docs: DataFrame, pieces: list[bytes], id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    max_rows: int = 12_000, rounds: int = 4, floor: float = 0.02,
) -> LanguageModel:
    """Piece probabilities per language from at most ``max_rows`` labelled
    rows, those of least hash of id and text; ``floor`` is the pseudo-count of every piece."""
    spark = docs.sparkSession
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = rows.select(F.xxhash64(F.col(id_col), F.col(text_col)).alias("h"), F.col(lang_col).alias("l"), F.col(text_col).alias("t"))
    n, share = rows.count(), 4.0 * max_rows
    if not n:
        return LanguageModel([], pieces, np.zeros((len(pieces), 0)))
    # the least hashes, of which a share of the range holds enough unless most rows are copies
    while True:
        top = -(2**63) + int(min(1.0, share / n) * (2**64 - 1))
        least = rows.select("h").where(F.col("h") <= min(top, 2**63 - 1)).distinct().orderBy("h").limit(max_rows)
        found, bound = least.agg(F.count("*"), F.max("h")).first()
        if found == max_rows or share >= n:
            break
        share *= 16
    # equal texts of one id are one row of the sample, so it holds max_rows at most
    sample = rows.where(F.col("h") <= bound).groupBy("h").agg(F.min(F.struct("l", "t")).alias("r")).select("r.l", "r.t")

    def count(batches):
        for batch in sliced(batches, 1, 1 << 20):
            names = batch.column(0).dictionary_encode()
            lang = names.indices.to_numpy(zero_copy_only=False)
            words, codes, first = _words(batch.column(1))
            n = max(1, len(words))
            key, total = np.unique(np.repeat(lang, np.diff(first)) * n + codes, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [names.dictionary.take(pa.array(key // n)), words.cast(pa.binary()).take(pa.array(key % n)), pa.array(total, pa.int64())],
                names=["lang", "word", "n"],
            )

    parts = sample.mapInArrow(count, "lang string, word binary, n long")
    counted = staged(parts.groupBy("lang", "word").agg(F.sum("n").alias("n")), "langid")
    languages = [r[0] for r in counted.select("lang").distinct().orderBy("lang").collect()]
    probs = np.full((len(pieces), len(languages)), 1.0 / len(pieces))
    model = LanguageModel(languages, pieces, probs)
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(model)

        def expect(batches):
            m = shared.value
            index = {l: i for i, l in enumerate(m.languages)}
            out = np.zeros((len(m.languages), len(m.pieces)))
            for batch in sliced(batches, 1, 1 << 18):
                langs = np.array([index[l] for l in batch.column(0).to_pylist()])
                counts = batch.column(2).to_numpy(zero_copy_only=False).astype(float)
                out += forward(m.lattice(), batch.column(1), m.probs, counts, langs)
            lang, piece = np.nonzero(out)
            yield pa.RecordBatch.from_arrays(
                [pa.array(lang, pa.int32()), pa.array(piece, pa.int32()), pa.array(out[lang, piece], pa.float64())], names=["l", "p", "n"]
            )

        got = counted.mapInArrow(expect, "l int, p int, n double").groupBy("l", "p").agg(F.sum("n").alias("n"))
        table = got.toPandas()  # at most pieces x languages rows
        expected = np.full((len(languages), len(pieces)), floor)
        expected[table["l"].to_numpy(), table["p"].to_numpy()] += table["n"].to_numpy()
        model = LanguageModel(languages, pieces, (expected / expected.sum(axis=1, keepdims=True)).T.copy())
        shared.unpersist()
    return model


def _has_letter(batch_text: pa.Array) -> np.ndarray:
    data, offsets = tb.buffer_of(batch_text)
    ascii_letter = np.zeros(256, bool)
    ascii_letter[65:91] = ascii_letter[97:123] = True
    seen = np.zeros(len(data) + 1, np.int64)
    np.cumsum(ascii_letter[data], out=seen[1:])
    out = seen[offsets[1:]] > seen[offsets[:-1]]
    for i in np.flatnonzero(~out & (np.diff(offsets) > 0)):
        out[i] = any(c.isalpha() for c in data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace"))
    return out


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text", extra: list[str] | None = None) -> DataFrame:
    """id and ``extra`` columns with ``lang_pred string`` and ``score double``."""
    keep = list(dict.fromkeys([id_col, *(extra or [])]))
    df = docs.select(*keep, F.col(text_col).cast("string").alias("_body"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    shape = df.drop("_body").schema.add("lang_pred", "string").add("score", "double")

    def run(batches):
        m = shared.value
        for batch in sliced(batches, len(keep), 1 << 20):
            texts = batch.column(len(keep))
            known = _has_letter(texts) if m.languages else np.zeros(len(batch), bool)
            best, sure = np.zeros(len(batch), np.int64), np.zeros(len(batch))
            if known.any():
                words, codes, first = _words(texts)
                per_word = m.log_probs(words)
                sums = np.zeros((len(codes) + 1, len(m.languages)))
                np.cumsum(per_word[codes], axis=0, out=sums[1:])
                total = sums[first[1:]] - sums[first[:-1]]
                best = total.argmax(axis=1)
                sure = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
            names = [m.languages[b] if k else "und" for b, k in zip(best, known)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(keep))), pa.array(names, pa.string()), pa.array(np.where(known, sure, 0.0), pa.float64())],
                names=[*keep, "lang_pred", "score"],
            )

    return df.mapInArrow(run, shape)
