"""LM scoring by deleted interpolation.

The probability of a word after its context mixes three estimates: the
maximum-likelihood bigram, the maximum-likelihood unigram and a uniform one
over the vocabulary and one unknown word.  The mixture weights depend on how
often the context was seen (one bucket per power of two) and are learned by
expectation-maximisation on held-out counts: a tenth of the training texts,
chosen by a hash of the text so that copies stay together, is deleted from
the counts and predicted from the rest.  The final estimates use the counts
of all training texts.

Execution, with counts of the whole corpus and no table of it in one place:

1. the scan packs documents into blocks (about ``block_bytes`` of text):
   distinct words, and the text as word numbers; written once;
2. each block sends its distinct words and bigrams, already counted, to
   ``fan`` buckets of their hash, so a frequent word weighs as much as a rare
   one.  A node is the bucket of ``fan`` blocks; it adds their counts up and
   sends the sums on to ``fan`` finer buckets of ``fan`` times as many blocks,
   and so on until one node has a bucket of all blocks.  Every level has
   ``fan`` rows a block of the level below at most, whatever the corpus, and a
   node holds about as much as one block;
3. totals go back down the same tree: each node answers its senders in the
   order in which they asked;
4. a block meets its answers again: first the held-out blocks, for a bounded
   table of (context bucket, rounded estimates) from which the weights are
   learned, then all blocks, for the scores.

Words are compared as themselves; bigrams by a 64-bit hash, so two of them
share a count with probability of about their number squared over 2^65.

Defined results: a null text is empty and holds the end token alone; without
training texts every score is 0; contexts of a bucket without held-out
tokens take the weights of all buckets together; rows with equal ids each
give a row; extra columns are ignored; a text longer than a block is a block
of its own, held whole in one task (about 60 bytes a byte of text).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trainprep.llm import textbytes as tb
from trainprep.llm.common import staged

BLOCK_BYTES = 4 << 20
FAN = 512
BUCKETS = 48  # of context frequency
END = 0  # number of the end token; words count from 1
_BLOCK = (
    "block long, held boolean, ids array<long>, sizes binary, train binary, words binary, codes binary"
)
_END_HASH = np.uint64(0x51ED270B7A1F39D5)


def _squeeze(values: np.ndarray) -> bytes:
    """Integers as compressed byte planes."""
    import zstandard

    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.compress(np.ascontiguousarray(planes).tobytes(), 1)


def _expand(blob: bytes, kind) -> np.ndarray:
    import zstandard

    raw = np.frombuffer(zstandard.decompress(blob), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).reshape(-1).view(kind)


def _blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """One row per block of documents; held-out training texts apart."""

    def pack(block: int, held: bool, batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        import zstandard

        table = pa.Table.from_batches(batches).combine_chunks()
        data, offsets = tb.buffer_of(table["text"])
        low = tb.LOWER[data]
        starts, ends, first = tb.words_in(low, offsets, ~tb.SPACES[low])
        words = tb.gather(low, starts, ends).dictionary_encode()
        sizes = np.diff(first) + 1
        codes = np.zeros(len(starts) + len(sizes), np.uint32)
        at = np.arange(len(starts)) + np.repeat(np.arange(len(sizes)), sizes - 1)
        codes[at] = words.indices.to_numpy(zero_copy_only=False) + 1
        cells = [
            pa.array([block]), pa.array([held]), pa.array([table["id"].to_pylist()], pa.list_(pa.int64())),
            *(pa.array([x], pa.binary()) for x in (
                sizes.astype("<i8").tobytes(), table["train"].to_numpy().astype(bool).tobytes(),
                zstandard.compress(b"\n".join(words.dictionary.to_pylist()), 1), _squeeze(codes))),
        ]
        return pa.RecordBatch.from_arrays(cells, names=[c.split()[0] for c in _BLOCK.split(", ")])

    def run(batches):
        import pyarrow.compute as pc
        from pyspark import TaskContext

        from trainprep.llm.common import byte_lengths, sliced

        block = TaskContext.get().partitionId() << 32
        parts: dict[bool, list] = {False: [], True: []}
        weight = {False: 0, True: 0}
        for whole in sliced(batches, 1, block_bytes):
            for held in (False, True):
                batch = whole.filter(pc.equal(whole.column(3), held))
                if batch.num_rows:
                    parts[held].append(batch)
                    weight[held] += int(byte_lengths(batch.column(1)).sum())
                if weight[held] >= block_bytes:
                    yield pack(block, held, parts[held])
                    block, parts[held], weight[held] = block + 1, [], 0
        for held, rows in parts.items():
            if rows:
                yield pack(block, held, rows)
                block += 1

    return docs.mapInArrow(run, _BLOCK)


def _word_hashes(words: list[bytes]) -> np.ndarray:
    """The empty word stands for the end token."""
    lengths = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(lengths)
    out = tb.span_hash(tb.prefix_hash(np.frombuffer(b"".join(words), np.uint8)), ends - lengths, ends)
    out[lengths == 0] = _END_HASH
    return out


def _by_hash(hashes: np.ndarray, words: list[bytes]) -> np.ndarray:
    """Order by hash; words of one hash by themselves."""
    order = np.argsort(hashes, kind="stable")
    if (hashes[order[1:]] == hashes[order[:-1]]).any():
        order = np.array(sorted(order.tolist(), key=lambda i: (int(hashes[i]), words[i])), np.int64)
    return order


class Block:
    """A block opened: hashes and order of its words and bigrams."""

    def __init__(self, row: dict) -> None:
        import zstandard

        raw = zstandard.decompress(row["words"])
        self.words = raw.split(b"\n") if raw else []
        self.sizes = np.frombuffer(row["sizes"], "<i8")
        self.train = np.frombuffer(row["train"], bool)
        self.codes = _expand(row["codes"], np.uint32).astype(np.int64)
        self.hashes = _word_hashes([b"", *self.words])
        self.order = _by_hash(self.hashes, [b"", *self.words])  # answers come in this order
        first = np.cumsum(self.sizes) - self.sizes
        before = np.empty_like(self.codes)
        before[1:] = self.codes[:-1]
        before[first] = END  # an end token stands before every text
        self.first, self.before = first, before
        pair = tb.mix64(self.hashes[before] * np.uint64(0x9E3779B97F4A7C15) + self.hashes[self.codes])
        self.pairs, self.pair_of = np.unique(pair, return_inverse=True)
        self.counted = np.repeat(self.train, self.sizes)


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Ascending in the hash."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


_REQUEST = "node long, bucket long, child long, wants boolean, kind int, keys binary, total binary, held binary"
_ANSWER = "child long, bucket long, kind int, total binary, kept binary, n long, v long, n_kept long, v_kept long"
_KINDS = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}


class _Rows:
    """Rows of a schema, gathered by name."""

    def __init__(self, schema: str) -> None:
        self.shape = [c.split() for c in schema.split(", ")]
        self.cells: dict[str, list] = {n: [] for n, _ in self.shape}

    def add(self, **row) -> None:
        for n, column in self.cells.items():
            column.append(row.get(n))

    def arrays(self) -> dict[str, pa.Array]:
        return {n: pa.array(self.cells[n], _KINDS[t]) for n, t in self.shape}


def _ask(out: _Rows, kind: int, hashes: np.ndarray, keys, total: np.ndarray, held: np.ndarray | None, buckets: int, first: int, fan: int, **row) -> None:
    """A row for every bucket in use of entries in the order of their hash;
    ``first`` and ``buckets`` give the buckets that they can fall into."""
    import zstandard

    cuts = np.searchsorted(_bucket(hashes, buckets), np.arange(first, first + fan + 1))
    for k, (i, j) in enumerate(zip(cuts, cuts[1:])):
        if i < j:
            blob = zstandard.compress(b"\n".join(keys[i:j]), 1) if kind == 1 else _squeeze(np.diff(hashes[i:j], prepend=np.uint64(0)))
            own = None if held is None or not held[i:j].any() else _squeeze(held[i:j])
            out.add(bucket=first + k, kind=kind, keys=blob, total=_squeeze(total[i:j]), held=own, **row)


def _requests(blocks: DataFrame, nodes: int, fan: int) -> DataFrame:
    """What each block holds, for ``nodes`` groups of blocks."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                b = Block(row)
                words = [b"", *b.words]
                n_word = np.bincount(b.codes[b.counted], minlength=len(words))[b.order]
                n_pair = np.bincount(b.pair_of[b.counted], minlength=len(b.pairs))
                out = _Rows(_REQUEST)
                name = {"node": int(tb.mix64(np.array([row["block"]], np.uint64))[0] % np.uint64(nodes)), "child": row["block"], "wants": row["held"]}
                for kind, hashes, keys, n in ((1, b.hashes[b.order], [words[c] for c in b.order], n_word), (2, b.pairs, None, n_pair)):
                    _ask(out, kind, hashes, keys, n, n if row["held"] else None, fan, 0, fan, **name)
                yield pa.RecordBatch.from_pydict(out.arrays())

    return blocks.mapInArrow(run, _REQUEST)


def _merged(table: pa.Table):
    """For each kind: its requests by child, the entry of each of their keys,
    the entries' hashes (ascending) and words, totals and held-out counts."""
    import zstandard

    rows = sorted(table.to_pylist(), key=lambda r: (r["kind"], r["child"]))
    for kind in (1, 2):
        own = [r for r in rows if r["kind"] == kind]
        if not own:
            continue
        counts = [_expand(r["total"], np.int64) for r in own]
        if kind == 1:
            coded = pa.array([w for r in own for w in zstandard.decompress(r["keys"]).split(b"\n")], pa.binary()).dictionary_encode()
            words, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
            hashes = _word_hashes(words)
            order = _by_hash(hashes, words)
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            words, hashes, codes = [words[i] for i in order], hashes[order], place[codes]
        else:
            words = None
            hashes, codes = np.unique(np.concatenate([np.cumsum(_expand(r["keys"], np.uint64)) for r in own]), return_inverse=True)
        total = np.zeros(len(hashes), np.int64)
        np.add.at(total, codes, np.concatenate(counts))
        held = np.zeros(len(hashes), np.int64)
        every = [np.zeros(len(c), np.int64) if r["held"] is None else _expand(r["held"], np.int64) for r, c in zip(own, counts)]
        np.add.at(held, codes, np.concatenate(every))
        yield kind, own, np.split(codes, np.cumsum([len(c) for c in counts])[:-1]), hashes, words, total, held


def _sums_up(buckets: int, nodes: int, fan: int):
    """A node's sums as requests to the level above."""

    def run(table: pa.Table) -> pa.Table:
        out = _Rows(_REQUEST)
        node, bucket = table["node"][0].as_py(), table["bucket"][0].as_py()
        for kind, _, _, hashes, words, total, held in _merged(table):
            _ask(out, kind, hashes, words, total, held, buckets, bucket * fan, fan, node=node % nodes, child=node, wants=True)
        return pa.table(out.arrays())

    return run


def _reply(out: _Rows, kind: int, own: list[dict], parts: list[np.ndarray], total: np.ndarray, kept: np.ndarray) -> None:
    for r, part in zip(own, parts):
        out.add(child=r["child"], bucket=r["bucket"], kind=kind, total=_squeeze(total[part]), kept=_squeeze(kept[part]) if r["wants"] else None)


def _totals(table: pa.Table) -> pa.Table:
    """The last level: totals in the order of each request; one row more with
    the sums over the words."""
    out = _Rows(_ANSWER)
    for kind, own, parts, _, _, total, held in _merged(table):
        kept = total - held
        if kind == 1:
            out.add(child=-1, n=int(total.sum()), v=int((total > 0).sum()), n_kept=int(kept.sum()), v_kept=int((kept > 0).sum()))
        _reply(out, kind, own, parts, total, kept)
    return pa.table(out.arrays())


def _passed_down(asked: pa.Table, answers: pa.Table) -> pa.Table:
    """A node's answers, in the order of its sums, dealt out to its senders."""
    out = _Rows(_ANSWER)
    if asked.num_rows:
        rows = sorted(answers.to_pylist(), key=lambda r: (r["kind"], r["bucket"]))
        for kind, own, parts, *_ in _merged(asked):
            total, kept = (np.concatenate([_expand(r[c], np.int64) for r in rows if r["kind"] == kind]) for c in ("total", "kept"))
            _reply(out, kind, own, parts, total, kept)
    return pa.table(out.arrays())


def _counted(blocks: DataFrame, n_blocks: int, fan: int) -> tuple[DataFrame, tuple[int, ...]]:
    """Answers to every block, and the sums over the words."""
    levels = 1
    while fan**levels < n_blocks:
        levels += 1
    nodes = [max(1, -(-n_blocks // fan**k)) for k in range(1, levels + 1)]
    asked = [_requests(blocks, nodes[0], fan)]
    for k in range(1, levels):
        asked[-1] = staged(asked[-1], "lm-asked")
        asked.append(asked[-1].groupBy("node", "bucket").applyInArrow(_sums_up(fan ** (k + 1), nodes[k], fan), _REQUEST))
    answers = staged(asked.pop().groupBy("node", "bucket").applyInArrow(_totals, _ANSWER), "lm-answers")
    sums = answers.where("child = -1").agg(*[F.sum(c) for c in ("n", "v", "n_kept", "v_kept")]).first()
    while asked:
        above = answers.where("child >= 0").select("child", "bucket", "kind", "total", "kept", F.col("child").alias("node"), F.floor(F.col("bucket") / fan).cast("long").alias("of"))
        answers = staged(asked.pop().groupBy("node", "bucket").cogroup(above.groupBy("node", "of")).applyInArrow(_passed_down, _ANSWER), "lm-answers")
    own = answers.where("child >= 0").select(F.col("child").alias("block"), "bucket", "kind", "total", "kept")
    return own, tuple(int(x or 0) for x in sums)


def _counts(b: Block, answers: pa.Table, column: str) -> tuple[np.ndarray, np.ndarray]:
    """Corpus counts of each word number and of each distinct bigram."""
    rows = sorted(answers.select(["kind", "bucket", column]).to_pylist(), key=lambda r: (r["kind"], r["bucket"]))
    got = {k: [_expand(r[column], np.int64) for r in rows if r["kind"] == k] for k in (1, 2)}
    word = np.zeros(len(b.words) + 1, np.int64)
    word[b.order] = np.concatenate(got[1])
    return word, np.concatenate(got[2])


def context_bucket(count: np.ndarray) -> np.ndarray:
    """0 for unseen contexts, else one per power of two."""
    return np.where(count > 0, np.minimum(np.log2(np.maximum(count, 1)).astype(np.int64) + 1, BUCKETS - 1), 0)


def estimates(word: np.ndarray, pair: np.ndarray, b: Block, n: int, v: int):
    """Context bucket, bigram, unigram and uniform estimate of every token."""
    context = word[b.before]
    p2 = np.where(context > 0, pair[b.pair_of] / np.maximum(context, 1), 0.0)
    return context_bucket(context), p2, word[b.codes] / max(n, 1), 1.0 / (v + 1)


def learn_weights(table: np.ndarray, uniform: float, rounds: int = 40) -> np.ndarray:
    """EM over rows (bucket, bigram, unigram estimate, tokens): a row of
    three weights per bucket and, last, for all together."""
    bucket = table[:, 0].astype(np.int64)
    parts = np.stack([table[:, 1], table[:, 2], np.full(len(table), uniform)], axis=1)
    count = table[:, 3]
    weights = np.full((BUCKETS + 1, 3), 1 / 3)
    for _ in range(rounds):
        for own, at in ((bucket, slice(0, BUCKETS)), (np.full(len(bucket), BUCKETS), slice(BUCKETS, BUCKETS + 1))):
            share = weights[own] * parts
            share *= (count / share.sum(axis=1))[:, None]
            total = np.stack([np.bincount(own, share[:, i], BUCKETS + 1) for i in range(3)], axis=1)[at]
            seen = total.sum(axis=1) > 0
            weights[at][seen] = total[seen] / total[seen].sum(axis=1, keepdims=True)
    without = ~np.isin(np.arange(BUCKETS), bucket)
    weights[:BUCKETS][without] = weights[BUCKETS]
    weights = np.maximum(weights, 1e-6)
    weights[0, 0] = 0.0  # an unseen context has no bigram estimate
    return weights / weights.sum(axis=1, keepdims=True)


STEPS_PER_OCTAVE = 4


def score(docs: DataFrame, is_training: Column, id_col: str = "doc_id", text_col: str = "text", held_share: int = 10, block_bytes: int = BLOCK_BYTES, fan: int = FAN) -> DataFrame:
    """id, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and
    ``score`` (log10), one row per row of ``docs``."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    train = F.coalesce(is_training, F.lit(False))
    held = train & (F.pmod(F.xxhash64(text), F.lit(held_share)) == 0)
    blocks = staged(_blocks(docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), train.alias("train"), held.alias("held")), block_bytes), "lm-blocks")
    own, (n, v, n_kept, v_kept) = _counted(blocks, blocks.select("block").count(), fan)

    def histogram(block: pa.Table, answer: pa.Table) -> pa.Table:
        b = Block(block.to_pylist()[0])
        bucket, p2, p1, _ = estimates(*_counts(b, answer, "kept"), b, n_kept, v_kept)
        with np.errstate(divide="ignore"):
            q2, q1 = (np.where(p > 0, np.round(STEPS_PER_OCTAVE * np.log2(np.maximum(p, 1e-300))), 1).astype(np.int64) for p in (p2, p1))
        key, count = np.unique(np.stack([bucket, q2, q1]), axis=1, return_counts=True)
        return pa.table({"bucket": key[0], "q2": key[1], "q1": key[2], "n": count})

    held_blocks = blocks.where("held").groupBy("block").cogroup(own.where("kept is not null").groupBy("block"))
    cells = held_blocks.applyInArrow(histogram, "bucket long, q2 long, q1 long, n long").groupBy("bucket", "q2", "q1").agg(F.sum("n").alias("n"))
    cells = cells.toPandas()[["bucket", "q2", "q1", "n"]].to_numpy(dtype=float)  # bounded by the rounding, not by the corpus
    for c in (1, 2):  # 1 marks an estimate of zero
        cells[:, c] = np.where(cells[:, c] == 1, 0.0, 2.0 ** (cells[:, c] / STEPS_PER_OCTAVE))
    weights = learn_weights(cells, 1.0 / (v_kept + 1)) if n else np.tile([0.0, 0.0, 1.0], (BUCKETS + 1, 1))
    shape = "id long, n_tokens long, n_known long, base_score double, score double"

    def scored(block: pa.Table, answer: pa.Table) -> pa.Table:
        row = block.to_pylist()[0]
        b = Block(row)
        word, pair = _counts(b, answer, "total")
        bucket, p2, p1, p0 = estimates(word, pair, b, n, v)
        w = weights[bucket]
        logs = np.log10(w[:, 0] * p2 + w[:, 1] * p1 + w[:, 2] * p0)
        seen = word[b.codes]
        base = np.log10((seen + 1) / (n + v + 1))
        return pa.table({
            "id": pa.array(row["ids"], pa.int64()), "n_tokens": b.sizes, "n_known": np.add.reduceat((seen > 0).astype(np.int64), b.first),
            "base_score": np.add.reduceat(base, b.first), "score": np.add.reduceat(logs, b.first),
        })

    out = blocks.groupBy("block").cogroup(own.groupBy("block")).applyInArrow(scored, shape)
    return out.select(F.col("id").alias(id_col), "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")
