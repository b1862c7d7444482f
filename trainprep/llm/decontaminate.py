"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact check.

A document is contaminated by an item when some passage of it is within
``floor((1 - similarity) * words)`` word edits of the whole item.

The CGK random walk turns edit distance into Hamming distance: reading step
j of the walk outputs the word under the cursor, and a random bit drawn
from (j, that word) says whether the cursor moves on.  Two passages that
differ by few edits walk together again soon after each edit.  For every
start word of a document (an item-sized window) and for ``anchors`` starts
spread over each item, a signature samples ``samples`` steps of the walk; equal
signatures make a candidate.  ``repeats`` independent walks and samples
reach the recall.  An item under ``SHORT`` words has too few starts for that,
so beside its walks it is cut in one run of words more than the edits it
allows, one of which every such passage holds unchanged: all of its passages
are candidates.  (An item that allows no edit is one run and needs no walk.)
Every candidate is decided by an exact edit distance on the words themselves.

Windows of all documents are walked by numpy inside the tasks that scan
them, without a shuffle.  The index of the items is broadcast: its size is
checked against ``max_index_bytes``, and a larger benchmark is matched in
several passes, each over a part of the items that fits; what a pass finds is
written before the next one starts, so one index is alive at a time.

Words are runs of letters, marks and numbers in lower case, and single
characters in scripts written without spaces (``textbytes.unicode_words``).  A
text is held whole by one task, in batches of 1 MiB of shorter ones.  Defined results: a
null or empty text is clean; an item without a word matches nothing; equal
items are all reported; rows with equal ids each give a row; extra columns
are ignored; no items leave every document clean.
"""

from __future__ import annotations

import random

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trainprep.llm import textbytes as tb
from trainprep.llm.common import parts_for, sliced, staged

STEPS = (12, 6, 3, 1)  # a walk reads no further than the item goes on
SHORT = 32  # words
WORD = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]|[\p{L}\p{M}\p{N}]+"


def edit_distance_within(item: list, region: list, limit: int) -> int | None:
    """Smallest number of word edits between ``item`` and any passage of
    ``region``, or None if it is over ``limit``."""
    row = [0] * (len(region) + 1)
    for i, a in enumerate(item, 1):
        left, new = i, [i]
        for j, b in enumerate(region):
            left = min(row[j] + (a != b), row[j + 1] + 1, left + 1)
            new.append(left)
        row = new
        if min(row) > limit:
            return None
    best = min(row)
    return best if best <= limit else None


def _walk_plan(repeats: int, samples: int, seed: int) -> list[tuple[list[int], dict[int, list[int]]]]:
    """Per repeat: the bit of a word's hash that moves the cursor at each
    step, and the sampled steps for each walk length."""
    rng = random.Random(seed)
    plan = []
    for _ in range(repeats):
        moves = [rng.randrange(64) for _ in range(max(STEPS))]
        plan.append((moves, {n: sorted(rng.sample(range(n), min(samples, n))) for n in STEPS}))
    return plan


def _signatures(words, starts, moves, sampled, repeat):
    """For each walk length: the signature of the walk from every start;
    ``words`` goes on for the longest walk after the last start."""
    import numpy as np

    last = max(sampled)
    cursor = starts.copy()
    out = {n: np.full(len(starts), np.uint64(0x9E37 + 977 * repeat + n), np.uint64) for n in sampled}
    factor = np.uint64(0x9E3779B97F4A7C15)
    for step in range(last):
        here = words[cursor]
        for n, steps in sampled.items():
            if step in steps:
                np.bitwise_xor(out[n], here, out=out[n])
                np.multiply(out[n], factor, out=out[n])
        if step + 1 < last:
            here >>= np.uint64(moves[step])
            here &= np.uint64(1)
            cursor += here.view(np.int64)
    return out


def _runs(words, starts, widths):
    """For each width: a hash of the run of words from every start."""
    import numpy as np

    sig, out = np.full(len(starts), np.uint64(0x5EED), np.uint64), {}
    for n in range(1, max(widths, default=0) + 1):
        np.bitwise_xor(sig, words[starts + (n - 1)], out=sig)
        np.multiply(sig, np.uint64(0x9E3779B97F4A7C15), out=sig)
        if n in widths:
            out[n] = tb.mix64(sig)
    return out


def _table(sig, item, off):
    """Signatures in order with their items and offsets, and a bitmap."""
    import numpy as np

    order = np.argsort(sig)
    bitmap = np.zeros(1 << 18, bool)
    bitmap[(sig >> np.uint64(46)).astype(np.int64)] = True
    return sig[order], item[order], off[order], bitmap


def _widest(words, starts, item, off, moves, steps, anchors):
    """Up to ``anchors`` starts of each item: those whose sample reads the
    most different words, as a walk that stands still matches by chance;
    equal ones are spread over the item."""
    import numpy as np

    cursor, seen = starts.copy(), []
    for step in range(max(steps) + 1):
        if step in steps:
            seen.append(words[cursor])
        cursor += ((words[cursor] >> np.uint64(moves[step])) & np.uint64(1)).view(np.int64)
    ranked = np.sort(np.stack(seen, axis=1), axis=1)
    distinct = 1 + (ranked[:, 1:] != ranked[:, :-1]).sum(axis=1)
    order = np.lexsort((off * 0.6180339887 % 1, -distinct, item))
    place = np.arange(len(order)) - np.searchsorted(item[order], item[order])
    return np.sort(order[place < anchors])


def _prepare(texts: list[str]) -> list[list[bytes]]:
    low, starts, ends, first = tb.unicode_words(pa.array(texts, pa.string()))
    raw = low.tobytes()
    return [[raw[s:e] for s, e in zip(starts[a:b], ends[a:b])] for a, b in zip(first, first[1:])]


class ItemIndex:
    """Signatures of the items, sorted, with a bitmap that refuses most
    windows at once."""

    def __init__(self, ids: list[int], texts: list[str], similarity: float, repeats: int, samples: int, anchors: int, seed: int) -> None:
        import numpy as np

        self.plan = _walk_plan(repeats, samples, seed)
        self.ids, self.words, self.limits = [], [], []
        for item, words in zip(ids, _prepare(texts)):
            if words:
                self.ids.append(item)
                self.words.append(words)
                self.limits.append(int((1 - similarity) * len(words) + 1e-9))
        where: dict[int, list[tuple[int, int, int]]] = {}  # walk length: (word position, item, offset)
        runs: dict[int, list[tuple[int, int, int]]] = {}  # width: the same
        base, flat = 0, []
        for k, words in enumerate(self.words):
            parts = min(self.limits[k] + 1, len(words))
            cuts = [len(words) * i // parts for i in range(parts + 1)]
            for off, end in zip(cuts, cuts[1:]) if len(words) < SHORT else ():
                runs.setdefault(end - off, []).append((base + off, k, off))
            for off in range(len(words)) if self.limits[k] or len(words) >= SHORT else ():
                # short walks only where an item has no room for a longer one
                longest = next(n for n in STEPS if n <= len(words) - off)
                if longest == next(n for n in STEPS if n <= len(words)):
                    where.setdefault(longest, []).append((base + off, k, off))
            flat += words
            base += len(words)
        self.lengths = sorted(where)
        hashes = np.append(word_hashes(flat), np.zeros(max(STEPS), np.uint64))
        self.runs = {}
        for n in sorted(runs):
            at, item, off = (np.array(x, np.int64) for x in zip(*runs[n]))
            self.runs[n] = _table(_runs(hashes, at, [n])[n], item, off)
        self.tables = []
        for r, (moves, sampled) in enumerate(self.plan):
            row = {}
            for n in self.lengths:
                at, item, off = (np.array(x, np.int64) for x in zip(*where[n]))
                best = _widest(hashes, at, item, off, moves, sampled[n], anchors)
                at, item, off = at[best], item[best], off[best]
                sig = _signatures(hashes, at, moves, {n: sampled[n]}, r)[n]
                row[n] = _table(sig, item, off)
            self.tables.append(row)

    def nbytes(self) -> int:
        return sum(len(w) + 60 for ws in self.words for w in ws) + sum(a.nbytes for t in [*self.tables, self.runs] for e in t.values() for a in e)


def word_hashes(words: list[bytes]):
    import numpy as np

    joined = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words]) if words else np.empty(0, np.int64)
    starts = ends - np.array([len(w) for w in words], np.int64)
    return tb.span_hash(tb.prefix_hash(joined), starts, ends)


def _matches(index: ItemIndex, texts: pa.Array) -> list[dict[int, int]]:
    """Per text: {item id: word edits}."""
    import numpy as np

    found: list[dict[int, int]] = [{} for _ in range(len(texts))]
    low, starts, ends, first = tb.unicode_words(texts)
    if not len(starts) or not index.ids:
        return found
    longest = max([*index.lengths, *index.runs])
    hashes = np.append(tb.span_hash(tb.prefix_hash(low), starts, ends), np.zeros(longest, np.uint64))
    tried: set[tuple[int, int, int]] = set()
    block = 1 << 15  # windows at a time: the arrays stay in the cache
    for at in range(0, len(starts), block):
        near = hashes[at : at + block + longest]
        here = np.arange(min(block, len(starts) - at))
        looked = [(sig, index.runs[n]) for n, sig in _runs(near, here, index.runs).items()]
        for r, (moves, sampled) in enumerate(index.plan if index.lengths else ()):
            sigs = _signatures(near, here, moves, {n: sampled[n] for n in index.lengths}, r)
            looked += [(sig, index.tables[r][n]) for n, sig in sigs.items()]
        for sig, (known, items, offs, bitmap) in looked:
            maybe = np.flatnonzero(bitmap[(sig >> np.uint64(46)).view(np.int64)])
            lo = np.searchsorted(known, sig[maybe], "left")
            hi = np.searchsorted(known, sig[maybe], "right")
            hit = hi > lo
            for p, a, b in zip((maybe[hit] + at).tolist(), lo[hit].tolist(), hi[hit].tolist()):
                doc = int(np.searchsorted(first, p, "right")) - 1
                tried.update((doc, int(items[c]), p - int(offs[c])) for c in range(a, b))
    raw = low.tobytes()
    for doc, k, begin in sorted(tried):
        words, limit = index.words[k], index.limits[k]
        best = found[doc].get(index.ids[k])
        if best == 0:
            continue
        a = max(int(first[doc]), begin - limit)
        b = min(int(first[doc + 1]), begin + len(words) + limit)
        region = [raw[s:e] for s, e in zip(starts[a:b].tolist(), ends[a:b].tolist())]
        own = set(words)
        if sum(w in own for w in region) < len(words) - limit:
            continue
        edits = edit_distance_within(words, region, limit)
        if edits is not None and (best is None or edits < best):
            found[doc][index.ids[k]] = edits
    return found


def contamination(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
    similarity: float = 0.8, repeats: int = 3, samples: int = 5, anchors: int = 16, seed: int = 7,
    max_index_bytes: int = 64 << 20, extra: list[str] | None = None,
) -> DataFrame:
    """``docs``'s id and ``extra`` columns with ``contaminated boolean``,
    ``item_ids array<long>`` (ascending) and ``edits array<int>`` (the
    fewest word edits of each), one row per row."""
    spark = docs.sparkSession
    keep = [id_col, *(extra or [])]
    out = docs.select(*keep, text_col) if text_col not in keep else docs.select(*keep)
    out = out.withColumn("_hits", F.array().cast("array<struct<item:long,edits:int>>"))
    rows = items.select(F.col(item_id).cast("long").alias("i"), F.col(item_text).cast("string").alias("t"))
    rows = rows.where(F.col("i").isNotNull() & F.col("t").isNotNull())
    # bytes of an item in the index: its words as objects, its runs, the signatures of its starts
    n_words = F.regexp_count("t", F.lit(WORD))
    cost = F.octet_length("t") + 110 * n_words + 24 * repeats * F.least(n_words, F.lit(anchors))
    rows = rows.distinct()
    passes = parts_for(int(rows.agg(F.sum(cost)).first()[0] or 0), max_index_bytes)
    for p in range(passes):
        got = rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(passes)) == p).orderBy("i", "t").collect()
        if not got:
            continue
        if p:
            out = staged(out, "hits")
        index = ItemIndex([r[0] for r in got], [r[1] for r in got], similarity, repeats, samples, anchors, seed)
        out = _pass(out, text_col, spark.sparkContext.broadcast(index))
    hits = F.array_sort("_hits")
    out = out.withColumn("item_ids", F.transform(hits, lambda h: h["item"])).withColumn("edits", F.transform(hits, lambda h: h["edits"]))
    return out.select(*keep, (F.size("_hits") > 0).alias("contaminated"), "item_ids", "edits")


def _pass(df: DataFrame, text_col: str, shared) -> DataFrame:
    names = df.columns
    body, hits = names.index(text_col), names.index("_hits")
    kind = pa.list_(pa.struct([("item", pa.int64()), ("edits", pa.int32())]))

    def run(batches):
        for batch in sliced(batches, body, 1 << 20):
            merged = []
            for old, new in zip(batch.column(hits).to_pylist(), _matches(shared.value, batch.column(body))):
                best = {e["item"]: e["edits"] for e in old}
                for i, e in new.items():
                    best[i] = min(e, best.get(i, e))
                merged.append([{"item": i, "edits": e} for i, e in sorted(best.items())])
            arrays = [batch.column(i) for i in range(len(names))]
            arrays[hits] = pa.array(merged, kind)
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return df.mapInArrow(run, df.schema)
