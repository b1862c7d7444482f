"""Document fingerprints by locally consistent parsing.

A text is a sequence of names, at first its code points.  Each round joins
neighbouring names into phrases and names the phrases, until one is left:

1. runs of one name become one name with its length, so that neighbours
   always differ;
2. deterministic coin tossing: a name's colour is the place of the lowest bit
   in which it differs from the name before it, with that bit's value; three
   more tosses on the colours leave six of them, and neighbours still differ;
3. a phrase begins at every colour above both its neighbours', so a phrase
   has two names at least, and where it begins depends on a few names around;
4. its new name is a 64-bit hash of the names in it, in order.

Equal substrings are therefore cut and named alike but for a few phrases at
their ends, wherever they stand.  Names carry no round, no place and no text.
The last name stands for the whole text: texts are equal if and only if their
last names are (but for chance, 2^-64 a pair).

The fingerprint is that last name and the ``SKETCH`` least of the text's
phrase names from round ``ROUND`` on, hashed to 32 bits: a uniform sample of the
set of all of them.  The likeness of two fingerprints estimates the share of
phrases that they have in common (exactly, where neither has more than
``SKETCH`` in all).  A text that is one phrase soon starts ``BEFORE_LAST`` rounds
before that instead.

Texts are parsed a batch at a time by numpy, ``CHUNK`` names of a round at
once with the few names around them, so the memory beside the text is about
20 bytes a character of the longest one.

Defined results: a null text is empty; the empty text has the name 0; equal
ids follow each other by the hash of their text, then by the text, and null
ids come last; a table of one row is its own next document; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trainprep.llm.common import sliced, staged
from trainprep.llm.textbytes import mix64

SKETCH = 64
ROUND = 2
BEFORE_LAST = 2
CHUNK = 1 << 18
TOSSES = 4
SIDE = TOSSES + 2  # names before and after that decide where a phrase begins
BATCH = 2 << 20  # bytes of text parsed at once
_ODD = np.uint64(0x9E3779B97F4A7C15)
_RUN = np.uint64(0xD6E8FEB86659FD93)
_WEIGHTS = mix64(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)  # by the place in a phrase; one holds far fewer names
_POINTS: list[np.ndarray] = []


def _tossed(size: int) -> np.ndarray:
    """Colour after one toss, by a colour and the one before it."""
    own, before = np.arange(size)[:, None], np.arange(size)[None, :]
    low = (own ^ before) & -(own ^ before)
    place = np.log2(np.maximum(low, 1)).astype(np.int64)
    return (2 * place + ((own & low) != 0)).astype(np.uint8).ravel()


_BY_COLOUR = _tossed(128)


def _toss(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Colours below 6, neighbours in a text unequal.  The first name of a
    text (``first``) is tossed as if the one before it differed in the lowest
    bit."""
    before = np.empty_like(names)
    before[1:] = names[:-1]
    before[first] = names[first] ^ np.uint64(1)
    before[0] = names[0] ^ np.uint64(1)
    low = names ^ before
    low &= ~low + np.uint64(1)
    colour = np.bitwise_count(low - np.uint64(1))
    colour <<= np.uint8(1)
    colour |= (names & low) != 0
    for _ in range(TOSSES - 1):
        pair = colour.astype(np.uint16) << np.uint16(7)
        pair[1:] |= colour[:-1]
        at_edge = colour[first]
        pair[first] = (at_edge.astype(np.uint16) << np.uint16(7)) | (at_edge ^ np.uint8(1))
        pair[0] = (np.uint16(colour[0]) << np.uint16(7)) | np.uint16(colour[0] ^ np.uint8(1))
        colour = _BY_COLOUR[pair]
    return colour


def _starts(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where phrases begin, in a sequence whose neighbours differ."""
    n = len(names)
    out = np.zeros(n, bool)
    for at in range(0, n, CHUNK):
        a, b = max(0, at - SIDE), min(n, at + CHUNK + SIDE)
        edge = first[a:b]
        colour = _toss(names[a:b], np.flatnonzero(edge))
        rise = np.ones(len(colour), bool)
        rise[1:] = colour[1:] > colour[:-1]
        fall = np.zeros(len(colour), bool)  # the last name of a text never begins a phrase
        fall[:-1] = (colour[:-1] > colour[1:]) & ~edge[1:]
        rise &= fall
        # the second name of a text neither: a phrase has two names at least
        rise[1:] &= ~edge[:-1]
        rise |= edge
        out[at : min(n, at + CHUNK)] = rise[at - a : min(n, at + CHUNK) - a]
    return out


def _first_names(points: np.ndarray) -> np.ndarray:
    if not _POINTS:
        _POINTS.append(mix64(np.arange(1, 0x110001, dtype=np.uint64)))
    return _POINTS[0][points]


def _runs(names: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray | None, np.ndarray]:
    """(names, places, first): runs of one name joined into one; no places
    where there is no such run."""
    new = first.copy()
    new[1:] |= names[1:] != names[:-1]
    if new.all():
        return names, None, first
    at = np.flatnonzero(new)
    length = np.diff(at, append=len(names))
    joined = names[at]
    longer = np.flatnonzero(length > 1)
    joined[longer] = mix64(joined[longer] * _RUN + length[longer].astype(np.uint64))
    return joined, at, first[at]


def _join(names: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Name of each phrase; ``at`` are the places where they begin.  A phrase
    of one name keeps it."""
    out = np.empty(len(at), np.uint64)
    ends = np.append(at[1:], len(names))
    i = 0
    while i < len(at):
        j = max(i + 1, int(np.searchsorted(at, at[i] + CHUNK)))
        a, b = at[i], ends[j - 1]
        size = ends[i:j] - at[i:j]
        place = np.arange(a, b) - np.repeat(at[i:j], size)
        weighed = names[a:b] * _WEIGHTS[np.minimum(place, len(_WEIGHTS) - 1)]
        out[i:j] = mix64(np.add.reduceat(weighed, at[i:j] - a) + size.astype(np.uint64))
        i = j
    single = ends - at == 1
    out[single] = names[at[single]]
    return out


def rounds(points: np.ndarray, sizes: np.ndarray, places: bool = True):
    """Yields ``(names, place, sizes)`` for each round over texts side by
    side: the phrases' names, the code point at which each begins (if asked
    for) and the number of phrases of each text.  A text of one phrase keeps
    it."""
    names = _first_names(points)
    place = np.arange(len(points)) if places else None
    sizes = np.asarray(sizes, np.int64)
    while True:
        yield names, place, sizes
        if not len(sizes) or sizes.max() <= 1:
            return
        text = np.flatnonzero(sizes)
        first = np.zeros(len(names), bool)
        first[(np.cumsum(sizes) - sizes)[text]] = True
        names, run, first = _runs(names, first)
        at = np.flatnonzero(_starts(names, first))
        names = _join(names, at)
        if places:
            place = place[at if run is None else run[at]]
        sizes = sizes.copy()
        sizes[text] = np.diff(np.flatnonzero(first[at]), append=len(at))


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32), np.array([len(t) for t in texts], np.int64)


def fingerprints(texts: list[str]) -> list[bytes]:
    """8 bytes of the last name, then up to ``SKETCH`` numbers of 32 bits in
    ascending order, big-endian."""
    n = len(texts)
    root = np.zeros(n, np.uint64)
    last = np.full(n, -1)
    found = []
    for k, (names, _, sizes) in enumerate(rounds(*code_points(texts), places=False)):
        ends = (sizes == 1) & (last < 0)
        root[ends] = names[(np.cumsum(sizes) - sizes)[ends]]
        found.append((names, sizes, last < 0))
        last[ends] = k
    begin = np.minimum(ROUND, last - BEFORE_LAST)
    owner, value = [], []
    for k, (names, sizes, open_) in enumerate(found):
        take = np.repeat(open_ & (begin <= k), sizes)
        owner.append(np.repeat(np.arange(n), sizes)[take])
        value.append((mix64(names[take] ^ _ODD) >> np.uint64(32)).astype(np.uint32))
    of, value = np.concatenate(owner), np.concatenate(value)
    order = np.argsort(of.astype(np.uint64) << np.uint64(32) | value, kind="stable")
    of, value = of[order], value[order]
    new = np.ones(len(of), bool)
    new[1:] = (of[1:] != of[:-1]) | (value[1:] != value[:-1])
    of, value = of[new], value[new]
    cut = np.searchsorted(of, np.arange(n + 1))
    rows = value.astype(">u4")
    return [int(r).to_bytes(8, "big") + rows[a : min(b, a + SKETCH)].tobytes() for r, a, b in zip(root, cut[:-1], cut[1:])]


def likeness(a: bytes, b: bytes) -> float:
    """Share of common phrases, from 0 to 1; 1 for equal texts."""
    if a == b:
        return 1.0
    x, y = np.frombuffer(a, ">u4", offset=8), np.frombuffer(b, ">u4", offset=8)
    both = np.union1d(x, y)
    # beyond the last number of a full sketch the other's are unknown
    known = [s[-1] for s in (x, y) if len(s) == SKETCH]
    both = both[both <= min(known)] if known else both
    common = np.intersect1d(x, y, assume_unique=True)
    return float(len(np.intersect1d(common, both)) / len(both)) if len(both) else 0.0


def phrases(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, round, place, name)``: every phrase of every round, with the
    code point at which it begins."""
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def run(batches):
        for batch in sliced(batches, 1, BATCH):
            ids = batch.column(0)
            points, sizes = code_points(batch.column(1).to_pylist())
            base = np.cumsum(sizes) - sizes
            before = sizes + 2
            for k, (names, place, now) in enumerate(rounds(points, sizes)):
                keep = np.repeat(before > 1, now)
                of = np.repeat(np.arange(len(now)), now)[keep]
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(of)), pa.array(np.full(len(of), k, np.int32)), pa.array(place[keep] - base[of]), pa.array(names[keep].view(np.int64))],
                    names=["id", "round", "place", "name"],
                )
                before = now

    return plain.mapInArrow(run, "id long, round int, place long, name long").withColumnRenamed("id", id_col)


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, fingerprint)``, one row per row."""
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def run(batches):
        for batch in sliced(batches, 1, BATCH):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fingerprints(batch.column(1).to_pylist()), pa.binary())], names=["id", "fingerprint"])

    return plain.mapInArrow(run, "id long, fingerprint binary").select(F.col("id").alias(id_col), F.lower(F.hex("fingerprint")).alias("fingerprint"))


def edited(text: str, after: str) -> str:
    """``text`` with its last third replaced by the beginning of ``after``."""
    k = len(text) // 3
    return text[: len(text) - k] + after[:k]


_OUT = "id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
_NAMES = [c.split()[0] for c in _OUT.split(", ")]


def _compared(ids: list, texts: list[str], follow: list[str], own: list[bytes], next_own: list[bytes]) -> pa.RecordBatch:
    changed = [edited(t, u) for t, u in zip(texts, follow)]
    other = fingerprints(changed)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(c.encode("utf-8", "surrogatepass")).hexdigest() for c in changed], pa.string()),
            pa.array(own, pa.binary()), pa.array(other, pa.binary()),
            pa.array([likeness(a, b) for a, b in zip(own, other)], pa.float64()), pa.array([likeness(a, b) for a, b in zip(own, next_own)], pa.float64()),
        ],
        names=_NAMES,
    )


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text against its edited form and against the next document by
    falling id (after the last: the first).

    Texts are dealt out in that order once, so the next document is the next
    row of the task; only the last row of each task waits for the first row
    of the one behind it, and these two are joined by the task's number.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    plain = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("h"))
    # equal rows are dealt to several tasks by their place in the input
    tied = plain.withColumn("tie", F.monotonically_increasing_id())
    order = [F.col("id").desc_nulls_last(), "h"]
    ranged = tied.repartitionByRange(*order, "tie").sortWithinPartitions(*order, "text").select("id", "text")

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()

        def edge(name: str, i, t: str) -> pa.RecordBatch:
            row = {n: [None] for n in _NAMES} | {"id": [i], "part": [part], "edge": [name], "text": [t]}
            return pa.RecordBatch.from_pydict({n: pa.array(v, k) for (n, k), v in zip(shape, (row[n] for n, _ in shape))})

        last = None  # (id, text, fingerprint) of the row that waits
        for batch in sliced(batches, 1, BATCH):
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            marks = fingerprints(texts)
            if last is None:
                yield edge("first", ids[0], texts[0])
            else:
                ids, texts, marks = [last[0], *ids], [last[1], *texts], [last[2], *marks]
            if len(ids) > 1:
                done = _compared(ids[:-1], texts[:-1], texts[1:], marks[:-1], marks[1:])
                none = pa.nulls(done.num_rows, pa.string())
                yield pa.RecordBatch.from_arrays([*done.columns, pa.array([part] * done.num_rows, pa.int32()), none, none], names=[n for n, _ in shape])
            last = ids[-1], texts[-1], marks[-1]
        if last is not None:
            yield edge("last", last[0], last[1])

    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "double": pa.float64()}
    shape = [(c.split()[0], kinds[c.split()[1]]) for c in _OUT.split(", ")] + [("part", pa.int32()), ("edge", pa.string()), ("text", pa.string())]
    done = staged(ranged.mapInArrow(run, f"{_OUT}, part int, edge string, text string"), "fingerprints")
    firsts = done.where("edge = 'first'").select(F.col("part").alias("next_part"), F.col("text").alias("next_text"))
    # one number per task: the task behind each, and behind the last the first
    parts = firsts.select("next_part")
    behind = F.lead("next_part").over(Window.orderBy("next_part"))
    links = parts.select(F.col("next_part").alias("part"), F.coalesce(behind, F.min("next_part").over(Window.partitionBy())).alias("next_part"))
    waiting = done.where("edge = 'last'").select("id", "text", "part").join(links, "part").join(firsts, "next_part").select("id", "text", "next_text")

    def finish(batches):
        for batch in sliced(batches, 1, BATCH):
            ids, texts, follow = (c.to_pylist() for c in batch.columns)
            yield _compared(ids, texts, follow, fingerprints(texts), fingerprints(follow))

    rows = done.where("edge is null").select(*_NAMES).unionByName(waiting.mapInArrow(finish, _OUT))
    hexed = lambda c: F.lower(F.hex(c)).alias(c)
    return rows.select(F.col("id").alias(id_col), "n_chars", "edited_sha256", hexed("fingerprint"), hexed("edited_fingerprint"), "near_edited", "near_next")
