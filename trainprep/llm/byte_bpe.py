"""Byte-level BPE encoding and decoding with a two-tier lookup.

Texts are split into pre-tokens; the distinct ones of a batch are looked up
in a minimal perfect hash of the vocabulary (one probe and one comparison).
Those that miss are merged by a heap of adjacent pairs over linked bytes:
always the pair of lowest rank, leftmost first.  Ids are put together by
numpy, and decoding joins the bytes of the ids.

The vocabulary is read once on the driver and broadcast; its size is fixed
by the public file.  Each Python worker keeps the merged misses it has seen,
two generations of ``MEMO``.  Defined results: a null or empty text has no ids;
rows with equal ids each give a row; an id outside the vocabulary is an
error in decoding; extra columns are ignored.
"""

from __future__ import annotations

import base64
from array import array
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trainprep.llm import textbytes as tb
from trainprep.llm.common import sliced
from trainprep.llm.pretokens import Recent, pretokens, spread

MEMO = 100_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _hash_all(keys: list[bytes]) -> np.ndarray:
    joined = np.frombuffer(b"".join(keys), np.uint8)
    ends = np.cumsum([len(k) for k in keys], dtype=np.int64)
    return tb.span_hash(tb.prefix_hash(joined), ends - [len(k) for k in keys], ends) if keys else np.empty(0, np.uint64)


class PerfectHash:
    """Minimal perfect hash by hash and displace: keys fall into small
    buckets; each bucket, largest first, takes the first displacement that
    puts its keys into free slots; the slots are exactly 0 to n - 1."""

    def __init__(self, keys: list[bytes]) -> None:
        n = len(keys)
        hashes = _hash_all(keys)
        self.n, self.buckets = n, max(1, n // 4)
        self.shift = np.zeros(self.buckets, np.uint64)
        self.slot_key: list[bytes] = [b""] * n
        taken = bytearray(n)
        groups: dict[int, list[int]] = {}
        for i, b in enumerate((hashes % np.uint64(self.buckets)).tolist()):
            groups.setdefault(b, []).append(i)
        for b, members in sorted(groups.items(), key=lambda g: (-len(g[1]), g[0])):
            own = hashes[members]
            at = 0
            while True:
                tries = np.arange(at, at + 256, dtype=np.uint64)
                slots = self._slot(own[None, :], tries[:, None])
                for d, row in zip(tries.tolist(), slots.tolist()):
                    if len(set(row)) == len(row) and not any(taken[s] for s in row):
                        break
                else:
                    at += 256
                    continue
                break
            self.shift[b] = d
            for i, s in zip(members, row):
                taken[s] = 1
                self.slot_key[s] = keys[i]

    def _slot(self, hashes, shift):
        return tb.mix64(hashes + shift * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(max(1, self.n))

    def slots(self, keys: list[bytes]) -> list[int]:
        """The slot of each key, or -1 if it is not one of the table's."""
        if not keys or not self.n:
            return [-1] * len(keys)
        hashes = _hash_all(keys)
        found = self._slot(hashes, self.shift[(hashes % np.uint64(self.buckets)).astype(np.int64)]).tolist()
        return [s if self.slot_key[s] == k else -1 for s, k in zip(found, keys)]


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: merges of lowest rank first, then leftmost."""
    n = len(piece)
    stop = list(range(1, n + 1))  # end of the part that starts here, 0: merged away
    prev = list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapify(heap)
    while heap:
        _, i, end = heappop(heap)
        mid = stop[i]
        if not mid or mid >= end or stop[mid] != end:
            continue  # one of the parts has been merged meanwhile
        stop[i], stop[mid] = end, 0
        if end < n:
            prev[end] = i
            k = stop[end]
            r = ranks.get(piece[i:k])
            if r is not None:
                heappush(heap, (r, i, k))
        if i:
            j = prev[i]
            r = ranks.get(piece[j:end])
            if r is not None:
                heappush(heap, (r, j, end))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : stop[i]]])
        i = stop[i]
    return out


class ByteBPE:
    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.table = PerfectHash(sorted(ranks))
        self.slot_id = [array("I", [ranks[k]]).tobytes() for k in self.table.slot_key]
        top = max(ranks.values(), default=-1) + 1
        by_id = [b""] * top
        for k, r in ranks.items():
            by_id[r] = k
        self.id_bytes = np.frombuffer(b"".join(by_id), np.uint8)
        self.id_sizes = np.array([len(k) for k in by_id], np.int64)
        self.memo = Recent(MEMO)

    def encode_distinct(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece as unsigned 32-bit integers."""
        out = []
        for piece, slot in zip(pieces, self.table.slots(pieces)):
            if slot >= 0:
                out.append(self.slot_id[slot])
                continue
            ids = self.memo.get(piece)
            if ids is None:
                ids = array("I", merge_bytes(piece, self.ranks)).tobytes()
                if len(piece) <= 64:
                    self.memo.put(piece, ids)
            out.append(ids)
        return out

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, offsets of the texts)."""
        pieces, first = pretokens(texts)
        coded = pieces.dictionary_encode()
        each = self.encode_distinct(tb.to_bytes(coded.dictionary))
        flat = np.frombuffer(b"".join(each), np.uint32)
        sizes = np.array([len(ids) for ids in each], np.int64) // 4
        ids, offsets = spread(flat, sizes, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64))
        return ids, offsets[first]

    def decode_column(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all texts end to end, offsets of the texts)."""
        if len(ids) and int(ids.max()) >= len(self.id_sizes):
            raise ValueError("an id is outside the vocabulary")
        data, at = spread(self.id_bytes, self.id_sizes, ids)
        return data, at[offsets]


def _column(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    body = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)])
    return body.cast(pa.binary())


def encode(
    docs: DataFrame, ranks: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text", extra: list[str] | None = None, decoded: bool = False
) -> DataFrame:
    """id and ``extra`` columns with ``n_tokens long`` and ``ids binary``
    (little-endian unsigned 32-bit integers); with ``decoded``, the bytes
    that the ids decode to, in the same pass."""
    keep = list(dict.fromkeys([id_col, *(extra or [])]))
    df = docs.select(*keep, F.col(text_col).cast("string").alias("_body"))
    shared = docs.sparkSession.sparkContext.broadcast(ByteBPE(ranks))
    shape = df.drop("_body").schema.add("n_tokens", "long").add("ids", "binary")
    names = [*keep, "n_tokens", "ids"]
    if decoded:
        shape, names = shape.add("decoded", "binary"), [*names, "decoded"]

    def run(batches):
        for batch in sliced(batches, len(keep), 1 << 20):
            ids, offsets = shared.value.encode_column(batch.column(len(keep)))
            cells = [pa.array(np.diff(offsets), pa.int64()), _column(ids.astype("<u4"), offsets * 4)]
            if decoded:
                cells.append(_column(*shared.value.decode_column(ids, offsets)))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), *cells], names=names)

    return df.mapInArrow(run, shape)


def decode(coded: DataFrame, ranks: dict[bytes, int], ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``coded`` with the bytes of its ids as ``out_col`` (null ids: none)."""
    shared = coded.sparkSession.sparkContext.broadcast(ByteBPE(ranks))
    names = coded.columns
    at = names.index(ids_col)
    shape = coded.select("*").schema.add(out_col, "binary")

    def run(batches):
        for batch in sliced(batches, at, 4 << 20):
            raw, ends = tb.buffer_of(batch.column(at))
            data, offsets = shared.value.decode_column(np.frombuffer(raw.tobytes(), "<u4"), ends // 4)
            yield pa.RecordBatch.from_arrays([*batch.columns, _column(data, offsets)], names=[*names, out_col])

    return coded.mapInArrow(run, shape)


def digests(docs: DataFrame, ranks: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ``n_tokens``, and sha-256 of the ids and of the decoded bytes."""
    coded = encode(docs, ranks, id_col, text_col, decoded=True)
    return coded.select(id_col, "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
