"""Token-id files: frequency-ranked ids in byte-aligned variable-length code.

Ids are counted over the whole corpus and replaced by their frequency rank,
so the frequent ones take one byte.  Values are stored in two streams:
control bytes hold four 2-bit lengths each, data bytes the values without
leading zero bytes.  Decoding looks every control byte up in a 256-row
numpy table.

Files are tables of chunks in ascending id order: each row holds the ids and
sizes of some whole documents and the two streams.  They are written by
Spark's committed writer into the shared folder, and read back from there.
The rank table lies beside them, so the files can be read on their own.  The
only driver data is that table (bounded by the vocabulary).

Equal pre-tokens always get equal ids, so the tokenizers library encodes each
distinct pre-token of a batch once.  A text that holds one of the vocabulary's
added tokens (which the library cuts out first) is encoded whole.  Defined results: a null or empty text
holds the end id alone; rows with equal ids each are a document, ordered by
their tokens; a null id sorts first; an empty table writes no chunk; extra
columns are ignored.
"""

from __future__ import annotations

import json
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trainprep.llm import textbytes as tb
from trainprep.llm.common import sliced, staged
from trainprep.llm.pretokens import Recent, pretokens, spread
from trainprep.session import scratch_dir

CHUNK = 1 << 20  # ids; a longer document is a chunk alone
MEMO = 300_000
LINE = 64  # distinct pre-tokens in one call of the library
CHUNK_SCHEMA = "place long, n_docs int, n_ids long, doc_ids binary, no_id binary, sizes binary, control binary, data binary"

_LENGTHS = np.array([[(c >> (2 * k) & 3) + 1 for k in range(4)] for c in range(256)], np.int64)
_TOTALS = _LENGTHS.sum(axis=1)
_BEFORE = np.cumsum(_LENGTHS, axis=1) - _LENGTHS


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 32-bit values."""
    v = np.zeros(-(-len(values) // 4) * 4, "<u4")
    v[: len(values)] = values
    size = (v >= 1 << 8).astype(np.uint8) + (v >= 1 << 16) + (v >= 1 << 24)
    control = (size.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    keep = np.arange(4) <= size[:, None]
    return control.tobytes(), v.view(np.uint8).reshape(-1, 4)[keep].tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The first ``n`` values of the two streams."""
    c = np.frombuffer(control, np.uint8)
    raw = np.frombuffer(data + b"\0\0\0", np.uint8)
    begin = np.cumsum(_TOTALS[c]) - _TOTALS[c]
    at = (begin[:, None] + _BEFORE[c]).reshape(-1)[:n]
    size = _LENGTHS[c].reshape(-1)[:n]
    out = np.zeros(n, np.uint32)
    for k in range(4):
        more = size > k
        out[more] |= raw[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


class LibraryEncoder:
    """Ids by the tokenizers library, each distinct pre-token once."""

    def __init__(self, vocabulary: str) -> None:
        self.vocabulary = vocabulary  # the JSON text
        self.added = [t["content"] for t in json.loads(vocabulary).get("added_tokens") or []]
        self.whole = self.library = None
        self.memo = Recent(MEMO)

    def __getstate__(self):
        return self.__dict__ | {"whole": None, "library": None}

    def _open(self) -> None:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_str(self.vocabulary)
        # pre-tokens of texts without added tokens, where joined ones must not make one up
        self.library = Tokenizer.from_str(json.dumps(json.loads(self.vocabulary) | {"added_tokens": []}))

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, first id of each text)."""
        if self.library is None:
            self._open()
        texts = pc.fill_null(texts, "")
        special = np.zeros(len(texts), bool)
        for content in self.added:
            special |= pc.match_substring(texts, content).to_numpy(zero_copy_only=False)
        if not special.any():
            return self._plain_column(texts)
        mask = pa.array(special)
        ids, at = self._plain_column(pc.if_else(mask, "", texts))
        parts, sizes = np.split(ids, at[1:-1]), np.diff(at)
        for i, text in zip(np.flatnonzero(special).tolist(), texts.filter(mask).to_pylist()):
            parts[i] = np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)
            sizes[i] = len(parts[i])
        return np.concatenate(parts), np.concatenate([[0], np.cumsum(sizes)])

    def _plain_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        pieces, first = pretokens(texts)
        coded = pieces.dictionary_encode()
        distinct = tb.to_bytes(coded.dictionary)
        each = [self.memo.get(p) for p in distinct]
        new = [i for i, e in enumerate(each) if e is None]
        for i, ids in zip(new, self._library_ids([distinct[i].decode() for i in new])):
            each[i] = ids
            if len(distinct[i]) <= 64:
                self.memo.put(distinct[i], ids)
        flat = np.frombuffer(b"".join(each), np.uint32)
        sizes = np.array([len(e) for e in each], np.int64) // 4
        ids, offsets = spread(flat, sizes, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64))
        return ids, offsets[first]

    def _library_ids(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece.  Pieces of a space and no other white space
        split the same way side by side, so they share calls."""
        out = [b""] * len(pieces)
        own, shared = [], []
        for i, p in enumerate(pieces):
            (shared if p[0] == " " and not p[1:2].isspace() and len(p) > 1 else own).append(i)
        for i, e in zip(own, self.library.encode_batch([pieces[i] for i in own], add_special_tokens=False)):
            out[i] = array("I", e.ids).tobytes()
        groups = [shared[at : at + LINE] for at in range(0, len(shared), LINE)]
        lines = self.library.encode_batch(["".join(pieces[i] for i in g) for g in groups], add_special_tokens=False)
        for g, e in zip(groups, lines):
            ids = array("I", e.ids).tobytes()
            ends = np.cumsum(np.bincount(np.array(e.word_ids, np.int64), minlength=len(g)) * 4).tolist()
            if len(ends) != len(g):
                raise ValueError("the library splits pre-tokens in another way")
            for i, a, b in zip(g, [0, *ends], ends):
                out[i] = ids[a:b]
        return out


def encode(docs: DataFrame, vocabulary: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n, ids)``: ids of each row with the end id, compressed."""
    df = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"))
    shared = docs.sparkSession.sparkContext.broadcast(LibraryEncoder(vocabulary))

    def run(batches):
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in sliced(batches, 1, 4 << 20):
            ids, at = shared.value.encode_column(batch.column(1))
            wide = "<u4" if max(end_id, int(ids.max()) if len(ids) else 0) >> 16 else "<u2"
            mark = b"4" if wide == "<u4" else b"2"
            blobs = [mark + squeeze.compress(np.append(ids[a:b], end_id).astype(wide).tobytes()) for a, b in zip(at, at[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(at) + 1, pa.int64()), pa.array(blobs, pa.binary())], names=["id", "n", "ids"]
            )

    return df.mapInArrow(run, "id long, n long, ids binary")


def _ids(blob: bytes, expand) -> np.ndarray:
    """A row's ids: 16 or 32 bits each, as the first byte says."""
    raw = expand.decompress(blob[1:])
    return np.frombuffer(raw, "<u2").astype(np.uint32) if blob[:1] == b"2" else np.frombuffer(raw, "<u4")


def frequency_order(coded: DataFrame) -> np.ndarray:
    """Ids by falling frequency over all rows, equal counts by id; one entry
    per id in use, so bounded by the vocabulary."""

    def run(batches):
        import zstandard

        expand, total = zstandard.ZstdDecompressor(), np.zeros(1, np.int64)
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                n = np.bincount(_ids(blob, expand))
                if len(n) > len(total):
                    total = np.append(total, np.zeros(len(n) - len(total), np.int64))
                total[: len(n)] += n
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["v", "n"])

    counts = coded.select("ids").mapInArrow(run, "v long, n long").groupBy("v").agg(F.sum("n").alias("n")).toPandas()
    return counts.sort_values(["n", "v"], ascending=[False, True])["v"].to_numpy().astype(np.uint32)


def write(docs: DataFrame, vocabulary: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> str:
    """Writes the files in ascending id order, and the ids by rank beside
    them; their folder."""
    spark = docs.sparkSession
    path = path or scratch_dir(spark, "token-files")
    coded = staged(encode(docs, vocabulary, end_id, id_col, text_col), "token-ids")
    order = frequency_order(coded)
    ranks = pa.table({"rank": np.arange(len(order), dtype=np.int64), "id": order.astype(np.int64)})
    spark.createDataFrame(ranks).coalesce(1).write.parquet(f"{path}/ranks")
    rank = np.zeros(int(order.max()) + 1 if len(order) else 1, np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)
    shared = spark.sparkContext.broadcast(rank)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    ranged = coded.repartitionByRange(parts, F.col("id").asc_nulls_first()).sortWithinPartitions(F.col("id").asc_nulls_first(), "n", "ids")

    def run(batches):
        import zstandard

        expand, place = zstandard.ZstdDecompressor(), 0
        rows: list = []
        held = 0

        def chunk():
            nonlocal place
            v = np.concatenate([shared.value[r[2]] for r in rows])
            control, data = pack(v)
            ids = np.array([r[0] or 0 for r in rows], "<i8").tobytes()
            row = [place, len(rows), len(v), ids, np.array([r[0] is None for r in rows]).tobytes(), np.array([r[1] for r in rows], "<i8").tobytes(), control, data]
            place += len(v)
            kinds = (pa.int64(), pa.int32(), pa.int64(), *[pa.binary()] * 5)
            names = [c.split()[0] for c in CHUNK_SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], names=names)

        for batch in batches:
            for i, n, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if rows and held + n > CHUNK:
                    yield chunk()
                    rows, held = [], 0
                rows.append((i, n, _ids(blob, expand)))
                held += n
        if rows:
            yield chunk()

    # the range number is the file: partitions in order hold ascending ids
    files = ranged.mapInArrow(run, CHUNK_SCHEMA).select(F.spark_partition_id().alias("file"), "*")
    files.write.option("compression", "zstd").parquet(f"{path}/chunks")
    return path


def read(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """Per document: id, ``start`` (ids of all documents before it),
    ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit integers).  The
    chunks stay where they are read: only a number for each file is joined."""
    ranks = spark.read.schema("rank long, id long").parquet(f"{path}/ranks").toPandas()  # bounded by the vocabulary
    shared = spark.sparkContext.broadcast(ranks.sort_values("rank")["id"].to_numpy().astype("<u4"))
    chunks = spark.read.schema(f"file int, {CHUNK_SCHEMA}").parquet(f"{path}/chunks")
    totals = chunks.groupBy("file").agg(F.sum("n_ids").alias("n"))
    # one row per file, so a window over all of them is small
    before = totals.select("file", (F.sum("n").over(Window.orderBy("file")) - F.col("n")).alias("file_start"))
    rows = chunks.join(F.broadcast(before), "file").select((F.col("place") + F.col("file_start")).alias("at"), "n_ids", "doc_ids", "no_id", "sizes", "control", "data")

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                at, n, doc_ids, no_id, sizes, control, data = (c[k].as_py() for c in batch.columns)
                ids = shared.value[unpack(control, data, n)]
                size = np.frombuffer(sizes, "<i8")
                ends = np.cumsum(size)
                offsets = np.concatenate([[0], ends * 4]).astype(np.int64)
                body = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.frombuffer(doc_ids, "<i8"), mask=np.frombuffer(no_id, bool)), pa.array(at + ends - size, pa.int64()),
                        pa.array(size, pa.int64()), body.cast(pa.binary()),
                    ],
                    names=["id", "start", "n_tokens", "ids"],
                )

    out = rows.mapInArrow(run, "id long, start long, n_tokens long, ids binary")
    return out.withColumnRenamed("id", id_col)


def digests(read_back: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return read_back.select(id_col, "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
