"""Files whose records cross line ends, read by many tasks.

A large CSV with quoted newlines, or one JSON array that fills a file, has no
byte at which a reader may start without knowing what came before.  Spark's
text source cuts the file at a separator all the same (newline, ``}``), and
two passes make records of the pieces:

1. every split reports what it does to the reader's state for each state that
   it may be entered in (inside or outside of a string; for JSON also how the
   bracket depth moves).  A file's reports, one row per split, are composed in
   order: now each split knows how it is entered;
2. every split is read again from that state.  Records that begin and end in
   it leave at once; the beginning or the rest of one that crosses its edge
   leaves as a fragment, and the fragments of one record meet by the split in
   which it began.

No task reads a whole file and no text is sorted or shuffled but the
fragments.  ``(path, begin, seq)`` orders the records: file, split, place.
"""

from __future__ import annotations

import csv
import io
import re
import sys
from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FLUSH = 1 << 20  # characters of whole records handed on at once
_SPLIT = "path string, block long"


def split_rows(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """``(path, block, size, value)``: the pieces between separators, in
    order within each split; ``block`` is where the split starts, ``size``
    the file's bytes."""
    meta = {n: F.col(f"_metadata.{c}").alias(n) for n, c in (("path", "file_path"), ("block", "file_block_start"), ("size", "file_size"))}
    return spark.read.option("lineSep", separator).text(path).select(*meta.values(), F.col("value").cast("binary").alias("value"))


def _by_split(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[tuple[tuple, Iterator[str]]]:
    """Each split's key (its first ``columns`` values) and its pieces."""
    def flat():
        for batch in batches:
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(columns)))) if batch.num_rows else []
            for key, piece in zip(keys, batch.column(batch.num_columns - 1).to_pylist()):
                yield key, piece

    def text(path: str, piece: bytes) -> str:
        try:
            return piece.decode("utf-8")
        except UnicodeDecodeError as e:
            raise ValueError(f"invalid UTF-8 in {path}") from e

    for key, rows in groupby(flat(), key=lambda r: r[0]):
        yield key, (text(key[0], piece) for _, piece in rows)


# ---------------------------------------------------------------- CSV

_QUOTED = r'(?:[^"]|"")*+"(?!")'  # to the closing quote
_FIELD = re.compile(rf'"{_QUOTED}[^,\r]*+|(?!")[^,\r]*+')
_REST = re.compile(rf"{_QUOTED}[^,\r]*+")


def csv_line_ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted field is open behind the line, by Python's ``csv``
    (comma, doubled quotes; a quote within a bare field is a character)."""
    if '"' not in line:
        return inside
    at = 0
    if inside:
        m = _REST.match(line)
        if m is None:
            return True
        at = m.end() + 1
    while at <= len(line):
        m = _FIELD.match(line, at)
        if m is None:
            return True
        at = m.end() + 1  # behind the comma or carriage return
    return False


def _csv_report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each split entered outside and inside of a quoted field: whether
    it ends inside, and whether any of its lines ends outside."""
    for key, lines in _by_split(batches, 2):
        now, ends = [False, True], [False, False]
        for line in lines:
            for k in (0, 1):
                now[k] = csv_line_ends_inside(line, now[k])
                ends[k] |= not now[k]
        yield pa.RecordBatch.from_pydict({"path": [key[0]], "block": [key[1]], "out0": [now[0]], "out1": [now[1]], "ends0": [ends[0]], "ends1": [ends[1]]})


def _csv_entries(table: pa.Table) -> pa.Table:
    inside, head, out = False, None, []
    for r in sorted(table.to_pylist(), key=lambda r: r["block"]):
        k = "1" if inside else "0"
        out.append({"path": r["path"], "block": r["block"], "inside": inside, "head": head})
        inside, ends = r["out" + k], r["ends" + k]
        if not inside:
            head = None
        elif head is None or ends:
            head = r["block"]
    return pa.Table.from_pylist(out, pa.schema([("path", pa.string()), ("block", pa.int64()), ("inside", pa.bool_()), ("head", pa.int64())]))


_RECORD = pa.schema([("path", pa.string()), ("begin", pa.int64()), ("seq", pa.int64()), ("fields", pa.list_(pa.string())), ("block", pa.int64()), ("fragment", pa.string())])
_RECORD_DDL = "path string, begin long, seq long, fields array<string>, block long, fragment string"


def _parsed(text: str) -> list[list[str]]:
    csv.field_size_limit(sys.maxsize)
    return list(csv.reader(io.StringIO(text, newline="")))


def _csv_cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (path, block, inside, head), lines in _by_split(batches, 4):
        held: list[str] = []
        size = seq = 0

        def records(text: str) -> pa.RecordBatch:
            rows = [{"path": path, "begin": block, "seq": seq + i, "fields": f} for i, f in enumerate(_parsed(text))]
            return pa.RecordBatch.from_pylist(rows, _RECORD)

        def fragment(begin: int, place: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"path": path, "begin": begin, "seq": place, "block": block, "fragment": "".join(held)}], _RECORD)

        whole = 0  # of the held lines, those that make whole records
        for line in lines:
            held.append(line + "\n")
            size += len(line) + 1
            inside = csv_line_ends_inside(line, inside)
            if inside:
                continue
            if head is not None:
                yield fragment(head, 0)
                head, held, size = None, [], 0
                continue
            whole = len(held)
            if size >= FLUSH:
                done = records("".join(held))
                yield done
                seq, held, size, whole = seq + done.num_rows, [], 0, 0
        if whole:
            rest, held = held[whole:], held[:whole]
            done = records("".join(held))
            yield done
            seq, held = seq + done.num_rows, rest
        if held:
            yield fragment(head if head is not None else block, seq)


def _csv_joined(table: pa.Table) -> pa.Table:
    rows = sorted(table.to_pylist(), key=lambda r: r["block"])
    first = rows[0]
    fields = _parsed("".join(r["fragment"] for r in rows))
    return pa.Table.from_pylist([{"path": first["path"], "begin": first["begin"], "seq": first["seq"] + i, "fields": f} for i, f in enumerate(fields)], _RECORD)


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``(path, begin, seq, fields)``: the records of all CSV files under
    ``path`` as Python's ``csv.reader`` gives them (blank lines are records
    without fields), UTF-8, one large file read by many tasks."""
    rows = split_rows(spark, path, "\n").drop("size")
    report = rows.mapInArrow(_csv_report, f"{_SPLIT}, out0 boolean, out1 boolean, ends0 boolean, ends1 boolean")
    entries = report.groupBy("path").applyInArrow(_csv_entries, f"{_SPLIT}, inside boolean, head long")
    return _cut(rows, entries, ["inside", "head"], _csv_cut, _csv_joined, _RECORD_DDL).select("path", "begin", "seq", "fields")


def _cut(rows: DataFrame, entries: DataFrame, states: list[str], cut: Callable, joined: Callable, schema: str) -> DataFrame:
    """The second pass; ``entries``, one row per split, go to all tasks."""
    known = rows.join(F.broadcast(entries), ["path", "block"]).select("path", "block", *states, "value")
    pieces = known.mapInArrow(cut, schema)
    met = pieces.where("fragment is not null").groupBy("path", "begin").applyInArrow(joined, schema)
    return pieces.where("fragment is null").unionByName(met)


# ---------------------------------------------------------------- JSON

_STRING = re.compile(r'"[^"\\]*+(?:\\.[^"\\]*+)*+"', re.DOTALL)
_CLOSE = re.compile(r'[^"\\]*+(?:\\.[^"\\]*+)*+"', re.DOTALL)
_BRACKET = {"{": 1, "[": 1, "}": -1, "]": -1}


def json_piece(piece: str, inside: bool) -> tuple[bool, int]:
    """(inside a string behind the piece, movement of the bracket depth)."""
    if inside:
        m = _CLOSE.match(piece)
        if m is None:
            return True, 0
        piece = piece[m.end() :]
    bare = _STRING.sub("", piece) if '"' in piece else piece
    at = bare.find('"')
    if at >= 0:
        bare = bare[:at]
    return at >= 0, sum(bare.count(c) * d for c, d in _BRACKET.items())


def _json_report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each split entered outside and inside of a string, every piece
    closed by ``}``: whether it ends inside, how the depth moves and how low
    it is behind a ``}`` at least; its pieces and bytes; how it begins."""
    for key, pieces in _by_split(batches, 3):
        now, depth, low = [False, True], [0, 0], [None, None]
        n = size = 0
        begins = ""
        for piece in pieces:
            n += 1
            size += len(piece.encode("utf-8"))
            begins = begins or piece.lstrip(" \t\r\n")[:1]
            for k in (0, 1):
                now[k], moved = json_piece(piece, now[k])
                depth[k] += moved
                if not now[k]:
                    depth[k] -= 1
                    low[k] = depth[k] if low[k] is None else min(low[k], depth[k])
        row = {"path": key[0], "block": key[1], "file_size": key[2], "n": n, "bytes": size, "begins": begins}
        row |= {f"{name}{k}": v[k] for name, v in (("out", now), ("depth", depth), ("low", low)) for k in (0, 1)}
        yield pa.RecordBatch.from_pylist([row], _REPORT)


_REPORT = pa.schema([
    ("path", pa.string()), ("block", pa.int64()), ("file_size", pa.int64()), ("n", pa.int64()), ("bytes", pa.int64()), ("begins", pa.string()),
    ("out0", pa.bool_()), ("out1", pa.bool_()), ("depth0", pa.int64()), ("depth1", pa.int64()), ("low0", pa.int64()), ("low1", pa.int64()),
])
_REPORT_DDL = f"{_SPLIT}, file_size long, n long, bytes long, begins string, out0 boolean, out1 boolean, depth0 long, depth1 long, low0 long, low1 long"
_ENTRY = pa.schema([("path", pa.string()), ("block", pa.int64()), ("inside", pa.bool_()), ("depth", pa.int64()), ("base", pa.int64()), ("head", pa.int64()), ("open", pa.bool_())])
_ENTRY_DDL = f"{_SPLIT}, inside boolean, depth long, base long, head long, open boolean"


def _json_entries(table: pa.Table) -> pa.Table:
    rows = sorted(table.to_pylist(), key=lambda r: r["block"])
    path = rows[0]["path"]
    # separators the file holds: as many as pieces, or one less if it does not end in one
    count, missing = sum(r["n"] for r in rows), rows[0]["file_size"] - sum(r["bytes"] for r in rows)
    closed = missing in (count, count + 3)  # a byte order mark of three bytes is left out by the reader
    base = 1 if rows[0]["begins"] == "[" else 0
    inside, depth, head, out = False, 0, None, []
    for r in rows:
        out.append({"path": path, "block": r["block"], "inside": inside, "depth": depth, "base": base, "head": head, "open": False})
        k = "1" if inside else "0"
        low = r["low" + k]
        whole = low is not None and low <= base - depth
        inside, depth = r["out" + k], depth + r["depth" + k]
        if not inside and depth <= base:
            head = None
        elif head is None or whole:
            head = r["block"]
    if not closed:
        out[-1]["open"] = True
        depth += not inside  # the last piece has no bracket behind it
    if inside or depth:
        raise ValueError(f"broken JSON in {path}")
    return pa.Table.from_pylist(out, _ENTRY)


_ELEMENT = pa.schema([("path", pa.string()), ("begin", pa.int64()), ("seq", pa.int64()), ("base", pa.int64()), ("element", pa.string()), ("block", pa.int64()), ("fragment", pa.string())])
_ELEMENT_DDL = "path string, begin long, seq long, base long, element string, block long, fragment string"


def _element(path: str, begin: int, seq: int, base: int, text: str) -> dict:
    """An element without what stands before it; objects only."""
    first = begin == 0 and seq == 0
    if base == 0 and not first:
        raise ValueError(f"several JSON values in {path}")
    body = text.lstrip(" \t\r\n")
    mark = "" if base == 0 else "[" if first else ","
    if not body.startswith(mark) or not (body := body[len(mark) :].lstrip(" \t\r\n")).startswith("{"):
        raise ValueError(f"not an array of objects: {path}")
    return {"path": path, "begin": begin, "seq": seq, "base": base, "element": body.replace("\r", " ").replace("\n", " ")}


def _json_cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (path, block, inside, depth, base, head, is_open), pieces in _by_split(batches, 7):
        held: list[str] = []
        rows: list[dict] = []
        seq = size = 0
        waiting: str | None = None  # the last piece of an open file has no bracket behind it
        start = depth == 0 and base == 1

        def fragment(begin: int) -> dict:
            return {"path": path, "begin": begin, "seq": seq, "base": base, "block": block, "fragment": "".join(held)}

        def taken(piece: str) -> Iterator[pa.RecordBatch]:
            nonlocal held, rows, seq, size, inside, depth, head
            held.append(piece + "}")
            size += len(piece) + 1
            inside, moved = json_piece(piece, inside)
            depth += moved
            if not inside:
                depth -= 1
                if depth == base:
                    if head is not None:
                        rows.append(fragment(head))
                        head = None
                    else:
                        rows.append(_element(path, block, seq, base, "".join(held)))
                        seq += 1
                    held = []
            if size >= FLUSH and rows:
                yield pa.RecordBatch.from_pylist(rows, _ELEMENT)
                rows, size = [], 0

        for piece in pieces:
            if waiting is not None:
                yield from taken(waiting)
            waiting = piece
            if not is_open:
                yield from taken(piece)
                waiting = None
        if waiting is not None:
            rest = ("".join(held) + waiting).strip(" \t\r\n")
            empty = start and not seq and re.fullmatch(r"\[\s*\]", rest)
            if rest != ("]" if base else "") and not empty:
                raise ValueError(f"broken JSON in {path}")
            held = []
        if held:
            rows.append(fragment(head if head is not None else block))
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _ELEMENT)


def _json_joined(table: pa.Table) -> pa.Table:
    rows = sorted(table.to_pylist(), key=lambda r: r["block"])
    r = rows[0]
    return pa.Table.from_pylist([_element(r["path"], r["begin"], r["seq"], r["base"], "".join(x["fragment"] for x in rows))], _ELEMENT)


def json_elements(spark: SparkSession, path: str) -> DataFrame:
    """``(path, begin, seq, element)``: the objects of JSON files that hold
    one array of objects, or one object, each as a line of JSON.  One array
    may fill a file of any size: it is read by many tasks.  Anything else is
    an error."""
    rows = split_rows(spark, path, "}")
    report = rows.mapInArrow(_json_report, _REPORT_DDL)
    entries = report.groupBy("path").applyInArrow(_json_entries, _ENTRY_DDL)
    return _cut(rows, entries, ["inside", "depth", "base", "head", "open"], _json_cut, _json_joined, _ELEMENT_DDL).select("path", "begin", "seq", "element")
