"""File sources: datasets by suffix, JSON / TXT folders, ZIP archives,
opener CSV, whole-file scalars, log lines and run-log families."""

from __future__ import annotations

import os
import re
import unicodedata
import zipfile
import zlib
from collections.abc import Iterator
from itertools import islice
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trainprep.functions.text import lossy_utf8, normalize_newlines, py_strip
from trainprep.operators.columns import computed_once
from trainprep.operators.ordinal import with_ordinal
from trainprep.schemas import MESSAGES
from trainprep.session import scratch_dir
from trainprep.sources.parquet import plain_path
from trainprep.sources.splits import csv_records, json_elements

DATASET_FORMATS = {".json": "json", ".jsonl": "json", ".parquet": "parquet", ".csv": "csv"}


def load_dataset(spark: SparkSession, path: str, fmt: str | None = None, schema=None) -> DataFrame:
    """Generic dataset load (S10): format by suffix unless given.  JSON is
    read as JSON lines when the first line that is not blank is a whole
    object, else as one array of objects, or one object, per file: its
    elements are cut out by many tasks and written as JSON lines once, which
    inference and every later use read.  Malformed records and folders that
    mix both forms are errors."""
    if fmt is None:
        stem = path.rstrip("/").lower()
        fmt = next((f for suf, f in DATASET_FORMATS.items() if stem.endswith(suf)), "parquet")
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", "true")
    if fmt == "json":
        reader = reader.option("mode", "FAILFAST")
        if not _json_lines(spark, path):
            lines = scratch_dir(spark, "json-lines")
            json_elements(spark, path).select("element").write.text(lines)
            return reader.load(lines)
    return reader.load(path)


def _json_lines(spark: SparkSession, path: str) -> bool:
    """True for JSON lines, told by the first line that is not blank.  An
    array is known by its first piece, however long its line."""
    blank = r"^[ \t\r\n]*$"
    piece = spark.read.option("lineSep", "}").text(path).where(~F.col("value").rlike(blank)).first()
    if piece is None:
        return True
    if piece["value"].lstrip("\ufeff \t\r\n").startswith("["):
        return False
    start = spark.read.text(path).where(~F.col("value").rlike(blank))
    return start.select((F.get_json_object("value", "$").isNotNull() & F.col("value").rlike(r"^\s*\{")).alias("line")).first()["line"]


RUN_KEY_PATTERN = r"train_rank(\d+)\.log"


def _numbered(raw: DataFrame, group: list[str]) -> DataFrame:
    """``raw (group, value, _path, _block)`` with ``line``: the 0-based number
    of the row among those of its group, in order of file name and place.

    Lines are counted per split where they are read; prefix sums over the
    splits, one row each, say how many come before.  The lines themselves
    are neither sorted nor shuffled.
    """
    rows = raw.withColumn("_id", F.monotonically_increasing_id())
    splits = rows.groupBy(*group, "_path", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    order = Window.partitionBy(*group) if group else Window.partitionBy()
    before = order.orderBy(plain_path("_path"), "_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select("_path", "_block", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    placed = rows.join(F.broadcast(starts), ["_path", "_block"])
    return placed.select(*group, (F.col("_id") + F.col("_shift")).cast("long").alias("line"), "value")


def _raw_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(
        lossy_utf8("value").alias("value"), F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_block")
    )


def log_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(line, value)``: log lines (S8) with their 0-based number over all
    files in name order.  ``\\n``, ``\\r\\n`` and lone ``\\r`` end a line (as
    Python's universal newlines); undecodable bytes become U+FFFD."""
    return _numbered(_raw_lines(spark, path), [])


def run_log_lines(spark: SparkSession, pattern: str, key_pattern: str = RUN_KEY_PATTERN, key: str = "rank") -> DataFrame:
    """``(key, line, value)``: a family of run logs (S11), the run key taken
    from each file path, lines numbered within each run."""
    run = F.regexp_extract("_path", key_pattern, 1).try_cast("long").alias(key)
    return _numbered(_raw_lines(spark, pattern).select(run, "value", "_path", "_block"), [key])


#: Tasks that list a folder: each reads all names and takes its share of them.
LISTING_TASKS = 16
#: Bytes that one task reads at most, but for one file; each file counts FILE_COST more, for its opening.
SLICE_BYTES = 128 << 20
FILE_COST = 16 << 10
#: Bytes after which a batch of files is handed on.
READ_BATCH_BYTES = 4 << 20


def whole_files(spark: SparkSession, folder: str, suffix_glob: str) -> DataFrame:
    """Whole files directly in ``folder`` matching the glob: ``(path, name, value)``.

    Names that start with ``.`` are hidden, as for a shell's ``*``.  Names
    that start with ``_`` are data, though Spark's file sources hide them.

    A folder of millions of small files is listed by tasks, cut into slices
    by bytes and read by tasks; no list of files passes through the driver.
    Spark's text source, which lists on the driver and plans a 4 MB share of a
    task for each file, reads what Arrow's file systems cannot open.
    """
    listed = _listed_folder(spark, folder, suffix_glob)
    if listed is None:
        return _text_files(spark, folder, suffix_glob)
    root, slices, n = listed
    spread = slices.repartitionById(n, "slice").select("name")
    read = spread.mapInArrow(_read_files(root), "path string, name string, value binary")
    return read.select("path", "name", F.col("value").cast("string").alias("value"))


def _listed_folder(spark: SparkSession, folder: str, suffix_glob: str) -> tuple[str, DataFrame, int] | None:
    """The folder's URI, its files ``(slice, name)`` and the number of slices;
    none for what is no folder, a glob of several parts, or a file system
    that Arrow does not know."""
    sc = spark.sparkContext
    if not re.fullmatch(r"\*[^*?\[\]{}\\]*", suffix_glob):
        return None
    at = sc._jvm.org.apache.hadoop.fs.Path(folder)
    hadoop = at.getFileSystem(sc._jsc.hadoopConfiguration())
    if not hadoop.exists(at) or not hadoop.getFileStatus(at).isDirectory():
        return None
    # written as the parent of a file, as Hadoop has it in a listing
    root = sc._jvm.org.apache.hadoop.fs.Path(hadoop.makeQualified(at), "x").toUri().toString()[: -len("/x")]
    try:
        fs.FileSystem.from_uri(root)
    except (OSError, ValueError):
        return None
    tasks = max(1, min(LISTING_TASKS, sc.defaultParallelism))
    listing = scratch_dir(spark, "listing")
    shares = spark.range(tasks, numPartitions=tasks).mapInPandas(_list_share(root, suffix_glob[1:], tasks), "slice int, name string")
    shares.write.parquet(listing)
    slices = spark.read.schema("slice int, name string").parquet(listing)
    return root, slices, (slices.agg(F.max("slice")).first()[0] or 0) + 1


def _folder_files(root: str, suffix: str, tasks: int, task: int) -> Iterator[tuple[str, int]]:
    """``(name, bytes)`` of one task's share.  Empty files are passed over as
    Spark's reader does, but for names that it hides."""
    filesystem, inner = fs.FileSystem.from_uri(root)
    mine = lambda name: name.endswith(suffix) and not name.startswith(".") and zlib.crc32(name.encode()) % tasks == task
    if isinstance(filesystem, fs.LocalFileSystem):
        # Arrow's listing holds every name and asks for the state of each
        with os.scandir(inner) as entries:
            found = ((e.name, e.stat().st_size) for e in entries if mine(e.name) and e.is_file())
            yield from (f for f in found if f[1] or f[0].startswith("_"))
        return
    for f in filesystem.get_file_info(fs.FileSelector(inner)):
        if f.type == fs.FileType.File and mine(f.base_name) and (f.size or f.base_name.startswith("_")):
            yield f.base_name, f.size


def _list_share(root: str, suffix: str, tasks: int):
    def run(batches):
        for pdf in batches:
            for task in pdf["id"]:
                cut, held = 0, 0
                files = _folder_files(root, suffix, tasks, task)
                while rows := list(islice(files, 10_000)):
                    slices = []
                    for _, size in rows:
                        if held and held + size + FILE_COST > SLICE_BYTES:
                            cut, held = cut + 1, 0
                        held += size + FILE_COST
                        slices.append(cut * tasks + task)
                    yield pd.DataFrame({"slice": pd.Series(slices, dtype="int32"), "name": [name for name, _ in rows]})

    return run


def _uri_name(name: str) -> str:
    """A file name as Java writes it in a URI, and so the ``file_path``
    metadata column: letters outside of ASCII stay."""

    def kept(c: str) -> bool:
        if c.isascii():
            return c.isalnum() or c in "_-!.~'()*:@&=+$,;"
        return unicodedata.category(c) not in ("Zs", "Zl", "Zp", "Cc")

    return "".join(c if kept(c) else quote(c, safe="") for c in name)


def _read_files(root: str):
    def run(batches):
        filesystem, inner = fs.FileSystem.from_uri(root)
        rows, held = [], 0

        def batch() -> pa.RecordBatch:
            paths, names, values = zip(*rows)
            return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(names, pa.string()), pa.array(values, pa.binary())], names=["path", "name", "value"])

        for listed in batches:
            for name in listed.column(0).to_pylist():
                with filesystem.open_input_stream(f"{inner}/{name}") as f:
                    value = f.read()
                shown = _uri_name(name)
                rows.append((f"{root}/{shown}", shown, value))
                held += len(value) + len(root)
                if held >= READ_BATCH_BYTES:
                    yield batch()
                    rows, held = [], 0
        if rows:
            yield batch()

    return run


def _text_files(spark: SparkSession, folder: str, suffix_glob: str) -> DataFrame:
    """:func:`whole_files` by Spark's text source; names that it hides are
    listed apart and read by the tasks."""
    files = with_file_name(spark.read.option("pathGlobFilter", suffix_glob).text(folder, wholetext=True))
    apart = _underscore_files(spark, folder, suffix_glob)
    if not apart:
        return files
    # packed into tasks by their bytes, as Spark packs the others
    limit = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    tasks, held, packed = 0, 0, []
    for path, size in apart:
        if held and held + size > limit:
            tasks, held = tasks + 1, 0
        held += size
        packed.append((path, tasks))
    listed = spark.createDataFrame(packed, "path string, task int").repartitionById(tasks + 1, "task").select("path")
    read = listed.mapInPandas(_read_bytes, "path string, value binary")
    return files.unionByName(
        read.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), F.col("value").cast("string").alias("value"))
    )


def _underscore_files(spark: SparkSession, folder: str, suffix_glob: str) -> list[tuple[str, int]]:
    """Paths and bytes of the files that Spark's listing leaves out, written
    as the ``file_path`` metadata column writes them."""
    sc = spark.sparkContext
    pattern = sc._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/_{suffix_glob}")
    found = pattern.getFileSystem(sc._jsc.hadoopConfiguration()).globStatus(pattern)
    return sorted((s.getPath().toUri().toString(), s.getLen()) for s in found or [] if s.isFile())


def _read_bytes(batches):
    for pdf in batches:
        for path in pdf["path"]:
            filesystem, inner = fs.FileSystem.from_uri(path)
            with filesystem.open_input_stream(inner) as f:
                yield pd.DataFrame({"path": [path], "value": [f.read()]})


def with_file_name(raw: DataFrame) -> DataFrame:
    """``value`` -> ``(path, name, value)`` from the file metadata column."""
    path = F.col("_metadata.file_path")
    return raw.select(path.alias("path"), F.element_at(F.split(path, "/"), -1).alias("name"), "value")


def _last_messages(top: Column) -> Column:
    return F.try_element_at(F.filter(F.map_entries(top), lambda e: e["key"] == "messages"), F.lit(-1))["value"]


def parse_json_documents(files: DataFrame) -> DataFrame:
    """``(path, name, value)`` -> ``(path, name, status, messages)`` (see
    :func:`scan_json_folder`); shared by the batch and streaming reads."""
    # Top-level keys with their raw JSON text: lenient like Python's json
    # (NaN / Infinity accepted), null for broken or non-object documents.
    # Each document is parsed once, whatever filters follow.
    keep = ["path", "name"]
    parsed = computed_once(files, keep, top=F.from_json("value", "map<string,string>", {"mode": "PERMISSIVE"}))
    parsed = computed_once(
        parsed, [*keep, "top"], typed=F.from_json(_last_messages(F.col("top")), MESSAGES, {"mode": "PERMISSIVE"})
    )
    top, typed = F.col("top"), F.col("typed")
    # the last of equal keys counts, as in a Python dict
    raw_msgs = _last_messages(top)
    status = (
        F.when(top.isNull(), "corrupt")
        .when(~F.map_contains_key(top, "messages"), "missing_messages")
        .when(raw_msgs.isNull(), "ok")
        .when(typed.isNull(), "corrupt")
        .otherwise("ok")
    )
    messages = F.when(status == "missing_messages", F.array().cast(MESSAGES)).when(status == "ok", typed)
    return parsed.select("path", "name", status.alias("status"), messages.alias("messages"))


def scan_json_folder(spark: SparkSession, folder: str) -> DataFrame:
    """JSON folder scan (S1): one document per ``*.json`` file.

    Columns: ``path, name, status, messages``.  ``status`` is ``ok``,
    ``missing_messages`` (object without the key: ``messages = []``),
    ``corrupt`` (not parseable JSON, or not an object, or ``messages`` of
    the wrong type).  An explicit null ``messages`` stays null.
    """
    return parse_json_documents(whole_files(spark, folder, "*.json"))


def clean_txt_documents(files: DataFrame, on_bad_utf8: str = "error") -> DataFrame:
    """``(path, name, value)`` -> ``(path, name, text)``: newlines folded,
    empty files dropped, invalid UTF-8 fails (``error``) or is dropped
    (``reject``); shared by the batch and streaming reads."""
    valid = F.is_valid_utf8("value")
    if on_bad_utf8 == "error":
        text = F.when(valid, F.col("value")).otherwise(F.raise_error(F.concat(F.lit("invalid UTF-8 in "), "path")))
    elif on_bad_utf8 == "reject":
        files = files.where(valid)
        text = F.col("value")
    else:
        raise ValueError("on_bad_utf8 must be 'error' or 'reject'")
    # newline folding never empties a file, so empty files are dropped on
    # the raw value (a filter on the folded text would fold twice)
    return files.where(F.length("value") > 0).select("path", "name", normalize_newlines(text).alias("text"))


def txt_rejects(files: DataFrame) -> DataFrame:
    """``(path, name)`` of the files that ``on_bad_utf8="reject"`` leaves out."""
    return files.where(~F.is_valid_utf8("value")).select("path", "name")


def scan_txt_folder(spark: SparkSession, folder: str, on_bad_utf8: str = "error") -> DataFrame:
    """TXT folder scan (S2): one row per non-empty ``*.txt`` file, newlines
    translated to ``\\n``.  Invalid UTF-8 fails the job (``error``) or the
    file is left out (``reject``; :func:`txt_rejects` names those)."""
    return clean_txt_documents(whole_files(spark, folder, "*.txt"), on_bad_utf8)


def _zip_listing(batches):
    """Archive path -> one row per ``.txt`` member (central directory only),
    with its place and compressed bytes."""
    for pdf in batches:
        for path in pdf["path"]:
            filesystem, inner = fs.FileSystem.from_uri(path)
            with filesystem.open_input_file(inner) as f, zipfile.ZipFile(f) as zf:
                rows = [(path, i.filename, i.header_offset, i.compress_size) for i in zf.infolist() if i.filename.lower().endswith(".txt")]
            if rows:
                yield pd.DataFrame(rows, columns=["archive", "member", "place", "size"])


#: Decoded bytes after which a batch of member texts is handed on.
ZIP_BATCH_BYTES = 16 << 20
#: Compressed bytes that one task reads at most, but for one member.
ZIP_SLICE_BYTES = 32 << 20


def _zip_read(batches):
    """``(archive, member)`` rows in order -> member texts, strict UTF-8.  An
    archive stays open while its members follow each other, so a task parses
    the directory of each archive it meets once."""
    current, handle, archive_zip = None, None, None
    rows, held = [], 0
    try:
        for pdf in batches:
            for archive, member in zip(pdf["archive"], pdf["member"]):
                if archive != current:
                    if handle is not None:
                        archive_zip.close()
                        handle.close()
                    filesystem, inner = fs.FileSystem.from_uri(archive)
                    handle = filesystem.open_input_file(inner)
                    archive_zip = zipfile.ZipFile(handle)
                    current = archive
                raw = archive_zip.read(member)
                rows.append((archive, member, raw.decode("utf-8")))
                held += len(raw)
                if held >= ZIP_BATCH_BYTES:
                    yield pd.DataFrame(rows, columns=["archive", "member", "text"])
                    rows, held = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=["archive", "member", "text"])
    finally:
        if handle is not None:
            archive_zip.close()
            handle.close()


def zip_slices(spark: SparkSession, folder_or_glob: str, slice_bytes: int | None = None) -> DataFrame:
    """``(archive, member, place, slice)``: members cut into slices of about
    ``slice_bytes`` compressed bytes (by default a core's share of all, at
    most ``ZIP_SLICE_BYTES``, as Spark cuts its own files), each a run of members as they stand in
    one archive.  What follows a member larger than that is another slice."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(folder_or_glob).select("path")
    members = listing.mapInPandas(_zip_listing, "archive string, member string, place long, size long")
    if slice_bytes is None:
        total = members.agg(F.sum(F.col("size") + 64)).first()[0] or 0
        slice_bytes = max(1, min(ZIP_SLICE_BYTES, total // spark.sparkContext.defaultParallelism))
    # where the member begins among its archive's; each weighs a little more than its bytes, for its header
    own = Window.partitionBy("archive")
    begins = F.sum(F.col("size") + 64).over(own.orderBy("place")) - F.col("size") - 64
    cut = members.withColumn("cut", F.floor(begins / F.lit(slice_bytes))).withColumn("part", F.dense_rank().over(own.orderBy("cut")) - 1)
    # one row per archive; numbers without gaps, so that each slice has a task of its own
    parts = cut.groupBy("archive").agg((F.max("part") + 1).alias("n"))
    before = F.sum("n").over(Window.orderBy("archive").rowsBetween(Window.unboundedPreceding, -1))
    first = parts.select("archive", F.coalesce(before, F.lit(0)).alias("first"))
    return cut.join(first, "archive").select("archive", "member", "place", (F.col("first") + F.col("part")).cast("int").alias("slice"))


def scan_zip_txt(spark: SparkSession, folder_or_glob: str) -> DataFrame:
    """ZIP-of-TXT scan (S3): every member ending ``.txt`` (any case, any
    depth) of every ``*.zip``; one row per member, empty members kept, no
    newline translation, strict UTF-8.

    Two steps, so one huge archive is not one task: the central directories
    are listed (metadata only), the members are cut into slices of even bytes,
    and each task reads its own slice with random access.  Order within an
    archive is the member name.
    """
    slices = zip_slices(spark, folder_or_glob)
    n = slices.agg(F.max("slice")).first()[0]
    # an id for each task: the shuffle carries only names, so sizes measured there would fold everything into one
    spread = slices.repartitionById((n or 0) + 1, "slice").sortWithinPartitions("archive", "place")
    return spread.select("archive", "member").mapInPandas(_zip_read, "archive string, member string, text string")


def scan_openers(spark: SparkSession, path: str, skip_header: bool = False) -> DataFrame:
    """Opener CSV scan (S6): ``think, respond``; extra fields ignored; rows
    with a missing or blank field dropped; both stripped.  ``opener_id`` is
    the 0-based position in (file name, row) order; ``skip_header`` leaves
    out each file's first record.  One file of any size, quoted newlines and
    all, is read by many tasks."""
    records = csv_records(spark, path)
    if skip_header:
        records = records.where("begin > 0 or seq > 0")
    order = ["path", "begin", "seq"]
    field = lambda i: F.try_element_at("fields", F.lit(i))
    stripped = computed_once(records, [plain_path("path").alias("path"), "begin", "seq"], think=py_strip(field(1)), respond=py_strip(field(2)))
    kept = stripped.where((F.length("think") > 0) & (F.length("respond") > 0))
    ordered = with_ordinal(kept, order, name="opener_id", persist_input=True)
    return ordered.select("opener_id", "think", "respond")


def read_scalar(spark: SparkSession, path: str) -> str:
    """A whole small text file as one stripped string (S7: system prompts)."""
    row = spark.read.text(path, wholetext=True).first()
    if row is None:
        raise FileNotFoundError(path)
    return row[0].strip()
