"""File-format queries: JSON / TXT / ZIP folders, opener CSV, chunk sinks.

Each query first writes the reference's file input from the given tables
(by rule, with Spark, into the shared scratch folder), then scans it with
the source under test.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from trainprep.functions.text import PY_WHITESPACE_CLASS, char_length
from trainprep.operators.curate import dedup_first
from trainprep.operators.ordinal import chunk_by_count, with_ordinal
from trainprep.operators.packing import pack_by_chars
from trainprep.plans.fixtures import (
    OPENERS_SQL,
    write_json_folder,
    write_openers_csv,
    write_parquet_parts,
    write_txt_folder,
    write_zip_folder,
)
from trainprep.plans.registry import query
from trainprep.plans.tables import MESSAGE_TURNS_SQL, table
from trainprep.session import scratch_dir
from trainprep.sinks.files import write_chunks
from trainprep.sources.files import scan_json_folder, scan_openers, scan_txt_folder, scan_zip_txt
from trainprep.sources.parquet import numbered_scan

FILES_PER_CHUNK = 10
PACK_LIMIT = 100_000
SHARD_LIMIT = 20_000

_NAME_SQL = "'conv_' || printf('%06d', conv_id) || '.json'"


def json_files(spark, sf_dir):
    return scan_json_folder(spark, write_json_folder(spark, sf_dir))


@query(
    "scan_json_folder",
    f"""
SELECT {_NAME_SQL} AS name, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS BIGINT) AS pos,
       role, content, reasoning
FROM ({MESSAGE_TURNS_SQL}) m WHERE conv_id % 10 NOT IN (3, 7)
UNION ALL
SELECT DISTINCT {_NAME_SQL} AS name, CAST(NULL AS BIGINT) AS pos, CAST(NULL AS VARCHAR) AS role,
       CAST(NULL AS VARCHAR) AS content, CAST(NULL AS VARCHAR) AS reasoning
FROM conversations WHERE conv_id % 10 = 3
""",
)
def scan_json_folder_query(spark, sf_dir):
    good = json_files(spark, sf_dir).where(F.col("status") != "corrupt")
    exploded = good.select("name", F.posexplode_outer("messages").alias("pos", "m"))
    return exploded.select(
        "name", F.col("pos").cast("long").alias("pos"), "m.role", "m.content", "m.reasoning"
    )


@query(
    "messages_default",
    f"""
SELECT {_NAME_SQL} AS name,
       CASE WHEN conv_id % 10 = 3 THEN 'missing_messages' ELSE 'ok' END AS status,
       CASE WHEN conv_id % 10 = 3 THEN 0 ELSE count(*) END AS n_messages
FROM conversations WHERE conv_id % 10 <> 7 GROUP BY conv_id
""",
)
def messages_default(spark, sf_dir):
    good = json_files(spark, sf_dir).where(F.col("status") != "corrupt")
    return good.select("name", "status", F.size("messages").cast("long").alias("n_messages"))


@query("json_rejects", f"SELECT DISTINCT {_NAME_SQL} AS name FROM conversations WHERE conv_id % 10 = 7")
def json_rejects(spark, sf_dir):
    return json_files(spark, sf_dir).where(F.col("status") == "corrupt").select("name")


@query(
    "json_chunks",
    f"""
SELECT name, ord, CAST(floor(ord / {FILES_PER_CHUNK}) AS BIGINT) AS chunk_id FROM (
  SELECT {_NAME_SQL} AS name, CAST(row_number() OVER (ORDER BY conv_id) - 1 AS BIGINT) AS ord
  FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id % 10 <> 7) c) x
""",
)
def json_chunks(spark, sf_dir):
    """Fixed-count chunks of good files, in file-name order (broken ones
    do not count)."""
    good = json_files(spark, sf_dir).where(F.col("status") != "corrupt").select("path", "name")
    ordered = with_ordinal(good, ["path"], persist_input=True)
    return chunk_by_count(ordered, "ord", FILES_PER_CHUNK).select("name", "ord", "chunk_id")


@query(
    "scan_txt_folder",
    """
SELECT printf('%06d', doc_id) || '.txt' AS name, text FROM documents WHERE doc_id % 9 <> 0
""",
)
def scan_txt_folder_query(spark, sf_dir):
    return scan_txt_folder(spark, write_txt_folder(spark, sf_dir)).select("name", "text")


@query(
    "pack_txt_folder",
    f"""
WITH RECURSIVE d AS (
  SELECT doc_id, CAST(row_number() OVER (ORDER BY doc_id) AS BIGINT) AS rn, CAST(length(text) AS BIGINT) AS len
  FROM documents WHERE doc_id % 9 <> 0),
r AS (
  SELECT rn, doc_id, len AS cur, CAST(0 AS BIGINT) AS chunk_id FROM d WHERE rn = 1
  UNION ALL
  SELECT d.rn, d.doc_id,
         CASE WHEN r.cur + d.len <= {PACK_LIMIT} THEN r.cur + d.len ELSE d.len END,
         CASE WHEN r.cur + d.len <= {PACK_LIMIT} THEN r.chunk_id ELSE r.chunk_id + 1 END
  FROM r JOIN d ON d.rn = r.rn + 1)
SELECT printf('%06d', doc_id) || '.txt' AS name, chunk_id FROM r
""",
)
def pack_txt_folder(spark, sf_dir):
    """TXT folder -> chunks of 100,000 characters, in file-name order."""
    files = scan_txt_folder(spark, write_txt_folder(spark, sf_dir))
    lens = files.select("path", "name", char_length("text").alias("len"))
    return pack_by_chars(lens, ["path"], "len", PACK_LIMIT, persist_input=True).select("name", "chunk_id")


_ZIP_MEMBERS_SQL = """
SELECT 'docs_' || printf('%04d', CAST(floor(doc_id / 250) AS BIGINT)) || '.zip' AS archive,
       CASE WHEN doc_id % 10 = 1 THEN printf('%06d', doc_id) || '.TXT'
            WHEN doc_id % 10 = 2 THEN 'sub/' || printf('%06d', doc_id) || '.txt'
            ELSE printf('%06d', doc_id) || '.txt' END AS member,
       CASE WHEN doc_id % 9 = 0 THEN '' WHEN doc_id % 7 = 0 THEN replace(text, chr(10), chr(13) || chr(10))
            ELSE text END AS text
FROM documents
"""


@query("scan_zip_txt", _ZIP_MEMBERS_SQL)
def scan_zip_txt_query(spark, sf_dir):
    members = scan_zip_txt(spark, write_zip_folder(spark, sf_dir))
    return members.select(F.element_at(F.split("archive", "/"), -1).alias("archive"), "member", "text")


def _strip_sql(col: str) -> str:
    ws = PY_WHITESPACE_CLASS
    return f"regexp_replace({col}, '^{ws}+|{ws}+$', '', 'g')"


_OPENERS_CLEAN_SQL = f"""
SELECT opener_id, {_strip_sql('think')} AS think, {_strip_sql('respond')} AS respond FROM ({OPENERS_SQL}) o
"""


def openers(spark, sf_dir):
    return scan_openers(spark, write_openers_csv(spark, sf_dir), skip_header=True)


@query("openers_clean", _OPENERS_CLEAN_SQL)
def openers_clean(spark, sf_dir):
    return openers(spark, sf_dir)


@query(
    "chunk_sink_roundtrip",
    f"""
WITH RECURSIVE d AS (
  SELECT doc_id, CAST(row_number() OVER (ORDER BY doc_id) AS BIGINT) AS rn, CAST(length(text) AS BIGINT) AS len FROM documents),
r AS (
  SELECT rn, doc_id, len, len AS cur, CAST(0 AS BIGINT) AS chunk_id FROM d WHERE rn = 1
  UNION ALL
  SELECT d.rn, d.doc_id, d.len,
         CASE WHEN r.cur + d.len <= {PACK_LIMIT} THEN r.cur + d.len ELSE d.len END,
         CASE WHEN r.cur + d.len <= {PACK_LIMIT} THEN r.chunk_id ELSE r.chunk_id + 1 END
  FROM r JOIN d ON d.rn = r.rn + 1)
SELECT 'chunk_' || printf('%06d', chunk_id) AS chunk, rn - 1 AS ord, md5(text) AS text_md5
FROM r JOIN documents USING (doc_id)
""",
)
def chunk_sink_roundtrip(spark, sf_dir):
    """Pack, write gzip parquet chunks (``chunk=chunk_000000``), read back with
    each row's place and text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    packed = pack_by_chars(docs, ["doc_id"], char_length("text"), PACK_LIMIT)
    out = scratch_dir(spark, "chunks")
    write_chunks(packed, out, "chunk_id", "ord", ["ord", "text"], range_ordered=True)
    return spark.read.parquet(out).select("chunk", "ord", F.md5("text").alias("text_md5"))


@query(
    "shard_sink_roundtrip",
    f"""
WITH RECURSIVE d AS (
  SELECT doc_id, CAST(row_number() OVER (ORDER BY doc_id) AS BIGINT) AS rn, CAST(length(text) AS BIGINT) AS len
  FROM (SELECT text, min(doc_id) AS doc_id FROM documents GROUP BY text) s),
r AS (
  SELECT rn, doc_id, len, CASE WHEN len >= {SHARD_LIMIT} THEN 0 ELSE len END AS cur, len >= {SHARD_LIMIT} AS closed,
         CAST(1 AS BIGINT) AS shard_id FROM d WHERE rn = 1
  UNION ALL
  SELECT d.rn, d.doc_id, d.len,
         CASE WHEN d.len >= {SHARD_LIMIT} THEN 0 WHEN r.closed OR r.cur + d.len > {SHARD_LIMIT} THEN d.len ELSE r.cur + d.len END,
         d.len >= {SHARD_LIMIT},
         CASE WHEN d.len >= {SHARD_LIMIT} OR r.closed OR r.cur + d.len > {SHARD_LIMIT} THEN r.shard_id + 1 ELSE r.shard_id END
  FROM r JOIN d ON d.rn = r.rn + 1)
SELECT 'part_' || printf('%04d', shard_id) AS shard, rn - 1 AS ord, md5(text) AS text_md5
FROM r JOIN documents USING (doc_id)
""",
)
def shard_sink_roundtrip(spark, sf_dir):
    """Dedup, shard with oversize isolation, write the shards, read back.

    Shards are many (one per 20,000 characters here, one per 10 M at the
    reference default), so they use the sorted layout: ``shard`` is a
    sorted column (``part_0001`` ...) instead of one folder per shard."""
    from trainprep.plans.corpus import deduped_documents

    deduped = deduped_documents(spark, sf_dir).select("doc_id", "text")
    sharded = pack_by_chars(deduped, ["doc_id"], char_length("text"), SHARD_LIMIT, isolate=True)
    out = scratch_dir(spark, "shards")
    write_chunks(
        sharded, out, "chunk_id", "ord", ["ord", "text"], partition_name="shard", prefix="part", width=4, base=1,
        range_ordered=True, layout="sorted",
    )
    return spark.read.parquet(out).select("shard", "ord", F.md5("text").alias("text_md5"))


@query(
    "sharder_flow",
    f"""
WITH RECURSIVE d AS (
  SELECT doc_id, CAST(row_number() OVER (ORDER BY doc_id DESC) AS BIGINT) AS rn, CAST(length(text) AS BIGINT) AS len
  FROM (SELECT text, max(doc_id) AS doc_id FROM documents GROUP BY text) s),
r AS (
  SELECT rn, doc_id, len, CASE WHEN len >= {SHARD_LIMIT} THEN 0 ELSE len END AS cur, len >= {SHARD_LIMIT} AS closed,
         CAST(1 AS BIGINT) AS shard_id FROM d WHERE rn = 1
  UNION ALL
  SELECT d.rn, d.doc_id, d.len,
         CASE WHEN d.len >= {SHARD_LIMIT} THEN 0 WHEN r.closed OR r.cur + d.len > {SHARD_LIMIT} THEN d.len ELSE r.cur + d.len END,
         d.len >= {SHARD_LIMIT},
         CASE WHEN d.len >= {SHARD_LIMIT} OR r.closed OR r.cur + d.len > {SHARD_LIMIT} THEN r.shard_id + 1 ELSE r.shard_id END
  FROM r JOIN d ON d.rn = r.rn + 1)
SELECT 'part_' || printf('%04d', shard_id) AS shard, rn - 1 AS place, md5(text) AS text_md5
FROM r JOIN documents USING (doc_id)
""",
)
def sharder_flow(spark, sf_dir):
    """The sharder end to end: a folder of parquet files, its rows in (file,
    row) order, the first of equal texts kept, shards of 20,000 characters
    written, read back with each text's place."""
    rows = numbered_scan(spark, [write_parquet_parts(spark, sf_dir)], ["text"])
    kept = dedup_first(rows, key="text", ord_col="ord")
    sharded = pack_by_chars(kept, [F.col("ord")], char_length("text"), SHARD_LIMIT, isolate=True, ord_name="place")
    out = scratch_dir(spark, "sharder")
    write_chunks(
        sharded, out, "chunk_id", "place", ["place", "text"], partition_name="shard", prefix="part", width=4, base=1, range_ordered=True, layout="sorted"
    )
    return spark.read.parquet(out).select("shard", "place", F.md5("text").alias("text_md5"))


@query(
    "json_chunk_sink",
    f"""
WITH f AS (SELECT conv_id, CASE WHEN conv_id % 10 = 3 THEN 0 ELSE count(*) END AS n_messages
           FROM conversations WHERE conv_id % 10 <> 7 GROUP BY conv_id),
o AS (SELECT n_messages, CAST(floor((row_number() OVER (ORDER BY conv_id) - 1) / {FILES_PER_CHUNK}) AS BIGINT) AS chunk_id FROM f)
SELECT 'chunk_' || printf('%06d', chunk_id) AS chunk, count(*) AS n_rows,
       CAST(sum(n_messages) AS BIGINT) AS n_messages
FROM o GROUP BY chunk_id
""",
)
def json_chunk_sink(spark, sf_dir):
    """JSON folder -> good files in name order -> chunks of 10 files
    written as gzip parquet with the ``messages`` column, read back."""
    good = json_files(spark, sf_dir).where(F.col("status") != "corrupt").select("path", "messages")
    chunked = chunk_by_count(with_ordinal(good, ["path"], persist_input=True), "ord", FILES_PER_CHUNK)
    out = scratch_dir(spark, "json_chunks")
    write_chunks(chunked, out, "chunk_id", "ord", ["messages"], range_ordered=True)
    back = spark.read.parquet(out)
    return back.groupBy("chunk").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.size("messages")).cast("long").alias("n_messages")
    )


@query(
    "pack_zip_txt",
    f"""
WITH RECURSIVE d AS (
  SELECT archive, member, CAST(row_number() OVER (ORDER BY archive, member) AS BIGINT) AS rn,
         CAST(length(text) AS BIGINT) AS len
  FROM ({_ZIP_MEMBERS_SQL}) z),
r AS (
  SELECT rn, archive, member, len AS cur, CAST(0 AS BIGINT) AS chunk_id FROM d WHERE rn = 1
  UNION ALL
  SELECT d.rn, d.archive, d.member,
         CASE WHEN r.cur + d.len <= {PACK_LIMIT} THEN r.cur + d.len ELSE d.len END,
         CASE WHEN r.cur + d.len <= {PACK_LIMIT} THEN r.chunk_id ELSE r.chunk_id + 1 END
  FROM r JOIN d ON d.rn = r.rn + 1)
SELECT archive, member, chunk_id FROM r
""",
)
def pack_zip_txt(spark, sf_dir):
    """ZIP mode of the text packer: members in (archive, name) order, empty
    members kept, raw newlines, chunks of 100,000 characters."""
    members = scan_zip_txt(spark, write_zip_folder(spark, sf_dir)).select(
        F.element_at(F.split("archive", "/"), -1).alias("archive"), "member", char_length("text").alias("len")
    )
    packed = pack_by_chars(members, ["archive", "member"], "len", PACK_LIMIT, persist_input=True)
    return packed.select("archive", "member", "chunk_id")
