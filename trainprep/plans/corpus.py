"""Ordered corpus queries over ``documents``: ordinal, split, chunking,
dedup, shuffle, packing, sharding, union."""

from __future__ import annotations

from pyspark.sql import functions as F

from trainprep.functions.text import char_length
from trainprep.operators.chat import cpt_text
from trainprep.operators.curate import dedup_first, dedup_stats, seeded_shuffle, shuffle_key, union_all
from trainprep.operators.ordinal import chunk_by_count, ordered_split, with_ordinal
from trainprep.operators.packing import chunk_stats, pack_by_chars
from trainprep.plans.registry import query
from trainprep.plans.tables import table

# Parameters of the registered queries (the reference defaults where the
# data allows; see FIXTURES.md for the packing limits).
FILES_PER_CHUNK = 100
TEST_SIZE = 0.1
SHUFFLE_SEED = 42
PACK_LIMIT = 100_000
SHARD_LIMIT = 20_000


def documents(spark, sf_dir):
    return table(spark, sf_dir, "documents")


def deduped_documents(spark, sf_dir):
    """Documents without exact text copies, the first (lowest ``doc_id``) kept."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return dedup_first(docs, key="text", ord_col="doc_id", copies="copies")


def deduped_ids(spark, sf_dir, **of_text):
    """As :func:`deduped_documents` without the texts: ``doc_id``, ``copies``,
    ``len`` and any other value computed from the text.  Copies meet by
    their digest and length, so no text is shuffled."""
    docs = documents(spark, sf_dir).select(
        "doc_id", F.sha2("text", 256).alias("digest"), char_length("text").alias("len"), *[c.alias(n) for n, c in of_text.items()]
    )
    return dedup_first(docs, key=["digest", "len", *of_text], ord_col="doc_id", copies="copies")


@query(
    "global_ordinal",
    "SELECT doc_id, CAST(row_number() OVER (ORDER BY doc_id) - 1 AS BIGINT) AS ord FROM documents",
)
def global_ordinal(spark, sf_dir):
    return with_ordinal(documents(spark, sf_dir).select("doc_id"), ["doc_id"])


@query(
    "train_test_split",
    f"""
WITH o AS (SELECT doc_id, CAST(row_number() OVER (ORDER BY doc_id) - 1 AS BIGINT) AS ord, count(*) OVER () AS n FROM documents)
SELECT doc_id, ord, CASE WHEN ord < n - CAST(ceil(CAST({TEST_SIZE} AS DOUBLE) * n) AS BIGINT) THEN 'train' ELSE 'test' END AS split
FROM o
""",
)
def train_test_split(spark, sf_dir):
    ordered = with_ordinal(documents(spark, sf_dir).select("doc_id"), ["doc_id"], total="n")
    return ordered_split(ordered, "ord", TEST_SIZE, n="n")


@query(
    "chunk_by_count",
    f"""
SELECT doc_id, CAST(floor((row_number() OVER (ORDER BY doc_id) - 1) / {FILES_PER_CHUNK}) AS BIGINT) AS chunk_id
FROM documents
""",
)
def chunk_by_count_query(spark, sf_dir):
    ordered = with_ordinal(documents(spark, sf_dir).select("doc_id"), ["doc_id"])
    return chunk_by_count(ordered, "ord", FILES_PER_CHUNK).select("doc_id", "chunk_id")


@query("dedup_exact", "SELECT min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY text")
def dedup_exact(spark, sf_dir):
    return deduped_ids(spark, sf_dir).select("doc_id", "copies")


@query(
    "dedup_stats",
    """
SELECT CAST(count(*) AS BIGINT) AS n_in, CAST(count(DISTINCT text) AS BIGINT) AS n_out,
       CAST(count(*) - count(DISTINCT text) AS BIGINT) AS n_removed
FROM documents
""",
)
def dedup_stats_query(spark, sf_dir):
    return dedup_stats(deduped_ids(spark, sf_dir), "copies")


@query(
    "seeded_shuffle",
    f"""
WITH d AS (SELECT text, min(doc_id) AS doc_id FROM documents GROUP BY text)
SELECT doc_id, CAST(row_number() OVER (ORDER BY md5('{SHUFFLE_SEED}:' || text), doc_id) - 1 AS BIGINT) AS pos FROM d
""",
)
def seeded_shuffle_query(spark, sf_dir):
    keyed = deduped_ids(spark, sf_dir, _key=shuffle_key("text", SHUFFLE_SEED)).select("doc_id", "_key")
    return seeded_shuffle(keyed, ord_col="doc_id", key="_key", keep=["doc_id"]).select("doc_id", "pos")


def _pack_sql(source: str, order: str, limit: int) -> str:
    """Sequential append-or-flush as a recursive CTE (the oracle for W3)."""
    return f"""
WITH RECURSIVE d AS (
  SELECT doc_id, CAST(row_number() OVER (ORDER BY {order}) AS BIGINT) AS rn, CAST(length(text) AS BIGINT) AS len
  FROM ({source}) s),
r AS (
  SELECT rn, doc_id, len, len AS cur, CAST(0 AS BIGINT) AS chunk_id FROM d WHERE rn = 1
  UNION ALL
  SELECT d.rn, d.doc_id, d.len,
         CASE WHEN r.cur + d.len <= {limit} THEN r.cur + d.len ELSE d.len END,
         CASE WHEN r.cur + d.len <= {limit} THEN r.chunk_id ELSE r.chunk_id + 1 END
  FROM r JOIN d ON d.rn = r.rn + 1)
"""


def _shard_sql(source: str, order: str, limit: int) -> str:
    """Sequential sharding with oversize isolation (the oracle for W4)."""
    return f"""
WITH RECURSIVE d AS (
  SELECT doc_id, CAST(row_number() OVER (ORDER BY {order}) AS BIGINT) AS rn, CAST(length(text) AS BIGINT) AS len
  FROM ({source}) s),
r AS (
  SELECT rn, doc_id, len, CASE WHEN len >= {limit} THEN 0 ELSE len END AS cur, len >= {limit} AS closed,
         CAST(1 AS BIGINT) AS shard_id
  FROM d WHERE rn = 1
  UNION ALL
  SELECT d.rn, d.doc_id, d.len,
         CASE WHEN d.len >= {limit} THEN 0 WHEN r.closed OR r.cur + d.len > {limit} THEN d.len ELSE r.cur + d.len END,
         d.len >= {limit},
         CASE WHEN d.len >= {limit} OR r.closed OR r.cur + d.len > {limit} THEN r.shard_id + 1 ELSE r.shard_id END
  FROM r JOIN d ON d.rn = r.rn + 1)
"""


_DEDUP_SQL = "SELECT text, min(doc_id) AS doc_id FROM documents GROUP BY text"


@query(
    "pack_chars",
    _pack_sql("SELECT doc_id, text FROM documents", "doc_id", PACK_LIMIT)
    + "SELECT doc_id, rn - 1 AS ord, chunk_id FROM r",
)
def pack_chars(spark, sf_dir):
    """TXT-style packing: documents in name (doc_id) order, 100,000 characters."""
    # only (id, length) is packed: the checkpoint never holds the text
    lens = documents(spark, sf_dir).select("doc_id", char_length("text").alias("len"))
    return pack_by_chars(lens, ["doc_id"], "len", PACK_LIMIT).select("doc_id", "ord", "chunk_id")


@query(
    "chunk_stats",
    _pack_sql("SELECT doc_id, text FROM documents", "doc_id", PACK_LIMIT)
    + "SELECT chunk_id, count(*) AS n_rows, CAST(sum(len) AS BIGINT) AS n_chars FROM r GROUP BY chunk_id",
)
def chunk_stats_query(spark, sf_dir):
    lens = documents(spark, sf_dir).select("doc_id", char_length("text").alias("len"))
    return chunk_stats(pack_by_chars(lens, ["doc_id"], "len", PACK_LIMIT), length="len")


@query(
    "shard_chars",
    _shard_sql(_DEDUP_SQL, "doc_id", SHARD_LIMIT) + "SELECT doc_id, shard_id FROM r",
)
def shard_chars(spark, sf_dir):
    """Sharder: dedup, keep order, shards of 20,000 characters, 1-based ids."""
    lens = deduped_ids(spark, sf_dir).select("doc_id", "len")
    sharded = pack_by_chars(lens, ["doc_id"], "len", SHARD_LIMIT, isolate=True)
    return sharded.select("doc_id", (F.col("chunk_id") + 1).alias("shard_id"))


@query(
    "shard_shuffled",
    _shard_sql(_DEDUP_SQL, f"md5('{SHUFFLE_SEED}:' || text), doc_id", SHARD_LIMIT) + "SELECT doc_id, shard_id FROM r",
)
def shard_shuffled(spark, sf_dir):
    """Sharder with ``--shuffle``: dedup, seeded shuffle, then shards."""
    keyed = deduped_ids(spark, sf_dir, _key=shuffle_key("text", SHUFFLE_SEED)).select("doc_id", "_key", "len")
    sharded = pack_by_chars(keyed, ["_key", "doc_id"], "len", SHARD_LIMIT, isolate=True)
    return sharded.select("doc_id", (F.col("chunk_id") + 1).alias("shard_id"))


@query(
    "corpus_union",
    """
SELECT 'documents' AS src, doc_id AS id, text FROM documents
UNION ALL SELECT 'benchmark' AS src, item_id AS id, text FROM benchmark
UNION ALL SELECT 'conversations' AS src, conv_id * 1000 + turn AS id, text FROM conversations
""",
)
def corpus_union(spark, sf_dir):
    parts = [
        table(spark, sf_dir, "documents").select(F.lit("documents").alias("src"), F.col("doc_id").alias("id"), "text"),
        table(spark, sf_dir, "benchmark").select(F.lit("benchmark").alias("src"), F.col("item_id").alias("id"), "text"),
        table(spark, sf_dir, "conversations").select(
            F.lit("conversations").alias("src"), (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "text"
        ),
    ]
    return union_all(parts)


@query("load_dataset", "SELECT text FROM documents")
def load_dataset_query(spark, sf_dir):
    """Generic load by suffix (parquet here) + the CPT mapper."""
    from trainprep.sources.files import load_dataset

    return cpt_text(load_dataset(spark, f"{sf_dir.rstrip('/')}/documents.parquet"))


@query("load_dataset_json", "SELECT doc_id, text, lang FROM documents")
def load_dataset_json(spark, sf_dir):
    """JSON files that hold one array each (100 documents by id), loaded
    by format."""
    from trainprep.session import scratch_dir
    from trainprep.sinks.files import write_files
    from trainprep.sources.files import load_dataset

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    block = F.floor(F.col("doc_id") / 100).cast("long")
    arrays = docs.groupBy(block.alias("block")).agg(
        F.to_json(F.collect_list(F.struct("doc_id", "text", "lang")), {"ignoreNullFields": "false"}).alias("content")
    )
    out = scratch_dir(spark, "json_arrays")
    write_files(arrays.select(F.format_string("block_%06d.json", "block").alias("name"), "content"), out).collect()
    return load_dataset(spark, out, fmt="json").select("doc_id", "text", "lang")


@query("load_mapped", "SELECT text FROM documents")
def load_mapped_query(spark, sf_dir):
    """A dataset through the CPT mapper, kept on disk and loaded again from there."""
    from trainprep.session import scratch_dir
    from trainprep.sources.kept import load_mapped

    path, cache = f"{sf_dir.rstrip('/')}/documents.parquet", scratch_dir(spark, "mapped")
    load_mapped(spark, path, cpt_text, load_from_cache=True, cache_dir=cache)
    return load_mapped(spark, path, cpt_text, load_from_cache=True, cache_dir=cache)
