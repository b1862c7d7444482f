"""Token queries: frequency, distinct count, length distribution."""

from __future__ import annotations

from pyspark.sql import functions as F

from trainprep.functions.tokenizers import NATIVE_PATTERNS
from trainprep.operators.tokens import distinct_tokens, text_column, token_frequency, token_length_distribution
from trainprep.plans.registry import query
from trainprep.plans.tables import MESSAGE_TURNS_SQL, message_turns, table
from trainprep.plans.fixtures import write_parquet_parts
from trainprep.sources.parquet import corpus_scan, numbered_scan

WORD = NATIVE_PATTERNS["word"]
SPACE = NATIVE_PATTERNS["whitespace"]


@query(
    "token_freq",
    f"""
SELECT token, token AS text, count(*) AS count
FROM (SELECT unnest(regexp_extract_all(text, '{WORD}')) AS token FROM documents) t GROUP BY token
""",
)
def token_freq(spark, sf_dir):
    return token_frequency(table(spark, sf_dir, "documents"), "text", "word")


@query(
    "token_freq_whitespace",
    f"""
SELECT token, token AS text, count(*) AS count
FROM (SELECT unnest(regexp_extract_all(text, '{SPACE}')) AS token FROM conversations) t GROUP BY token
""",
)
def token_freq_whitespace(spark, sf_dir):
    return token_frequency(table(spark, sf_dir, "conversations"), "text", "whitespace")


@query(
    "token_distinct",
    f"""
SELECT count(DISTINCT token) AS n_distinct_tokens
FROM (SELECT unnest(regexp_extract_all(text, '{WORD}')) AS token FROM documents) t
""",
)
def token_distinct(spark, sf_dir):
    return distinct_tokens(table(spark, sf_dir, "documents"), "text", "word")


@query(
    "token_len_dist",
    f"""
WITH l AS (SELECT CAST(len(regexp_extract_all(text, '{WORD}')) AS BIGINT) AS n FROM documents)
SELECT count(*) AS n_rows, min(n) AS min_tokens, avg(n) AS mean_tokens, max(n) AS max_tokens,
       CAST(sum(n) AS BIGINT) AS total_tokens,
       quantile_cont(n, 0.5) AS p50_tokens, quantile_cont(n, 0.9) AS p90_tokens, quantile_cont(n, 0.99) AS p99_tokens
FROM l
""",
)
def token_len_dist(spark, sf_dir):
    return token_length_distribution(table(spark, sf_dir, "documents"), "text", "word")


@query(
    "text_nonnull",
    f"SELECT reasoning AS text FROM ({MESSAGE_TURNS_SQL}) m WHERE reasoning IS NOT NULL",
)
def text_nonnull(spark, sf_dir):
    """Token-counter input: a named column, nulls dropped, as string."""
    return text_column(message_turns(spark, sf_dir), "reasoning")


@query(
    "corpus_scan",
    "SELECT text FROM documents UNION ALL SELECT text FROM benchmark",
)
def corpus_scan_query(spark, sf_dir):
    """Sharder input: every parquet file must hold ``text``; only it is read."""
    d = sf_dir.rstrip("/")
    return corpus_scan(spark, [f"{d}/documents.parquet", f"{d}/benchmark.parquet"], "text")


@query(
    "token_json_roundtrip",
    f"""
SELECT token, token AS text, count(*) AS count
FROM (SELECT unnest(regexp_extract_all(text, '{WORD}')) AS token FROM documents) t GROUP BY token
""",
)
def token_json_roundtrip(spark, sf_dir):
    """Token counts written as JSON lines sorted by token (K3), read back."""
    from trainprep.session import scratch_dir

    out = scratch_dir(spark, "tokens")
    token_frequency(table(spark, sf_dir, "documents"), "text", "word").orderBy("token").write.json(out)
    return spark.read.schema("token string, text string, count long").json(out)


@query(
    "token_freq_parquet",
    f"""
SELECT token, token AS text, count(*) AS count
FROM (SELECT unnest(regexp_extract_all(text, '{WORD}')) AS token FROM documents WHERE doc_id % 9 <> 0) t GROUP BY token
""",
)
def token_freq_parquet(spark, sf_dir):
    """Token counts of a named column of parquet files, nulls left out; no
    text at all would be an error."""
    bodies = text_column(corpus_scan(spark, [write_parquet_parts(spark, sf_dir)], "body"), "body", require_rows=True)
    return token_frequency(bodies, "text", "word")


@query(
    "rows_in_file_order",
    "SELECT CAST(row_number() OVER (ORDER BY doc_id DESC) - 1 AS BIGINT) AS ord, doc_id, md5(text) AS text_md5 FROM documents",
)
def rows_in_file_order(spark, sf_dir):
    """Each row's place over all files of a folder, from the footers."""
    rows = numbered_scan(spark, [write_parquet_parts(spark, sf_dir)], ["doc_id", "text"])
    return rows.select("ord", "doc_id", F.md5("text").alias("text_md5"))
