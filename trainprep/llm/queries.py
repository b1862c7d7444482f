"""One query per operator over its whole table, with production parameters,
and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trainprep.llm import (
    byte_bpe,
    decontaminate,
    exact_topk,
    fingerprint,
    langid,
    lm_scoring,
    prefix_trie,
    secret_scan,
    sharding,
    simhash,
    source_audit,
    token_files,
    toxicity,
)
from trainprep.llm.common import documents, fold_is

QUERIES = {}
ORACLES = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _held(df: DataFrame, modulus: int, remainder: int) -> DataFrame:
    return df.withColumn("held_out", fold_is(modulus, remainder))


@_query
def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every document under a bigram model with deleted interpolation."""
    scored = lm_scoring.score(documents(spark, sf_dir), ~fold_is(7, 2))
    return _held(scored, 7, 2).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@_query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that stand in each document, with their word edits."""
    return decontaminate.contamination(documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"))


@_query
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded by byte-level BPE."""
    return byte_bpe.digests(documents(spark, sf_dir), byte_bpe.read_ranks(vocabulary_path("byte_bpe_multi_50k.tiktoken")))


@_query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by its nearest labelled examples."""
    docs, labels = documents(spark, sf_dir), _table(spark, sf_dir, "labels")
    model = toxicity.fit(toxicity.training_sample(docs, labels.where(~fold_is(5, 0))), whole=True)
    return _held(toxicity.score(docs, model), 5, 0).select("doc_id", "held_out", "score", "predicted", "evidence")


@_query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by segmentation-marginalised unigrams."""
    docs = documents(spark, sf_dir)
    model = langid.fit(docs.where(~fold_is(4, 2)), langid.read_pieces(vocabulary_path("piece_bpe_32k.model")))
    return _held(langid.predict(docs, model), 4, 2).select("doc_id", "held_out", "lang_pred", "score")


@_query
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, weak ones only beside complementary parts."""
    return secret_scan.digest(secret_scan.find(documents(spark, sf_dir)))


@_query
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of near equal bytes, equal texts together."""
    out = sharding.shard(documents(spark, sf_dir), 24)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@_query
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token ids, written to files and read back."""
    with open(vocabulary_path("byte_bpe_50k.json"), encoding="utf-8") as f:
        path = token_files.write(documents(spark, sf_dir), f.read(), end_id=2)
    return token_files.digests(token_files.read(spark, path))


@_query
def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth by integer inner product."""
    return exact_topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


ORACLES["op9_exact_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@_query
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash of every document and the component that links reach."""
    return simhash.near_duplicates(documents(spark, sf_dir), shingle=3, radius=2)


@_query
def op11_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances between the sources of each language, and each source's most overused terms."""
    return source_audit.audit(documents(spark, sf_dir), min_docs=30, top=50, scale=1_000_000_000)


ORACLES["op11_source_audit"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT row_id, lang, source,
    unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM d
), k AS (
  SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT row_id) >= 30
), c AS (
  SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY ALL
), v AS (
  SELECT lang, count(*) AS v FROM k GROUP BY lang
), g AS (
  SELECT g.lang, g.source, coalesce(sum(c.n), 0)::HUGEINT AS n, coalesce(any_value(v.v), 0) AS v
  FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN c USING (lang, source) LEFT JOIN v ON v.lang = g.lang
  GROUP BY g.lang, g.source
), p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (g.n + 5 * g.v) AS p
  FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)
), q AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY lang) + 5 * count(*) OVER (PARTITION BY lang)) AS q
  FROM (SELECT lang, term, sum(n)::HUGEINT AS n FROM c GROUP BY lang, term)
), f AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
), terms AS (
  SELECT p.lang, p.source, 'term' AS part, p.term AS item, (p.p - q.q)::BIGINT AS value FROM p JOIN q USING (lang, term) WHERE p.n > 0 AND p.p > q.q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INTEGER AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""


@_query
def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and of its edited text, and their likeness."""
    return fingerprint.compare_with_next(documents(spark, sf_dir))


@_query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of all conversations, rebuilt to share beginnings."""
    return prefix_trie.trie(prefix_trie.share_beginnings(prefix_trie.sequences(_table(spark, sf_dir, "conversations")), every=20, most=4))


ORACLES["op13_prefix_trie"] = r"""
WITH RECURSIVE tab(i, k, c) AS (
  SELECT i, 0, i FROM range(256) r(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM tab WHERE k < 8
), crc(conv_id, s, pos, v) AS (
  SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR), 0, 4294967295 FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL
  SELECT conv_id, s, pos + 1, xor(v >> 8, c) FROM crc JOIN tab ON k = 8 AND i = xor(v & 255, ascii(substr(s, pos + 1, 1))) WHERE pos < length(s)
), own AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST,
    md5(concat(octet_length(encode(coalesce(role, ''))), ':', coalesce(role, ''), coalesce(text, '')))) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), built AS (
  SELECT own.conv_id, coalesce(base.turns, own.turns[1:0])[1:h] || own.turns[h + 1:] AS turns
  FROM own JOIN (SELECT conv_id, xor(v, 4294967295) % 4 AS h FROM crc WHERE pos = length(s)) USING (conv_id)
  LEFT JOIN own base ON base.conv_id = own.conv_id - own.conv_id % 20
), begins AS (
  SELECT conv_id, len(turns) AS n, d, turns[1:d] AS path FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM built)
), node AS (
  SELECT d, path, min(conv_id) AS least, count(*) AS members,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = d), '')) AS ends_sha256,
    CASE WHEN d > 0 THEN len(regexp_extract_all(path[d].text, '[^\x20\x09-\x0D]+')) ELSE 0 END AS words
  FROM begins GROUP BY d, path
), child AS (
  SELECT d - 1 AS d, path[1:d - 1] AS path, count(*) AS n_children FROM node WHERE d > 0 GROUP BY ALL
), full_node AS (
  SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN child USING (d, path)
), below AS (
  SELECT a AS d, path[1:a] AS path, sum(CAST(n_children = 0 AS INT)) AS n_leaves, sum((members - 1) * words) AS saved
  FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM full_node) GROUP BY ALL
)
SELECT x.least AS conv_id, CAST(x.d AS BIGINT) AS depth, p.least AS parent_conv_id, x.members AS n_convs, CAST(x.n_children AS BIGINT) AS n_children,
  CAST(below.n_leaves AS BIGINT) AS n_leaves, CAST(below.saved AS BIGINT) AS saved_tokens, x.ends_sha256
FROM full_node x JOIN below ON below.d = x.d AND below.path = x.path LEFT JOIN node p ON p.d = x.d - 1 AND p.path = x.path[1:x.d - 1]
"""
