"""The corpus pipeline: documents to token ids in five stages.

Each stage takes the documents that its predecessor kept (written as Parquet
and read again) and calls one operator of ``trainprep.llm``.  All stages but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trainprep.llm import byte_bpe, decontaminate, secret_scan, simhash, toxicity
from trainprep.llm.common import fold_is
from trainprep.llm.queries import vocabulary_path
from trainprep.session import ensure_checkpoint_dir, scratch_dir, ship_package


def _ready(spark: SparkSession) -> None:
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _carried(docs: DataFrame) -> DataFrame:
    """Id and text, and the other values of the row as one struct, so that
    no column of the user's meets a name of an operator's."""
    return docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("carried"))


def _unpacked(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, in their order."""
    return rows.select(*[F.col("text") if c == "text" else F.col("carried").getField(c).alias(c) for c in docs.columns])


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator does not predict as toxic."""
    _ready(spark)
    rows = _carried(docs)
    model = toxicity.fit(toxicity.training_sample(rows.select("doc_id", "text"), _table(spark, sf_dir, "labels").where(~fold_is(5, 0))), whole=True)
    return _unpacked(toxicity.score(rows, model, extra=["carried", "text"]).where("predicted = 0"), docs)


def keep_one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every SimHash component: that of smallest id (a null
    id comes last), of rows with one id that of the least digest of its
    values."""
    _ready(spark)
    rows = _carried(docs)
    row = F.unhex(F.sha2(F.to_json(F.struct("text", "carried"), {"ignoreNullFields": "false"}), 256))
    found = simhash.grouped(rows, shingle=3, radius=2, key=row)
    best = found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull(), "id", "key")).alias("m"))
    kept = rows.select(row.alias("row"), "text", "carried").join(best.select(F.col("m.key").alias("row")), "row", "left_semi")
    # equal rows have one digest
    return _unpacked(kept.dropDuplicates(["row"]), docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    _ready(spark)
    found = decontaminate.contamination(_carried(docs), _table(spark, sf_dir, "benchmark"), extra=["carried", "text"])
    return _unpacked(found.where("not contaminated"), docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, reported secrets replaced by a mask."""
    _ready(spark)
    masked = secret_scan.redact(docs)
    return masked.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else masked


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digests of the round trip."""
    _ready(spark)
    ranks = byte_bpe.read_ranks(vocabulary_path("byte_bpe_multi_50k.tiktoken"))
    coded = byte_bpe.encode(docs, ranks, decoded=True)
    return coded.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", keep_clean),
    ("simhash_near_dedup", keep_one_per_group),
    ("decontamination", drop_contaminated),
    ("secret_scan", mask_secrets),
    ("byte_bpe", to_tokens),
]

#: No stage before the last is expressible in SQL; tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    _ready(spark)
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
