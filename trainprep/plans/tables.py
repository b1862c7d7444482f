"""Reading the given tables and deriving the reference's in-memory inputs
from them by rule (FIXTURES.md part 2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trainprep.operators.chat import nest_turns


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, with the same plan at every size."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def message_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as messages: ``content = text``; assistant
    ``reasoning`` = the text, null where ``(conv_id + turn) % 11 = 0``;
    a user turn becomes role ``tool`` where ``(conv_id + turn) % 13 = 0``."""
    c = table(spark, sf_dir, "conversations")
    k = F.col("conv_id") + F.col("turn")
    return c.select(
        "conv_id",
        "turn",
        F.when((F.col("role") == "user") & (k % 13 == 0), F.lit("tool")).otherwise(F.col("role")).alias("role"),
        F.col("text").alias("content"),
        F.when((F.col("role") == "assistant") & (k % 11 != 0), F.col("text")).alias("reasoning"),
    )


def conversation_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(conv_id, messages)``: one row per conversation, turns in order."""
    return nest_turns(message_turns(spark, sf_dir))


# The same rule as SQL, shared by the oracles.
MESSAGE_TURNS_SQL = """
SELECT conv_id, turn,
       CASE WHEN role = 'user' AND (conv_id + turn) % 13 = 0 THEN 'tool' ELSE role END AS role,
       text AS content,
       CASE WHEN role = 'assistant' AND (conv_id + turn) % 11 <> 0 THEN text END AS reasoning
FROM conversations
"""
