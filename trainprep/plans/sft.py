"""SFT / CPT dataset queries (conversations, documents)."""

from __future__ import annotations

from pyspark.sql import functions as F

from trainprep.operators.chat import cpt_text, fold_reasoning, max_context, sft_text
from trainprep.plans.registry import query
from trainprep.plans.tables import MESSAGE_TURNS_SQL, conversation_messages, table

_RENDER_PIECE_SQL = """
CASE WHEN role IN ('system', 'user') THEN '<|im_start|>' || role || chr(10) || content || '<|im_end|>' || chr(10)
     WHEN role = 'assistant' THEN '<|im_start|>assistant' || chr(10) || '<think>' || chr(10) || coalesce(reasoning, '')
          || chr(10) || '</think>' || chr(10) || chr(10) || content || '<|im_end|>' || chr(10)
     ELSE '' END
"""

RENDER_SFT_SQL = f"""
WITH m AS ({MESSAGE_TURNS_SQL})
SELECT conv_id, string_agg({_RENDER_PIECE_SQL}, '' ORDER BY turn) AS text
FROM m GROUP BY conv_id
"""


@query("render_sft", RENDER_SFT_SQL)
def render_sft(spark, sf_dir):
    """Flagship: conversations -> messages -> reasoning fold -> chat template."""
    return sft_text(conversation_messages(spark, sf_dir), keep=["conv_id"])


@query(
    "render_genprompt",
    f"""
WITH m AS ({MESSAGE_TURNS_SQL})
SELECT conv_id, string_agg({_RENDER_PIECE_SQL}, '' ORDER BY turn) || '<|im_start|>assistant' || chr(10) || '<think>' || chr(10) AS text
FROM m GROUP BY conv_id
""",
)
def render_genprompt(spark, sf_dir):
    return sft_text(conversation_messages(spark, sf_dir), keep=["conv_id"], add_generation_prompt=True)


@query(
    "reasoning_fold",
    f"""
WITH m AS ({MESSAGE_TURNS_SQL})
SELECT conv_id,
       CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS BIGINT) AS pos,
       role,
       CASE WHEN role = 'assistant'
            THEN '<think>' || chr(10) || coalesce(reasoning, '') || chr(10) || '</think>' || chr(10) || chr(10) || content
            ELSE content END AS content
FROM m
""",
)
def reasoning_fold(spark, sf_dir):
    return _folded(spark, sf_dir, "empty")


def _folded(spark, sf_dir, policy):
    folded = conversation_messages(spark, sf_dir).select("conv_id", fold_reasoning("messages", policy).alias("m"))
    return folded.select("conv_id", F.posexplode("m").alias("pos", "msg")).select(
        "conv_id", F.col("pos").cast("long").alias("pos"), "msg.role", "msg.content"
    )


@query(
    "reasoning_literal",
    f"""
WITH m AS ({MESSAGE_TURNS_SQL})
SELECT conv_id,
       CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS BIGINT) AS pos,
       role,
       CASE WHEN role = 'assistant'
            THEN '<think>' || chr(10) || coalesce(reasoning, 'None') || chr(10) || '</think>' || chr(10) || chr(10) || content
            ELSE content END AS content
FROM m
""",
)
def reasoning_literal(spark, sf_dir):
    """A missing reasoning printed as Python prints it."""
    return _folded(spark, sf_dir, "literal")


@query(
    "max_context",
    f"""
WITH r AS ({RENDER_SFT_SQL})
SELECT CAST(greatest(1, max(length(text))) AS BIGINT) AS max_context FROM r
""",
)
def max_context_sft(spark, sf_dir):
    """Longest rendered SFT text in characters, over all rows (before the split)."""
    return max_context(render_sft(spark, sf_dir))


@query("cpt_text", "SELECT text FROM documents")
def cpt_text_query(spark, sf_dir):
    return cpt_text(table(spark, sf_dir, "documents"))


@query(
    "cpt_max_context",
    "SELECT CAST(greatest(1, max(length(text))) AS BIGINT) AS max_context FROM documents",
)
def cpt_max_context(spark, sf_dir):
    return max_context(cpt_text(table(spark, sf_dir, "documents")))


@query(
    "sft_split",
    f"""
WITH r AS ({RENDER_SFT_SQL}),
o AS (SELECT conv_id, text, CAST(row_number() OVER (ORDER BY conv_id) - 1 AS BIGINT) AS ord, count(*) OVER () AS n FROM r)
SELECT ord, text, CASE WHEN ord < n - CAST(ceil(CAST(0.1 AS DOUBLE) * n) AS BIGINT) THEN 'train' ELSE 'test' END AS split
FROM o
""",
)
def sft_split(spark, sf_dir):
    """The SFT entry flow: a JSON-lines dataset of ``messages`` (written from
    the conversations in conv_id order) -> load by format -> SFT mapper
    (source columns dropped) -> ordered split, last 10% test."""
    from trainprep.operators.ordinal import ordered_split, with_ordinal
    from trainprep.schemas import CONVERSATION_FILE
    from trainprep.session import scratch_dir
    from trainprep.sources.files import load_dataset

    out = scratch_dir(spark, "sft_dataset")
    conv = conversation_messages(spark, sf_dir)
    conv.repartitionByRange("conv_id").sortWithinPartitions("conv_id").select("messages").write.json(out)
    data = load_dataset(spark, out, fmt="json", schema=CONVERSATION_FILE).select(
        "messages",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )
    ordered = with_ordinal(data, ["_file", "_block", "_row"], total="n")
    rendered = sft_text(ordered, keep=["ord", "n"])
    return ordered_split(rendered, "ord", 0.1, n="n")
