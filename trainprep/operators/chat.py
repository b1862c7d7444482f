"""Conversation operators: nesting turns, the reasoning fold, the chat
template, and the SFT / CPT row mappers.

All of them are column expressions over ``array<struct<role, content,
reasoning>>``; rendering a conversation never leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trainprep.functions.text import char_length
from trainprep.operators.columns import computed_once
from trainprep.schemas import MESSAGES

# The literal pieces of the shipped chat template.  Roles other
# than these three render nothing; the generation prompt opens a think block.
TEMPLATE_ROLES = ("system", "user", "assistant")
MESSAGE_START = "<|im_start|>"
MESSAGE_END = "<|im_end|>\n"
GENERATION_PROMPT = "<|im_start|>assistant\n<think>\n"
THINK_OPEN = "<think>\n"
THINK_CLOSE = "\n</think>\n\n"

NULL_REASONING_POLICIES = ("empty", "omit", "literal", "error")


def nest_turns(
    df: DataFrame,
    key: str = "conv_id",
    order: str = "turn",
    fields: Sequence[str] = ("role", "content", "reasoning"),
    out: str = "messages",
) -> DataFrame:
    """Flat turn rows -> one row per conversation with an ordered array.

    One hash shuffle on ``key``; each output row holds exactly one
    conversation, so the collected array is bounded by that row.
    """
    item = F.struct(F.col(order).alias("_order"), *[F.col(f) for f in fields])
    grouped = df.groupBy(key).agg(F.array_sort(F.collect_list(item)).alias("_items"))
    return grouped.select(
        key,
        F.transform("_items", lambda m: F.struct(*[m[f].alias(f) for f in fields])).alias(out),
    )


def messages_or_empty(c: Column, present: Column) -> Column:
    """Missing ``messages`` key -> empty list; an explicit null stays null."""
    return F.when(~present, F.array().cast(MESSAGES)).otherwise(c)


def fold_reasoning(messages: str | Column, on_null_reasoning: str = "empty") -> Column:
    """Assistant content becomes ``<think>\\n{reasoning}\\n</think>\\n\\n{content}``.

    Other roles keep their content and lose ``reasoning``.  A null
    reasoning follows ``on_null_reasoning``: ``empty`` (empty think block),
    ``omit`` (no think block), ``literal`` (the word ``None``, as a Python
    f-string prints it) or ``error`` (fail the job).
    """
    if on_null_reasoning not in NULL_REASONING_POLICIES:
        raise ValueError(f"on_null_reasoning must be one of {NULL_REASONING_POLICIES}")
    msgs = F.col(messages) if isinstance(messages, str) else messages

    def fold(m: Column) -> Column:
        reasoning = m["reasoning"]
        if on_null_reasoning == "empty":
            reasoning = F.coalesce(reasoning, F.lit(""))
        elif on_null_reasoning == "literal":
            reasoning = F.coalesce(reasoning, F.lit("None"))
        elif on_null_reasoning == "error":
            reasoning = F.coalesce(reasoning, F.raise_error(F.lit("assistant message without reasoning")))
        think = F.concat(F.lit(THINK_OPEN), reasoning, F.lit(THINK_CLOSE), m["content"])
        if on_null_reasoning == "omit":
            think = F.when(m["reasoning"].isNull(), m["content"]).otherwise(think)
        content = F.when(m["role"] == "assistant", think).otherwise(m["content"])
        return F.struct(m["role"].alias("role"), content.alias("content"))

    return F.transform(msgs, fold)


def render_chat(messages: str | Column, add_generation_prompt: bool = False) -> Column:
    """The chat template: ``<|im_start|>{role}\\n{content}<|im_end|>\\n`` per
    message of a known role, concatenated.

    A kept message with null content makes the whole result null (the
    template would fail); ``array_join`` alone would silently drop it.
    """
    msgs = F.col(messages) if isinstance(messages, str) else messages
    kept = F.filter(msgs, lambda m: m["role"].isin(*TEMPLATE_ROLES))
    pieces = F.transform(
        kept, lambda m: F.concat(F.lit(MESSAGE_START), m["role"], F.lit("\n"), m["content"], F.lit(MESSAGE_END))
    )
    text = F.array_join(pieces, "")
    if add_generation_prompt:
        text = F.concat(text, F.lit(GENERATION_PROMPT))
    return F.when(F.exists(kept, lambda m: m["content"].isNull()), F.lit(None).cast("string")).otherwise(text)


def sft_text(
    df: DataFrame,
    messages: str = "messages",
    keep: Sequence[str] = (),
    on_null_reasoning: str = "empty",
    add_generation_prompt: bool = False,
) -> DataFrame:
    """SFT row mapper: fold reasoning, render, drop the source columns.

    ``keep`` names columns (ids) to carry along; the reference keeps none.
    """
    text = render_chat(fold_reasoning(messages, on_null_reasoning), add_generation_prompt)
    return df.select(*keep, text.alias("text"))


def sft_text_with_rejects(df: DataFrame, messages: str = "messages", keep: Sequence[str] = (), **kw) -> tuple[DataFrame, DataFrame]:
    """``sft_text`` split into rendered rows and rows that could not render
    (each conversation is rendered once, whatever filters follow)."""
    on_null = kw.get("on_null_reasoning", "empty")
    text = render_chat(fold_reasoning(messages, on_null), kw.get("add_generation_prompt", False))
    out = computed_once(df, [*keep, messages], text=text)
    good = out.where(F.col("text").isNotNull()).drop(messages)
    rejects = out.where(F.col("text").isNull()).drop("text")
    return good, rejects


def cpt_text(df: DataFrame, text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """CPT row mapper: the text passes through, other columns are dropped."""
    return df.select(*keep, F.col(text).alias("text"))


def max_context(df: DataFrame, text: str = "text") -> DataFrame:
    """Longest text in code points, floor 1, as one row ``max_context``.

    Note: characters, not tokens (``token_length_distribution`` gives tokens).
    """
    return df.agg(F.greatest(F.lit(1).cast("long"), F.max(char_length(text))).alias("max_context"))


def apply_mapper(df: DataFrame, mapper, **args) -> DataFrame:
    """The pluggable row mapper: any ``DataFrame -> DataFrame`` function,
    with its arguments."""
    return df.transform(mapper, **args)
