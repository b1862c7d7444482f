"""Golden strings for the reasoning fold and the chat template."""

import pytest

from trainprep.operators.chat import fold_reasoning, max_context, nest_turns, sft_text, sft_text_with_rejects
from trainprep.schemas import MESSAGES


def _df(spark, rows):
    return spark.createDataFrame([(1, rows)], f"id long, messages {MESSAGES.simpleString()}")


def test_render_golden(spark):
    msgs = [("system", "S", None), ("user", "hi", None), ("assistant", "yo", "why")]
    out = sft_text(_df(spark, msgs)).first().text
    assert out == (
        "<|im_start|>system\nS<|im_end|>\n"
        "<|im_start|>user\nhi<|im_end|>\n"
        "<|im_start|>assistant\n<think>\nwhy\n</think>\n\nyo<|im_end|>\n"
    )


def test_generation_prompt_and_unknown_roles(spark):
    msgs = [("tool", "x", None), ("user", "q", None)]
    out = sft_text(_df(spark, msgs), add_generation_prompt=True).first().text
    assert out == "<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\n<think>\n"


@pytest.mark.parametrize(
    "policy,expected",
    [
        ("empty", "<think>\n\n</think>\n\nA"),
        ("omit", "A"),
        ("literal", "<think>\nNone\n</think>\n\nA"),
    ],
)
def test_null_reasoning_policies(spark, policy, expected):
    df = _df(spark, [("assistant", "A", None)])
    got = df.select(fold_reasoning("messages", policy).alias("m")).first().m[0]
    assert got.content == expected and got.role == "assistant"


def test_null_reasoning_error(spark):
    df = _df(spark, [("assistant", "A", None)])
    with pytest.raises(Exception):
        df.select(fold_reasoning("messages", "error").alias("m")).collect()


def test_null_content_is_rejected_not_shortened(spark):
    df = spark.createDataFrame(
        [(1, [("user", None, None)]), (2, [("user", "ok", None)]), (3, [("tool", None, None)])],
        f"id long, messages {MESSAGES.simpleString()}",
    )
    good, bad = sft_text_with_rejects(df, keep=["id"])
    assert sorted(r.id for r in good.collect()) == [2, 3]
    assert [r.id for r in bad.collect()] == [1]


def test_nest_turns_orders_by_turn(spark):
    df = spark.createDataFrame(
        [(1, 2, "assistant", "c", "r"), (1, 0, "user", "a", None), (1, 1, "user", "b", None)],
        "conv_id long, turn long, role string, content string, reasoning string",
    )
    m = nest_turns(df).first().messages
    assert [x.content for x in m] == ["a", "b", "c"]


def test_max_context_floor_one(spark):
    df = spark.createDataFrame([("",)], "text string")
    assert max_context(df).first().max_context == 1
    df = spark.createDataFrame([("é日本",), ("ab",)], "text string")
    assert max_context(df).first().max_context == 3


def test_render_uses_no_python(spark):
    plan = sft_text(_df(spark, [("user", "x", None)]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan


def test_max_context_is_over_all_rows_before_the_split(spark):
    from trainprep.operators.ordinal import ordered_split, with_ordinal

    df = spark.createDataFrame([(i, "x" * (50 if i == 9 else 5)) for i in range(10)], "id long, text string")
    split = ordered_split(with_ordinal(df, ["id"]), "ord", 0.1)
    assert [r.id for r in split.where("split = 'test'").collect()] == [9]
    assert max_context(split).first().max_context == 50
