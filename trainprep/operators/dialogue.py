"""Dialogue tables (J1, J2, C1-C4) over a replies table
``(session, turn, agent, raw)`` however the replies were produced.

Outputs are message rows ``(session, pos, role, ...)``; :func:`nest_by`
gives the nested per-session form.  A session is one bounded group
(``2 * turns + 1`` messages), so nesting it per session is safe.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trainprep.functions.text import json_query, json_reply
from trainprep.operators.columns import computed_once


def _is_string(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v) == "STRING", F.lit(False))


def validate_replies(replies: DataFrame, raw: str = "raw") -> DataFrame:
    """C4: a reply is valid when it is a JSON object whose ``reasoning`` and
    ``responding`` are both present and strings.  Adds ``reasoning``,
    ``responding`` (null when invalid) and ``valid``."""
    keep = replies.columns
    parsed = computed_once(replies, keep, _v=F.try_parse_json(F.col(raw)))
    v = F.col("_v")
    fields = computed_once(
        parsed, keep,
        _r=F.variant_get(v, "$.reasoning", "variant"), _s=F.variant_get(v, "$.responding", "variant"), _ok=v.isNotNull(),
    )
    r, s = F.col("_r"), F.col("_s")
    valid = F.col("_ok") & _is_string(r) & _is_string(s)
    return computed_once(
        fields, keep,
        reasoning=F.when(valid, F.variant_get(r, "$", "string")),
        responding=F.when(valid, F.variant_get(s, "$", "string")),
        valid=valid,
    )


def assign_openers(sessions: DataFrame, openers: DataFrame, n_openers: int, session: str = "session") -> DataFrame:
    """Session ``i`` (1-based) gets opener ``(i - 1) mod n``.  An
    equi-join on a computed key; AQE broadcasts the opener table only when
    its measured size is under the broadcast threshold."""
    if n_openers < 1:
        raise ValueError("no opening lines")
    keyed = sessions.withColumn("opener_id", F.pmod(F.col(session) - 1, F.lit(n_openers)).cast("long"))
    return keyed.join(openers, "opener_id")


def complete_sessions(replies: DataFrame, turns: int, sessions: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Sessions with every needed reply valid (``turns`` from A, ``turns - 1``
    from B) and the rejected ones with the reason.

    ``sessions`` lists the sessions asked for (default: those of any reply);
    one without a needed reply is a ``missing_reply``.  With no turns no
    reply is needed: every session is complete.
    """
    if turns < 0:
        raise ValueError("turns must be >= 0")
    if turns == 0:
        asked = (replies if sessions is None else sessions).select("session").distinct()
        return asked, asked.where(F.lit(False)).select("session", F.lit("").alias("reason"))
    need = F.when(F.col("agent") == "A", F.col("turn") < turns).otherwise(F.col("turn") < turns - 1)
    need = F.coalesce(need, F.lit(False))
    # two partial aggregates: a session of very many rows is small after the
    # first; a reply that is not needed only tells that its session is asked for
    places = (replies if sessions is None else replies.where(need)).groupBy("session", "turn", "agent").agg(
        F.count(F.when(need & F.col("valid"), 1)).alias("v"), F.count(F.when(need, 1)).alias("n")
    ).select("session", "v", "n")
    if sessions is not None:
        none = F.lit(0).cast("long")
        places = places.unionByName(sessions.select("session", none.alias("v"), none.alias("n")))
    stats = places.groupBy("session").agg(
        F.sum("v").alias("n_valid"), F.sum("n").alias("n_used"), F.count_if(F.col("n") > 0).alias("n_places")
    )
    whole = F.col("n_places") == 2 * turns - 1
    ok = (F.col("n_valid") == F.col("n_used")) & whole & (F.col("n_used") == F.col("n_places"))
    good = stats.where(ok).select("session")
    bad = stats.where(~ok).select(
        "session",
        F.when(F.col("n_valid") < F.col("n_used"), "invalid_reply")
        .when(~whole, "missing_reply")
        .otherwise("duplicate_reply")
        .alias("reason"),
    )
    return good, bad


def _turn_rows(replies: DataFrame, turns: int, a_role: str, a_content: Column, a_reasoning: Column | None,
               b_role: str, b_content: Column, b_reasoning: Column | None) -> DataFrame:
    is_a = F.col("agent") == "A"
    keep = F.when(is_a, F.col("turn") < turns).otherwise(F.col("turn") < turns - 1)
    pos = F.when(is_a, F.col("turn") * 2 + 2).otherwise(F.col("turn") * 2 + 3).cast("long")
    cols = [
        "session",
        pos.alias("pos"),
        F.when(is_a, F.lit(a_role)).otherwise(F.lit(b_role)).alias("role"),
    ]
    if a_reasoning is not None:
        cols.append(F.when(is_a, a_reasoning).otherwise(b_reasoning).alias("reasoning"))
    cols.append(F.when(is_a, a_content).otherwise(b_content).alias("content"))
    return replies.where(keep).select(*cols)


def transcript(replies: DataFrame, session_openers: DataFrame, prompt_a: str, turns: int) -> DataFrame:
    """The saved conversation.  system(prompt_a), user(opener respond),
    then per turn assistant(A, with reasoning) and, except after the last
    turn, user(B, reasoning "").  Columns ``session, pos, role, reasoning,
    content``; ``replies`` must hold complete sessions only."""
    head = session_openers.select(
        "session",
        F.explode(
            F.array(
                F.struct(F.lit(0).cast("long").alias("pos"), F.lit("system").alias("role"), F.lit("").alias("reasoning"), F.lit(prompt_a).alias("content")),
                F.struct(F.lit(1).cast("long").alias("pos"), F.lit("user").alias("role"), F.lit("").alias("reasoning"), F.col("respond").alias("content")),
            )
        ).alias("m"),
    ).select("session", "m.*")
    body = _turn_rows(replies, turns, "assistant", F.col("responding"), F.col("reasoning"), "user", F.col("responding"), F.lit(""))
    return head.unionByName(body)


def view_a(replies: DataFrame, session_openers: DataFrame, prompt_a: str, turns: int) -> DataFrame:
    """Agent A's history: its own replies as assistant JSON, B's as
    ``{"query": ...}`` user messages, the opener as the first query."""
    head = session_openers.select(
        "session",
        F.explode(
            F.array(
                F.struct(F.lit(0).cast("long").alias("pos"), F.lit("system").alias("role"), F.lit(prompt_a).alias("content")),
                F.struct(F.lit(1).cast("long").alias("pos"), F.lit("user").alias("role"), json_query("respond").alias("content")),
            )
        ).alias("m"),
    ).select("session", "m.*")
    body = _turn_rows(replies, turns, "assistant", json_reply("reasoning", "responding"), None, "user", json_query("responding"), None)
    return head.unionByName(body)


def view_b(replies: DataFrame, session_openers: DataFrame, prompt_b: str, turns: int) -> DataFrame:
    """Agent B's history: the opener as its own first reply, A's
    replies as ``{"query": ...}`` user messages, its own as assistant JSON."""
    head = session_openers.select(
        "session",
        F.explode(
            F.array(
                F.struct(F.lit(0).cast("long").alias("pos"), F.lit("system").alias("role"), F.lit(prompt_b).alias("content")),
                F.struct(F.lit(1).cast("long").alias("pos"), F.lit("assistant").alias("role"), json_reply("think", "respond").alias("content")),
            )
        ).alias("m"),
    ).select("session", "m.*")
    body = _turn_rows(replies, turns, "user", json_query("responding"), None, "assistant", json_reply("reasoning", "responding"), None)
    return head.unionByName(body)


def nest_by(rows: DataFrame, key: str = "session", order: str = "pos", fields=("role", "reasoning", "content")) -> DataFrame:
    """Message rows -> one ``messages`` array per session, in ``order``."""
    item = F.struct(F.col(order).alias("_o"), *[F.col(f) for f in fields])
    grouped = rows.groupBy(key).agg(F.array_sort(F.collect_list(item)).alias("_m"))
    return grouped.select(key, F.transform("_m", lambda m: F.struct(*[m[f].alias(f) for f in fields])).alias("messages"))
