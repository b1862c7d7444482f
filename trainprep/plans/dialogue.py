"""Dialogue queries (J1, J2, C1-C4, K4) over replies built from documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from trainprep.functions.text import zero_pad

from trainprep.operators.dialogue import (
    assign_openers,
    complete_sessions,
    nest_by,
    transcript,
    validate_replies,
    view_a,
    view_b,
)
from trainprep.plans.files import _OPENERS_CLEAN_SQL, openers
from trainprep.plans.fixtures import PROMPT_A, PROMPT_B, once_per_session, replies_table, write_prompt
from trainprep.plans.registry import query
from trainprep.session import scratch_dir
from trainprep.sinks.files import write_json_documents
from trainprep.sources.files import read_scalar, scan_json_folder

TURNS = 5
PER = 2 * TURNS


def _parts(spark, sf_dir):
    """(valid replies of complete sessions, sessions with their opener)."""
    replies = validate_replies(replies_table(spark, sf_dir, TURNS))
    good, _ = complete_sessions(replies, TURNS)
    ops = openers(spark, sf_dir)
    n = ops.count()
    session_openers = assign_openers(good, ops, n)
    kept = replies.join(good, "session", "left_semi")
    return kept, session_openers


@once_per_session
def prompts(spark, sf_dir):
    """The two system prompts, written as text files and read back."""
    return read_scalar(spark, write_prompt(spark, PROMPT_A)), read_scalar(spark, write_prompt(spark, PROMPT_B))


_REPLIES_SQL = f"""
SELECT doc_id, CAST(floor(doc_id / {PER}) + 1 AS BIGINT) AS session, CAST(floor((doc_id % {PER}) / 2) AS BIGINT) AS turn,
       CASE WHEN doc_id % 2 = 0 THEN 'A' ELSE 'B' END AS agent,
       CASE WHEN doc_id % 17 = 0 THEN NULL ELSE lang END AS reasoning, text AS responding,
       doc_id % 17 <> 0 AS valid
FROM documents
"""

_BASE_SQL = f"""
WITH o AS ({_OPENERS_CLEAN_SQL}),
u AS (SELECT * FROM ({_REPLIES_SQL}) r WHERE (agent = 'A' AND turn < {TURNS}) OR (agent = 'B' AND turn < {TURNS} - 1)),
good AS (SELECT session FROM u GROUP BY session
         HAVING count(*) FILTER (WHERE valid) = count(*) AND count(*) = {2 * TURNS - 1}),
so AS (SELECT g.session, o.opener_id, o.think, o.respond FROM good g
       JOIN o ON o.opener_id = (g.session - 1) % (SELECT count(*) FROM o)),
k AS (SELECT u.* FROM u JOIN good USING (session))
"""


@query(
    "reply_valid",
    f"SELECT doc_id, session, turn, agent, valid FROM ({_REPLIES_SQL}) r "
    f"WHERE NOT (agent = 'B' AND turn = {TURNS - 1})",
)
def reply_valid(spark, sf_dir):
    return validate_replies(replies_table(spark, sf_dir, TURNS)).select("doc_id", "session", "turn", "agent", "valid")


@query(
    "opener_round_robin",
    f"""
WITH o AS ({_OPENERS_CLEAN_SQL}),
s AS (SELECT DISTINCT CAST(floor(doc_id / {PER}) + 1 AS BIGINT) AS session FROM documents)
SELECT s.session, o.opener_id, substring(o.respond, 1, 50) AS preview
FROM s JOIN o ON o.opener_id = (s.session - 1) % (SELECT count(*) FROM o)
""",
)
def opener_round_robin(spark, sf_dir):
    sessions = replies_table(spark, sf_dir, TURNS).select("session").distinct()
    ops = openers(spark, sf_dir)
    joined = assign_openers(sessions, ops, ops.count())
    return joined.select("session", "opener_id", F.substring("respond", 1, 50).alias("preview"))


_TRANSCRIPT_SQL = f"""
{_BASE_SQL}
SELECT session, CAST(0 AS BIGINT) AS pos, 'system' AS role, '' AS reasoning, '{PROMPT_A}' AS content FROM so
UNION ALL SELECT session, CAST(1 AS BIGINT), 'user', '', respond FROM so
UNION ALL SELECT session, CAST(CASE WHEN agent = 'A' THEN turn * 2 + 2 ELSE turn * 2 + 3 END AS BIGINT),
                 CASE WHEN agent = 'A' THEN 'assistant' ELSE 'user' END,
                 CASE WHEN agent = 'A' THEN reasoning ELSE '' END, responding FROM k
"""


@query("transcript", _TRANSCRIPT_SQL)
def transcript_query(spark, sf_dir):
    kept, session_openers = _parts(spark, sf_dir)
    prompt_a, _ = prompts(spark, sf_dir)
    return transcript(kept, session_openers, prompt_a, TURNS)


@query(
    "view_a",
    f"""
{_BASE_SQL}
SELECT session, CAST(0 AS BIGINT) AS pos, 'system' AS role, '{PROMPT_A}' AS content FROM so
UNION ALL SELECT session, CAST(1 AS BIGINT), 'user', '{{"query": ' || to_json(respond) || '}}' FROM so
UNION ALL SELECT session, CAST(CASE WHEN agent = 'A' THEN turn * 2 + 2 ELSE turn * 2 + 3 END AS BIGINT),
                 CASE WHEN agent = 'A' THEN 'assistant' ELSE 'user' END,
                 CASE WHEN agent = 'A' THEN CAST(to_json({{'reasoning': reasoning, 'responding': responding}}) AS VARCHAR)
                      ELSE '{{"query": ' || to_json(responding) || '}}' END FROM k
""",
)
def view_a_query(spark, sf_dir):
    kept, session_openers = _parts(spark, sf_dir)
    prompt_a, _ = prompts(spark, sf_dir)
    return view_a(kept, session_openers, prompt_a, TURNS)


@query(
    "view_b",
    f"""
{_BASE_SQL}
SELECT session, CAST(0 AS BIGINT) AS pos, 'system' AS role, '{PROMPT_B}' AS content FROM so
UNION ALL SELECT session, CAST(1 AS BIGINT), 'assistant',
                 CAST(to_json({{'reasoning': think, 'responding': respond}}) AS VARCHAR) FROM so
UNION ALL SELECT session, CAST(CASE WHEN agent = 'A' THEN turn * 2 + 2 ELSE turn * 2 + 3 END AS BIGINT),
                 CASE WHEN agent = 'A' THEN 'user' ELSE 'assistant' END,
                 CASE WHEN agent = 'A' THEN '{{"query": ' || to_json(responding) || '}}'
                      ELSE CAST(to_json({{'reasoning': reasoning, 'responding': responding}}) AS VARCHAR) END FROM k
""",
)
def view_b_query(spark, sf_dir):
    kept, session_openers = _parts(spark, sf_dir)
    _, prompt_b = prompts(spark, sf_dir)
    return view_b(kept, session_openers, prompt_b, TURNS)


@query(
    "dialogue_rejects",
    f"""
WITH u AS (SELECT * FROM ({_REPLIES_SQL}) r WHERE (agent = 'A' AND turn < {TURNS}) OR (agent = 'B' AND turn < {TURNS} - 1))
SELECT session, CASE WHEN count(*) FILTER (WHERE valid) < count(*) THEN 'invalid_reply' ELSE 'missing_reply' END AS reason
FROM u GROUP BY session HAVING NOT (count(*) FILTER (WHERE valid) = count(*) AND count(*) = {2 * TURNS - 1})
""",
)
def dialogue_rejects(spark, sf_dir):
    return complete_sessions(validate_replies(replies_table(spark, sf_dir, TURNS)), TURNS)[1]


@query(
    "session_json",
    f"""
WITH t AS ({_TRANSCRIPT_SQL})
SELECT 'session_' || printf('%04d', session) || '.json' AS name,
       CAST(row_number() OVER (PARTITION BY session ORDER BY pos) - 1 AS BIGINT) AS pos, role, content
FROM t
""",
)
def session_json(spark, sf_dir):
    """Transcripts written as ``session_%04d.json`` files, read back with
    each message's place and text."""
    kept, session_openers = _parts(spark, sf_dir)
    prompt_a, _ = prompts(spark, sf_dir)
    nested = nest_by(transcript(kept, session_openers, prompt_a, TURNS))
    name = F.concat(F.lit("session_"), zero_pad(F.col("session"), 4), F.lit(".json"))
    out = scratch_dir(spark, "sessions")
    write_json_documents(nested.withColumn("name", name), out, "name", F.to_json(F.struct("messages")))
    back = scan_json_folder(spark, out).select("name", F.posexplode("messages").alias("pos", "m"))
    return back.select("name", F.col("pos").cast("long").alias("pos"), "m.role", "m.content")
