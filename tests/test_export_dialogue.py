"""Chat export (N1-N3) and dialogue tables."""

import json

from pyspark.sql import functions as F

from trainprep.functions.text import json_query, json_reply
from trainprep.operators.dialogue import complete_sessions, transcript, validate_replies, view_a, view_b
from trainprep.operators.export import LAYOUTS, _convert_known, convert_document, convert_export, find_key_path, frames_to_messages


def test_key_search_is_preorder():
    doc = json.loads('{"a": {"b": [{"messages": 1}]}, "messages": 2}')
    assert find_key_path(doc) == ["a", "b", 0, "messages"]
    assert find_key_path({"x": [1, {"y": 2}]}) == []
    assert find_key_path([{"m": 1}, {"messages": 3}]) == [1, "messages"]


def test_frames():
    frames = [
        {"role": "user", "contentParts": [{"text": "a"}, {"text": "b"}]},
        {"contentParts": [{"text": "c"}]},
        {"role": None, "contentParts": [{"text": "d"}]},
        {"role": "system", "contentParts": []},
        "junk",
        {"role": "user"},
    ]
    assert frames_to_messages(frames) == [
        {"role": "user", "content": "a"},
        {"role": "unknown", "content": "c"},
        {"role": None, "content": "d"},
    ]
    assert convert_document("{bad")["status"] == "corrupt"
    assert convert_document('{"x": 1}')["status"] == "missing_key"


def test_json_encoders_match_python(spark):
    texts = ['plain', 'quote " and \\ back', "new\nline\ttab", "ünïcödé 日本"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", json_query("t").alias("q"), json_reply("t", "t").alias("r")).collect()
    for r in rows:
        assert r.q == json.dumps({"query": r.t}, ensure_ascii=False)
        assert r.r == json.dumps({"reasoning": r.t, "responding": r.t}, ensure_ascii=False, separators=(",", ":"))


def _replies(spark, turns, bad=()):
    rows = []
    for s in (1, 2):
        for t in range(turns):
            for agent in ("A", "B"):
                if agent == "B" and t == turns - 1:
                    continue
                raw = json.dumps({"reasoning": f"r{s}{agent}{t}", "responding": f"s{s}{agent}{t}"})
                if (s, agent, t) in bad:
                    raw = json.dumps({"responding": 5})
                rows.append((s, t, agent, raw))
    return spark.createDataFrame(rows, "session long, turn long, agent string, raw string")


def test_transcript_and_views(spark):
    turns = 2
    replies = validate_replies(_replies(spark, turns, bad={(2, "A", 1)}))
    good, bad = complete_sessions(replies, turns)
    assert [r.session for r in good.collect()] == [1]
    assert [(r.session, r.reason) for r in bad.collect()] == [(2, "invalid_reply")]
    kept = replies.join(good, "session", "left_semi")
    so = good.select("session", F.lit("open").alias("respond"), F.lit("why").alias("think"))
    t = [tuple(r) for r in transcript(kept, so, "PA", turns).orderBy("pos").collect()]
    assert t == [
        (1, 0, "system", "", "PA"), (1, 1, "user", "", "open"),
        (1, 2, "assistant", "r1A0", "s1A0"), (1, 3, "user", "", "s1B0"), (1, 4, "assistant", "r1A1", "s1A1"),
    ]
    a = [(r.role, r.content) for r in view_a(kept, so, "PA", turns).orderBy("pos").collect()]
    assert a[1] == ("user", '{"query": "open"}')
    assert a[2] == ("assistant", '{"reasoning":"r1A0","responding":"s1A0"}')
    assert a[3] == ("user", '{"query": "s1B0"}')
    b = [(r.role, r.content) for r in view_b(kept, so, "PB", turns).orderBy("pos").collect()]
    assert b[1] == ("assistant", '{"reasoning":"why","responding":"open"}')
    assert b[2] == ("user", '{"query": "s1A0"}') and b[3][0] == "assistant" and len(b) == 5


def test_export_json_wrap_reads_back(spark, tmp_folder):
    from trainprep.operators.export import convert_export, export_json
    from trainprep.sinks.files import write_json_documents
    from trainprep.sources.files import scan_json_folder

    doc = '{"a": {"messages": [{"role": "user", "contentParts": [{"text": "hi"}]}]}}'
    conv = convert_export(spark.createDataFrame([("x.json", doc)], "name string, value string"))
    bare = conv.select(export_json("messages").alias("j")).first().j
    assert json.loads(bare) == [{"role": "user", "content": "hi"}]
    write_json_documents(conv, tmp_folder, "name", export_json("messages", wrap=True)).collect()
    back = scan_json_folder(spark, tmp_folder).first()
    assert back.status == "ok" and back.messages[0].content == "hi" and back.messages[0].reasoning is None


EXPORTS = [
    '{"data":{"session":{"messages":[{"role":"user","contentParts":[{"text":"a"},{"text":"b"}]},{"contentParts":[{"text":"c"}]}]}}}',
    '{"data":{"inner":{"session":{"messages":[{"role":null,"contentParts":[{"text":null}]},{"role":"x","contentParts":[]},"junk",null,5]}}}}',
    '{"messages":[]}',
    ' {"messages" : [ {"role":"r\\n\\"q\\"", "contentParts":[{"type":"text","text":"\u00fc \u65e5 \\u65e5"}]} ] } ',
    '{"other":[1,{"deep":{"messages":[{"role":"u","contentParts":[{"text":"d"}]}]}}]}',  # unknown layout
    '{"data":{"session":{"note":"messages","messages":[{"role":"u","contentParts":[{"text":"e"}]}]}}}',
    '{"x":{"messages":null},"data":{"session":{"messages":[{"role":"u","contentParts":[{"text":"f"}]}]}}}',
    '{"data":{"m\\u0065ssages":[{"role":"hid","contentParts":[{"text":"g"}]}],"session":{"messages":[]}}}',
    '{"data":{"session":{"messages":[{"role":7,"contentParts":[{"text":{"k":[1,"v"]}}]}]}}}',
    '{"data":{"session":{"messages":{"a":1}}}}',
    '{"data":{"session":{"messages":null}}}',
    '{"data":{"session":{"messages":"text"}}}',
    '{"data":{"session":{"messages":[{"role":"u","contentParts":{"0":{"text":"h"}}}]}}}',
    '{"data":{"session":{"messages":[{"role":"u","contentParts":[{"text":"\\ud83d\\ude00"}]}]}}}',
    '{"data":{"session":{"messages":[{"role":"u","contentParts":[{"text":"i"}]}]}},"data":4}',
    '{"data":{"session":{"messages":[[{"role":"u"}],{"role":"u","contentParts":[["text"]]}]}}}',
    '{"messages":[]} trailing',
    '{"messages":[]} {"a":1}',
    '{"a":1},{"messages":[]}',
    '{"a":1},',
    ',{"a":1}',
    '{"a":1}],[2', '{"a":1},"end of the document"],[2', '{"messages":[],"a":"end of the document"}',
    '{"n":NaN,"messages":[{"role":"u","contentParts":[{"text":"j"}]}]}',
    '{"n":NaN}', "[]", "{}", "null", "12", '"messages"', "", "   ", "{bad", '{"a":01}', '{"Messages":[]}', '{"a":"\t"}',
]


def test_known_layouts_convert_as_the_search_does(spark):
    rows = [(str(i), t, "own") for i, t in enumerate(EXPORTS)] + [("null", None, "own")]
    df = spark.createDataFrame(rows, "name string, value string, _t string")
    got = {r.name: r for r in convert_export(df.drop("_t")).collect()}
    plain = {r.name: r for r in convert_export(df.drop("_t"), layouts=()).collect()}
    for name, text, _ in rows:
        want = convert_document(text)
        for r in (got[name], plain[name]):
            found = None if r.messages is None else [m.asDict() for m in r.messages]
            assert (r.status, r.key_path, found) == (want["status"], want["key_path"], want["messages"]), text


def test_known_layouts_need_no_search(spark):
    df = spark.createDataFrame([(t,) for t in EXPORTS], "value string")
    done = [r.x is not None for r in _convert_known(df, F.col("value"), "messages", LAYOUTS, "x").collect()]
    assert all(done[:4]) and not any(done[4:12] + done[13:15])
    assert convert_export(df.limit(0)).collect() == []
