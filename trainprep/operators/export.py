"""Chat-app export conversion.

The export is arbitrarily nested JSON with a ``messages`` list somewhere.
The first ``messages`` key in document order wins (pre-order, depth first),
which needs the original key order -- VARIANT sorts object keys -- so the
general search is a small per-row helper in an Arrow-batched pandas UDF.

Documents of a known layout never reach it: where the quoted key occurs once
in the text and lies under one of ``layouts``, it is the first, and its frames
are converted by VARIANT and array functions; where it does not occur at all,
the key is missing.  Escapes that could hide a key or stand for half a
character, frames with other types than text, and whatever Spark does not
parse go to the search, so both ways give the same rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trainprep.operators.columns import computed_once

# keys above the message list in the exports met so far; () is the top level
LAYOUTS = (("data", "session"), ("data", "inner", "session"), ())
END = "end of the document"  # a text that holds it goes to the search

RESULT = T.StructType(
    [
        T.StructField("status", T.StringType()),
        T.StructField("key_path", T.ArrayType(T.StringType())),
        T.StructField(
            "messages",
            T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])),
        ),
    ]
)


def find_key_path(doc, key: str = "messages") -> list:
    """Keys / indexes leading to the first ``key`` in pre-order; [] if absent.

    Explicit stack: a mapping's entries are visited in insertion order, and
    each key is tested before the value under it is searched.
    """
    todo: list[tuple[str, object, object, list]] = [("value", None, doc, [])]
    while todo:
        kind, name, node, trail = todo.pop()
        if kind == "entry":
            if name == key:
                return trail + [name]
            todo.append(("value", None, node, trail + [name]))
            continue
        if isinstance(node, dict):
            todo.extend(("entry", k, v, trail) for k, v in reversed(list(node.items())))
        elif isinstance(node, list):
            todo.extend(("value", None, v, trail + [i]) for i, v in reversed(list(enumerate(node))))
    return []


def _first_part_text(frame):
    """``frame.contentParts[0].text`` when the frame has that shape, else a
    marker that the frame is skipped."""
    if not isinstance(frame, dict):
        return _SKIP
    parts = frame.get("contentParts", _SKIP)
    if not isinstance(parts, list) or not parts or not isinstance(parts[0], dict) or "text" not in parts[0]:
        return _SKIP
    return parts[0]["text"]


_SKIP = object()


def frames_to_messages(frames) -> list[dict]:
    """Each frame -> ``{role, content}``: content is the text of the first
    content part (frames without one are skipped); a missing role is
    ``unknown``, an explicit null stays null."""
    if isinstance(frames, dict):
        frames = list(frames)  # iterating a mapping visits its keys (all skipped)
    elif not isinstance(frames, list):
        frames = list(frames) if isinstance(frames, str) else []
    out = []
    for frame in frames:
        text = _first_part_text(frame)
        if text is _SKIP:
            continue
        role = frame["role"] if "role" in frame else "unknown"
        if text is not None and not isinstance(text, str):
            text = json.dumps(text, ensure_ascii=False)
        out.append({"role": None if role is None else str(role), "content": text})
    return out


def convert_document(text: str, key: str = "messages") -> dict:
    try:
        doc = json.loads(text)
    except (ValueError, TypeError):
        return {"status": "corrupt", "key_path": None, "messages": None}
    path = find_key_path(doc, key)
    if not path:
        return {"status": "missing_key", "key_path": [], "messages": None}
    node = doc
    for step in path:
        node = node[step]
    if node is None:
        return {"status": "null_messages", "key_path": [str(p) for p in path], "messages": None}
    return {"status": "ok", "key_path": [str(p) for p in path], "messages": frames_to_messages(node)}


def _convert_udf(key: str):
    @F.pandas_udf(RESULT)
    def convert(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            # no text: the document was converted before
            rows = [convert_document(t, key) if t is not None else dict.fromkeys(RESULT.names) for t in texts]
            yield pd.DataFrame(rows, columns=RESULT.names)

    # a filter on the status must not run the search a second time
    return convert.asNondeterministic()


def _type_of(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v), F.lit("ABSENT"))


def _convert_known(df: DataFrame, text: Column, key: str, layouts, out: str) -> DataFrame:
    """Adds ``out``: the converted document, null where it needs the search."""
    names = [key, *(name for keys in layouts for name in keys)]
    if any(not name.replace("_", "").isalnum() or not name.isascii() for name in names):
        raise ValueError("layouts and their key are of ASCII letters, digits and underscores")
    quoted = f'"{key}"'
    keep = df.columns
    plain = ~text.rlike(r"\\u(00|[dD][89a-fA-F])") & ~text.contains(END)
    times = F.length(text) - F.length(F.replace(text, F.lit(quoted), F.lit(quoted[1:])))
    # Spark stops reading after the first value; in an array the text is one
    # whole value only if its own end marker comes next
    wrapped = F.try_parse_json(F.concat(F.lit("["), text, F.lit(f',"{END}"]')))
    parsed = computed_once(df, keep, _n=F.when(plain, times), _w=F.when(plain & (times <= 1), wrapped))
    one = F.coalesce(F.try_variant_get("_w", "$[1]", "string") == END, F.lit(False))
    spots = [F.try_variant_get("_w", "$[0]" + "".join(f".{k}" for k in (*keys, key)), "variant") for keys in layouts]
    found = computed_once(
        parsed, [*keep, "_n"],
        _ok=F.col("_w").isNotNull() & one & (_type_of(F.try_variant_get("_w", "$[0]", "variant")) != "ABSENT"),
        _m=F.coalesce(*spots) if spots else F.lit(None).cast("variant"),
        _path=F.coalesce(*(F.when(spot.isNotNull(), F.array(*map(F.lit, (*keys, key)))) for keys, spot in zip(layouts, spots)))
        if spots else F.lit(None).cast("array<string>"),
    )
    frames = F.when(_type_of(F.col("_m")).startswith("ARRAY"), F.try_variant_get("_m", "$", "array<variant>"))
    part = lambda f: F.try_variant_get(f, "$.contentParts[0].text", "variant")
    role = lambda f: F.try_variant_get(f, "$.role", "variant")
    cells = computed_once(
        found, [*keep, "_n", "_ok", "_path"],
        _f=F.transform(frames, lambda f: F.struct(part(f).alias("t"), _type_of(part(f)).alias("tt"), role(f).alias("r"), _type_of(role(f)).alias("rt"))),
    )
    kept = F.filter("_f", lambda x: x["tt"] != "ABSENT")
    usual = F.forall(kept, lambda x: x["tt"].isin("STRING", "VOID") & x["rt"].isin("STRING", "VOID", "ABSENT"))
    messages = F.transform(
        kept,
        lambda x: F.struct(
            F.when(x["rt"] == "ABSENT", F.lit("unknown")).otherwise(F.try_variant_get(x["r"], "$", "string")).alias("role"),
            F.try_variant_get(x["t"], "$", "string").alias("content"),
        ),
    )
    shape = RESULT.simpleString()
    missing = F.struct(F.lit("missing_key").alias("status"), F.array().cast("array<string>").alias("key_path"), F.lit(None).alias("messages"))
    done = F.struct(F.lit("ok").alias("status"), F.col("_path").alias("key_path"), messages.alias("messages"))
    result = F.when(F.col("_ok") & (F.col("_n") == 0), missing.cast(shape)).when(
        F.col("_ok") & (F.col("_n") == 1) & F.col("_f").isNotNull() & usual, done.cast(shape)
    )
    return computed_once(cells, keep, **{out: result})


def convert_export(df: DataFrame, text: str | Column = "value", key: str = "messages", layouts=LAYOUTS) -> DataFrame:
    """Adds ``status``, ``key_path`` (array of keys / indexes as strings) and
    ``messages`` (``array<struct<role, content>>``) from the raw export.
    ``layouts`` lists the key paths above the message list that are read
    without Python; the rows are the same with any list.  A null text is
    ``corrupt``."""
    c = F.col(text) if isinstance(text, str) else text
    known = _convert_known(df.withColumn("_t", c), F.col("_t"), key, layouts, "_x") if layouts else df.withColumn("_t", c).withColumn("_x", F.lit(None).cast(RESULT))
    searched = known.withColumn("_y", _convert_udf(key)(F.when(F.col("_x").isNull(), F.coalesce("_t", F.lit("")))))
    return searched.select(*df.columns, *(F.when(F.col("_x").isNotNull(), F.col(f"_x.{n}")).otherwise(F.col(f"_y.{n}")).alias(n) for n in RESULT.names))


def export_rejects(converted: DataFrame) -> DataFrame:
    """Documents without the key (or unreadable): the reference stops on them."""
    return converted.where(F.col("status") != "ok")


def export_json(messages: str | Column = "messages", wrap: bool = False) -> Column:
    """Converted conversation as JSON text (K5): a bare array of
    ``{role, content}``, or ``{"messages": [...]}`` with ``wrap=True`` so
    the JSON folder scan can read it back."""
    m = F.col(messages) if isinstance(messages, str) else messages
    return F.to_json(F.struct(m.alias("messages"))) if wrap else F.to_json(m)
