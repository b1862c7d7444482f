"""File inputs of the reference's tools, written by Spark from the given
tables into the shared scratch folder (FIXTURES.md part 2 gives the rules).

Every writer is a distributed job; nothing passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trainprep.functions.text import zero_pad

from trainprep.plans.tables import table
from trainprep.session import scratch_dir

_WRITTEN: dict[tuple, str] = {}


def once_per_session(fn):
    """Write a derived input once per Spark application and table folder;
    later queries in the same session read the same files."""

    def wrapper(spark: SparkSession, sf_dir: str, *args):
        key = (spark.sparkContext.applicationId, fn.__name__, sf_dir.rstrip("/"), args)
        if key not in _WRITTEN:
            _WRITTEN[key] = fn(spark, sf_dir, *args)
        return _WRITTEN[key]

    wrapper.__name__ = fn.__name__
    wrapper.__doc__ = fn.__doc__
    return wrapper


# The LoRA ranks the rank scan runs, in order.
RANKS = (32, 64, 96, 128, 160)


def run_rank(user_id: Column) -> Column:
    """Element ``user_id % 5`` of RANKS (they are 32 * (1..5))."""
    return (F.lit(32) * (user_id % 5 + 1)).cast("long")


def _num(c: Column) -> Column:
    return c.cast("string")


def log_line(events: DataFrame) -> Column:
    """One trainer log line per event, by ``event_type``:
    click -> train dict (loss quoted), view -> eval dict, purchase ->
    progress bar text, signup -> runtime dict, error -> broken (even id) or
    nested (odd id) dict."""
    v, eid = F.col("value"), F.col("event_id")
    epoch = _num(eid / F.lit(1000))
    train = F.concat(
        F.lit("{'loss': '"), _num(v), F.lit("', 'grad_norm': "), _num(v / F.lit(7)),
        F.lit(", 'learning_rate': "), _num(F.lit(1e-05) * F.col("user_id")), F.lit(", 'epoch': "), epoch, F.lit("}"),
    )
    evals = F.concat(
        F.lit("eval: {'eval_loss': "), _num(v), F.lit(", 'eval_runtime': 1.5, 'epoch': "), epoch, F.lit("}")
    )
    progress = F.concat(
        F.lpad(_num(eid % 100), 3, " "), F.lit("%|"), F.repeat(F.lit("#"), (eid % 10).cast("int")),
        F.lit("| "), _num(eid), F.lit("/10000 [00:01<00:10, 7.50it/s]"),
    )
    signup = F.concat(
        F.lit("{'train_runtime': "), _num(v), F.lit(", 'train_steps_per_second': 1.5, 'epoch': "), epoch, F.lit("}")
    )
    error = F.when(eid % 2 == 0, F.concat(F.lit("{'loss': "), _num(v), F.lit(", 'grad_norm': }"))).otherwise(
        F.concat(F.lit("{'loss': {'value': "), _num(v), F.lit("}, 'epoch': "), epoch, F.lit("}"))
    )
    t = F.col("event_type")
    return (
        F.when(t == "click", train)
        .when(t == "view", evals)
        .when(t == "purchase", progress)
        .when(t == "signup", signup)
        .otherwise(error)
    )


@once_per_session
def write_run_logs(spark: SparkSession, sf_dir: str) -> str:
    """One log per rank, ``train_rank<r>.log`` in the folder name; returns
    a glob of the files.  Spark writes each rank's lines in parallel."""
    out = scratch_dir(spark, "logs")
    ev = table(spark, sf_dir, "events")
    name = F.concat(F.lit("train_rank"), run_rank(F.col("user_id")).cast("string"), F.lit(".log")).alias("log")
    lines = ev.select("event_id", name, log_line(ev).alias("value"))
    # a run's lines stand in order of event, over several files
    ranged = lines.repartitionByRange(4, "event_id").sortWithinPartitions("log", "event_id")
    ranged.select("log", "value").write.partitionBy("log").text(out)
    return f"{out}/log=train_rank*.log/*.txt"


RANK_SQL = "CAST(32 * (user_id % 5 + 1) AS BIGINT)"


#: Parquet parts at least, and bytes of text in one of more.
PARTS = 6
PART_BYTES = 32 << 20


@once_per_session
def write_parquet_parts(spark: SparkSession, sf_dir: str) -> str:
    """``documents`` as several parquet files in a folder, by falling id,
    their number by the bytes of the texts; column ``body`` is the text, null
    where ``doc_id % 9 = 0``."""
    out = scratch_dir(spark, "parts")
    docs = table(spark, sf_dir, "documents")
    body = F.when(F.col("doc_id") % 9 != 0, F.col("text")).alias("body")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(PARTS, -(-size // PART_BYTES))
    ranged = docs.select("doc_id", "text", body).repartitionByRange(parts, F.desc("doc_id")).sortWithinPartitions(F.desc("doc_id"))
    ranged.write.parquet(out)
    return out


@once_per_session
def write_noisy_log(spark: SparkSession, sf_dir: str) -> str:
    """One text file per task: lines ``<event_id> <bytes>`` in order of event,
    some of whose bytes are no UTF-8."""
    out = scratch_dir(spark, "noisy")
    ev = table(spark, sf_dir, "events")
    odd = F.when(F.col("event_id") % 3 == 0, F.unhex(F.lit("FF41C3"))).when(F.col("event_id") % 3 == 1, F.unhex(F.lit("C3A9"))).otherwise(F.unhex(F.lit("")))
    lines = ev.select("event_id", F.concat(F.col("event_id").cast("string").cast("binary"), F.lit(" ").cast("binary"), odd, F.lit("|").cast("binary")).cast("string").alias("value"))
    lines.repartitionByRange(3, "event_id").sortWithinPartitions("event_id").select("value").write.text(out)
    return f"{out}/*.txt"


def _conv_name(conv_id: Column, suffix: str = ".json") -> Column:
    return F.concat(F.lit("conv_"), zero_pad(conv_id, 6), F.lit(suffix))


@once_per_session
def write_json_folder(spark: SparkSession, sf_dir: str) -> str:
    """One ``conv_<id>.json`` per conversation: ``{"messages": [...]}``;
    ``conv_id % 10 = 7`` truncated (broken), ``= 3`` without ``messages``."""
    from trainprep.plans.tables import conversation_messages
    from trainprep.sinks.files import write_files

    out = scratch_dir(spark, "json")
    conv = conversation_messages(spark, sf_dir)
    full = F.to_json(F.struct("messages"))
    cid = F.col("conv_id")
    content = (
        F.when(cid % 10 == 7, F.expr("substring(to_json(struct(messages)), 1, int(length(to_json(struct(messages))) / 2))"))
        .when(cid % 10 == 3, F.to_json(F.struct(cid.alias("id"))))
        .otherwise(full)
    )
    write_files(conv.select(_conv_name(cid).alias("name"), content.alias("content")), out).collect()
    return out


def doc_file_name(doc_id: Column) -> Column:
    return F.concat(zero_pad(doc_id, 6), F.lit(".txt"))


@once_per_session
def write_txt_folder(spark: SparkSession, sf_dir: str) -> str:
    """One ``<doc_id:06d>.txt`` per document; ``doc_id % 9 = 0`` empty,
    ``doc_id % 7 = 0`` with ``\\r\\n`` line ends."""
    from trainprep.sinks.files import write_files

    out = scratch_dir(spark, "txt")
    d = table(spark, sf_dir, "documents")
    did = F.col("doc_id")
    content = F.when(did % 9 == 0, F.lit("")).when(did % 7 == 0, F.regexp_replace("text", "\n", "\r\n")).otherwise(F.col("text"))
    write_files(d.select(doc_file_name(did).alias("name"), content.alias("content")), out).collect()
    return out


DOCS_PER_ARCHIVE = 250


def _zip_member_name(doc_id: Column) -> Column:
    """``<id>.txt``; ``doc_id % 10 = 1`` upper-case ``.TXT``; ``= 2`` in ``sub/``."""
    base = zero_pad(doc_id, 6)
    return (
        F.when(doc_id % 10 == 1, F.concat(base, F.lit(".TXT")))
        .when(doc_id % 10 == 2, F.concat(F.lit("sub/"), base, F.lit(".txt")))
        .otherwise(F.concat(base, F.lit(".txt")))
    )


def _build_archives(folder: str):
    def run(pdf):
        import io
        import zipfile

        import pandas as pd
        from pyarrow import fs

        archive = str(pdf["archive"].iloc[0])
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
            zf.writestr("README.md", "not a text member")
            for name, text in zip(pdf["member"], pdf["content"]):
                zf.writestr(name, text.encode("utf-8"))
        filesystem, root = fs.FileSystem.from_uri(folder)
        filesystem.create_dir(root, recursive=True)
        with filesystem.open_output_stream(f"{root}/{archive}") as out:
            out.write(buf.getvalue())
        return pd.DataFrame({"archive": [archive], "members": [len(pdf)]})

    return run


@once_per_session
def write_zip_folder(spark: SparkSession, sf_dir: str) -> str:
    """Documents in ZIP archives of DOCS_PER_ARCHIVE members (``docs_<k>.zip``),
    one group per archive (bounded by construction); ``doc_id % 9 = 0``
    empty, ``% 7 = 0`` with ``\\r\\n``; plus a non-text member each."""
    out = scratch_dir(spark, "zip")
    d = table(spark, sf_dir, "documents")
    did = F.col("doc_id")
    content = F.when(did % 9 == 0, F.lit("")).when(did % 7 == 0, F.regexp_replace("text", "\n", "\r\n")).otherwise(F.col("text"))
    key = F.concat(F.lit("docs_"), zero_pad(F.floor(did / DOCS_PER_ARCHIVE), 4), F.lit(".zip"))
    rows = d.select(key.alias("archive"), _zip_member_name(did).alias("member"), content.alias("content"))
    rows.groupBy("archive").applyInPandas(_build_archives(out), "archive string, members long").collect()
    return out


def opener_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user turn followed by an assistant turn: ``think`` = user text,
    ``respond`` = assistant text; ``(conv_id + turn) % 8 = 0`` gets a blank
    (U+3000) respond; ``% 5 = 0`` gets a quoted phrase in ``think``."""
    from pyspark.sql import Window

    c = table(spark, sf_dir, "conversations")
    w = Window.partitionBy("conv_id").orderBy("turn")
    nxt = c.select(
        "conv_id", "turn", "role", "text",
        F.lead("role").over(w).alias("next_role"), F.lead("text").over(w).alias("next_text"),
    )
    pairs = nxt.where((F.col("role") == "user") & (F.col("next_role") == "assistant"))
    k = F.col("conv_id") + F.col("turn")
    think = F.when(k % 5 == 0, F.concat(F.col("text"), F.lit(' "quoted", too'))).otherwise(F.col("text"))
    respond = F.when(k % 8 == 0, F.lit("　")).otherwise(F.col("next_text"))
    return pairs.select("conv_id", "turn", think.alias("think"), respond.alias("respond"))


@once_per_session
def write_openers_csv(spark: SparkSession, sf_dir: str) -> str:
    """Opener CSV with a header, in (conv_id, turn) order over files whose
    names sort in that order and whose number follows the data; quotes
    doubled, newlines kept."""
    out = scratch_dir(spark, "openers")
    pairs = opener_pairs(spark, sf_dir)
    (
        pairs.repartitionByRange("conv_id", "turn")
        .sortWithinPartitions("conv_id", "turn")
        .select("think", "respond")
        .write.option("header", "true")
        .option("quote", '"')
        .option("escape", '"')
        .csv(out)
    )
    return out


# The two agents' system prompts used by the dialogue queries.
PROMPT_A = "You are agent A. Answer in JSON with reasoning and responding."
PROMPT_B = "You are agent B. Answer in JSON with reasoning and responding."


def write_prompt(spark: SparkSession, text: str) -> str:
    out = scratch_dir(spark, "prompt")
    spark.createDataFrame([(f"  {text}\n",)], "value string").coalesce(1).write.text(out)
    return out


OPENERS_SQL = """
SELECT CAST(row_number() OVER (ORDER BY conv_id, turn) - 1 AS BIGINT) AS opener_id, think, respond FROM (
  SELECT conv_id, turn,
         CASE WHEN (conv_id + turn) % 5 = 0 THEN text || ' "quoted", too' ELSE text END AS think,
         CASE WHEN (conv_id + turn) % 8 = 0 THEN NULL ELSE next_text END AS respond
  FROM (SELECT conv_id, turn, role, text,
               lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role,
               lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS next_text
        FROM conversations) x
  WHERE role = 'user' AND next_role = 'assistant') y
WHERE respond IS NOT NULL
"""


@once_per_session
def write_chat_export(spark: SparkSession, sf_dir: str) -> str:
    """One nested chat-app export per conversation (``export_<id>.json``):
    messages under ``data.session``; ``conv_id % 5 = 0`` one level deeper
    (``data.inner.session``); system turns with empty ``contentParts``;
    ``conv_id % 7 = 0`` frames without ``role``; ``conv_id % 19 = 0`` with
    the list under another key."""
    from trainprep.operators.chat import nest_turns
    from trainprep.sinks.files import write_files

    out = scratch_dir(spark, "export")
    c = table(spark, sf_dir, "conversations")
    cid = F.col("conv_id")
    part = F.struct(F.lit("text").alias("type"), F.col("text").alias("text"))
    parts = F.when(F.col("role") == "system", F.array().cast("array<struct<type:string,text:string>>")).otherwise(F.array(part))
    frames = c.select(
        "conv_id", "turn",
        F.struct(
            F.col("turn").alias("id"), F.when(cid % 7 != 0, F.col("role")).alias("role"), parts.alias("contentParts")
        ).alias("frame"),
    )
    conv = nest_turns(frames, fields=("frame",), out="frames").select(
        "conv_id", F.transform("frames", lambda x: x["frame"]).alias("frames")
    )
    listed = F.to_json(F.struct(cid.alias("id"), F.col("frames").alias("messages")))
    hidden = F.to_json(F.struct(cid.alias("id"), F.col("frames").alias("history")))
    session = F.when(cid % 19 == 0, hidden).otherwise(listed)
    meta = '{"meta":{"app":"chat","version":2},"data":{'
    doc = F.when(cid % 5 == 0, F.concat(F.lit(meta + '"inner":{"session":'), session, F.lit("}}}"))).otherwise(
        F.concat(F.lit(meta + '"session":'), session, F.lit("}}"))
    )
    name = F.concat(F.lit("export_"), zero_pad(cid, 6), F.lit(".json"))
    write_files(conv.select(name.alias("name"), doc.alias("content")), out).collect()
    return out


def replies_table(spark: SparkSession, sf_dir: str, turns: int) -> DataFrame:
    """Agent replies from consecutive documents: session ``doc_id div
    2*turns + 1``, pairs (A, B) per turn; ``reasoning = lang``,
    ``responding`` = the whole text; ``doc_id % 17 = 0`` lacks
    ``reasoning``.  B's reply in the last turn is never requested."""
    per = 2 * turns
    d = table(spark, sf_dir, "documents")
    did = F.col("doc_id")
    k = did % per
    full = F.to_json(F.struct(F.col("lang").alias("reasoning"), F.col("text").alias("responding")))
    partial = F.to_json(F.struct(F.col("text").alias("responding")))
    rows = d.select(
        "doc_id",
        (F.floor(did / per) + 1).cast("long").alias("session"),
        F.floor(k / 2).cast("long").alias("turn"),
        F.when(k % 2 == 0, "A").otherwise("B").alias("agent"),
        F.when(did % 17 == 0, partial).otherwise(full).alias("raw"),
    )
    return rows.where(~((F.col("agent") == "B") & (F.col("turn") == turns - 1)))
