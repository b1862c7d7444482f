"""Chat-app export queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from trainprep.operators.export import convert_export, export_json, export_rejects
from trainprep.plans.fixtures import write_chat_export
from trainprep.plans.registry import query
from trainprep.sources.files import whole_files

_NAME = "'export_' || printf('%06d', conv_id) || '.json'"


def converted(spark, sf_dir):
    return convert_export(whole_files(spark, write_chat_export(spark, sf_dir), "*.json"), "value")


@query(
    "export_path",
    f"""
SELECT DISTINCT {_NAME} AS name,
       CASE WHEN conv_id % 19 = 0 THEN '' WHEN conv_id % 5 = 0 THEN 'data/inner/session/messages'
            ELSE 'data/session/messages' END AS path
FROM conversations
""",
)
def export_path(spark, sf_dir):
    return converted(spark, sf_dir).select("name", F.array_join("key_path", "/").alias("path"))


@query(
    "export_to_messages",
    f"""
SELECT {_NAME} AS name, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS BIGINT) AS pos,
       CASE WHEN conv_id % 7 = 0 THEN 'unknown' ELSE role END AS role, text AS content
FROM conversations WHERE conv_id % 19 <> 0 AND role <> 'system'
""",
)
def export_to_messages(spark, sf_dir):
    ok = converted(spark, sf_dir).where(F.col("status") == "ok")
    rows = ok.select("name", F.posexplode("messages").alias("pos", "m"))
    return rows.select("name", F.col("pos").cast("long").alias("pos"), "m.role", "m.content")


@query("export_rejects", f"SELECT DISTINCT {_NAME} AS name, 'missing_key' AS status FROM conversations WHERE conv_id % 19 = 0")
def export_rejects_query(spark, sf_dir):
    return export_rejects(converted(spark, sf_dir)).select("name", "status")


@query(
    "export_json_roundtrip",
    f"""
SELECT {_NAME} AS name, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS BIGINT) AS pos,
       CASE WHEN conv_id % 7 = 0 THEN 'unknown' ELSE role END AS role, text AS content
FROM conversations WHERE conv_id % 19 <> 0 AND role <> 'system'
""",
)
def export_json_roundtrip(spark, sf_dir):
    """Converted exports written as one JSON array per file (K5), read back
    with each message's place."""
    from trainprep.session import scratch_dir
    from trainprep.sinks.files import write_json_documents
    from trainprep.sources.files import whole_files

    out = scratch_dir(spark, "converted")
    ok = converted(spark, sf_dir).where(F.col("status") == "ok")
    write_json_documents(ok, out, "name", export_json("messages"))
    array = F.from_json("value", "array<struct<role:string,content:string>>", {"mode": "FAILFAST"})
    back = whole_files(spark, out, "*.json").select("name", F.posexplode(array).alias("pos", "m"))
    return back.select("name", F.col("pos").cast("long").alias("pos"), "m.role", "m.content")
