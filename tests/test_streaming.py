"""Incremental ingestion: new files are picked up once."""

import os

from trainprep.streaming.ingest import ingest_folder


def _put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8", newline="") as f:
        f.write(text)


def test_txt_stream_is_incremental(spark, tmp_folder):
    base = tmp_folder.replace("file:", "")
    src, table, ckpt = base + "/in", base + "/table", base + "/ckpt"
    _put(src, "a.txt", "one\r\ntwo")
    _put(src, "b.txt", "")
    q = ingest_folder(spark, src, table, ckpt, kind="txt")
    q.awaitTermination(120)
    assert sorted((r.name, r.text) for r in spark.read.parquet(table).collect()) == [("a.txt", "one\ntwo")]
    _put(src, "c.txt", "three")
    q = ingest_folder(spark, src, table, ckpt, kind="txt")
    q.awaitTermination(120)
    assert sorted(r.name for r in spark.read.parquet(table).collect()) == ["a.txt", "c.txt"]


def test_json_stream(spark, tmp_folder):
    base = tmp_folder.replace("file:", "")
    src = base + "/in"
    _put(src, "a.json", '{"messages": [{"role": "user", "content": "hi"}]}')
    _put(src, "b.json", "{broken")
    q = ingest_folder(spark, src, base + "/table", base + "/ckpt", kind="json")
    q.awaitTermination(120)
    got = {r.name: r.status for r in spark.read.parquet(base + "/table").collect()}
    assert got == {"a.json": "ok", "b.json": "corrupt"}
