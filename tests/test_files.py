"""File sources and sinks."""

import io
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from trainprep.sinks.files import write_chunks, write_files, write_log_table
from trainprep.sources.files import (
    read_scalar,
    run_log_lines,
    scan_json_folder,
    scan_openers,
    scan_txt_folder,
    scan_zip_txt,
    txt_rejects,
    whole_files,
)


def _write(folder, name, data):
    os.makedirs(folder, exist_ok=True)
    mode = "wb" if isinstance(data, bytes) else "w"
    with open(os.path.join(folder, name), mode, **({} if mode == "wb" else {"encoding": "utf-8", "newline": ""})) as f:
        f.write(data)


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def test_json_folder_statuses(spark, tmp_folder):
    d = _local(tmp_folder)
    _write(d, "a.json", '{"messages": [{"role": "user", "content": "hi"}]}')
    _write(d, "b.json", '{"other": 1}')
    _write(d, "c.json", '{"messages": [')
    _write(d, "d.json", "[1, 2]")
    _write(d, "e.json", '{"messages": null}')
    _write(d, "f.json", '{"messages": "text"}')
    _write(d, "g.json", '﻿{"messages": []}')
    _write(d, "h.json", '{"messages": [{"role": "assistant", "content": "x", "reasoning": "r", "extra": NaN}]}')
    _write(d, "skip.txt", "not json")
    got = {r.name: (r.status, r.messages) for r in scan_json_folder(spark, tmp_folder).collect()}
    assert got["a.json"][0] == "ok" and got["a.json"][1][0].content == "hi" and got["a.json"][1][0].reasoning is None
    assert got["b.json"] == ("missing_messages", [])
    assert got["c.json"][0] == "corrupt" and got["d.json"][0] == "corrupt" and got["f.json"][0] == "corrupt"
    assert got["e.json"] == ("ok", None)
    assert got["g.json"][0] == "corrupt"
    assert got["h.json"][0] == "ok"
    assert "skip.txt" not in got


def test_txt_folder(spark, tmp_folder):
    d = _local(tmp_folder)
    _write(d, "1.txt", "a\r\nb\rc\n")
    _write(d, "2.txt", "")
    _write(d, "3.TXT", "upper")
    got = {r.name: r.text for r in scan_txt_folder(spark, tmp_folder).collect()}
    assert got == {"1.txt": "a\nb\nc\n"}


def test_txt_folder_bad_utf8(spark, tmp_folder):
    d = _local(tmp_folder)
    _write(d, "1.txt", b"ok\xff")
    _write(d, "2.txt", "fine")
    with pytest.raises(Exception):
        scan_txt_folder(spark, tmp_folder).collect()
    assert [r.name for r in scan_txt_folder(spark, tmp_folder, on_bad_utf8="reject").collect()] == ["2.txt"]


def test_zip_members(spark, tmp_folder):
    d = _local(tmp_folder)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        zf.writestr("b.txt", "B\r\n")
        zf.writestr("dir/a.TXT", "A")
        zf.writestr("empty.txt", "")
        zf.writestr("x.md", "no")
    _write(d, "one.zip", buf.getvalue())
    got = sorted((r.member, r.text) for r in scan_zip_txt(spark, tmp_folder).collect())
    assert got == [("b.txt", "B\r\n"), ("dir/a.TXT", "A"), ("empty.txt", "")]


def test_openers_csv(spark, tmp_folder):
    d = _local(tmp_folder)
    _write(d, "o.csv", 'think,respond\n"multi\nline","say ""hi"""\nshort\n  pad  , x ,extra\nt,　\n')
    got = [tuple(r) for r in scan_openers(spark, tmp_folder, skip_header=True).orderBy("opener_id").collect()]
    assert got == [(0, "multi\nline", 'say "hi"'), (1, "pad", "x")]


def test_scalar_and_run_logs(spark, tmp_folder):
    d = _local(tmp_folder)
    _write(d + "/p", "prompt.txt", "  You are A.\n\n")
    assert read_scalar(spark, tmp_folder + "/p") == "You are A."
    _write(d + "/logs", "train_rank32.log", "{'loss': 1.0}\nx\r100%|#|\r{'eval_loss': 2.0, 'epoch': 1.0}\n")
    _write(d + "/logs", "train_rank64.log", "{'loss': 3.0}\n")
    rows = run_log_lines(spark, tmp_folder + "/logs/train_rank*.log").collect()
    assert sorted((r.rank, r.value) for r in rows)[:2] == [(32, "100%|#|"), (32, "x")]
    assert sum(r.rank == 32 for r in rows) == 4 and sum(r.rank == 64 for r in rows) == 1


def test_chunk_sink_and_file_sink(spark, tmp_folder):
    df = spark.createDataFrame([(i, i // 3, f"t{i}") for i in range(10)], "ord long, chunk_id long, text string")
    write_chunks(df, tmp_folder + "/c", "chunk_id", "ord", ["text"])
    back = spark.read.parquet(tmp_folder + "/c")
    assert sorted(r.chunk for r in back.select("chunk").distinct().collect()) == [f"chunk_{i:06d}" for i in range(4)]
    rep = write_files(df.select(F.concat(F.lit("f"), "ord").alias("name"), "text"), tmp_folder + "/files", "name", "text").first()
    assert rep.files == 10
    assert open(os.path.join(_local(tmp_folder), "files", "f3")).read() == "t3"


def test_log_table_sink_keeps_header_when_empty(spark, tmp_folder):
    empty = spark.createDataFrame([], "loss double, epoch double")
    write_log_table(empty, tmp_folder + "/eval", ["loss", "epoch"])
    files = [f for f in os.listdir(_local(tmp_folder) + "/eval") if f.endswith(".csv")]
    assert open(os.path.join(_local(tmp_folder), "eval", files[0])).read().strip() == "loss,epoch"


def test_every_parquet_file_needs_the_column(spark, tmp_folder):
    from trainprep.sources.parquet import corpus_scan

    spark.createDataFrame([("a",)], "text string").write.parquet(tmp_folder + "/ok")
    spark.createDataFrame([(1,)], "other long").write.parquet(tmp_folder + "/bad")
    assert [r.text for r in corpus_scan(spark, [tmp_folder + "/ok"]).collect()] == ["a"]
    with pytest.raises(ValueError):
        corpus_scan(spark, [tmp_folder + "/ok", tmp_folder + "/bad"])


def test_underscore_names_are_read(spark, tmp_folder):
    """``*.txt`` covers ``_b.txt``; names that begin with a dot are hidden."""
    d = _local(tmp_folder)
    _write(d, "a.txt", "seen")
    _write(d, "_b c.txt", "seen too\r\n")
    _write(d, "_c.json", "no text")
    _write(d, ".c.txt", "hidden")
    rows = scan_txt_folder(spark, tmp_folder).collect()
    assert {r.name.replace("%20", " "): r.text for r in rows} == {"a.txt": "seen", "_b c.txt": "seen too\n"}
    assert len({r.path.rsplit("/", 1)[0] for r in rows}) == 1


def test_bad_utf8_files_are_named(spark, tmp_folder):
    d = _local(tmp_folder)
    _write(d, "a.txt", "good")
    for name in ("b.txt", "_c.txt"):
        with open(os.path.join(d, name), "wb") as f:
            f.write(b"bad \xff")
    files = whole_files(spark, tmp_folder, "*.txt")
    assert sorted(r.name for r in txt_rejects(files).collect()) == ["_c.txt", "b.txt"]
    assert [r.name for r in scan_txt_folder(spark, tmp_folder, "reject").collect()] == ["a.txt"]


def test_chunk_sink_sorted_layout(spark, tmp_folder):
    df = spark.createDataFrame([(i, i // 4, f"t{i}") for i in range(40)], "ord long, chunk_id long, text string")
    write_chunks(df, tmp_folder + "/s", "chunk_id", "ord", ["text"], layout="sorted")
    back = spark.read.parquet(tmp_folder + "/s")
    assert back.columns == ["chunk", "text"]
    got = sorted((r.chunk, r.text) for r in back.collect())
    assert got == sorted((f"chunk_{i // 4:06d}", f"t{i}") for i in range(40))
    one = back.where("chunk = 'chunk_000003'").collect()
    assert sorted(r.text for r in one) == ["t12", "t13", "t14", "t15"]


def test_one_archive_is_read_by_many_tasks(spark, tmp_folder):
    d = _local(tmp_folder)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        for i in range(200):
            zf.writestr(f"m{i:03d}.txt", f"text {i}")
    _write(d, "big.zip", buf.getvalue())
    members = scan_zip_txt(spark, tmp_folder)
    assert members.count() == 200
    tasks = members.groupBy(F.spark_partition_id()).count().count()
    assert tasks > 1
