"""Folders of very many small files, and parts that follow the data."""

import tracemalloc
from types import SimpleNamespace

import pandas as pd
import pyarrow as pa

from trainprep.plans import fixtures
from trainprep.sinks.files import _stage
from trainprep.sources import files
from trainprep.sources.files import whole_files


def test_small_files_do_not_each_take_a_share_of_a_task(spark, tmp_path):
    for i in range(400):
        (tmp_path / f"{i:03d}.txt").write_bytes(b"text %d\r\n" % i)
    cost, most = "spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes"
    before = {k: spark.conf.get(k) for k in (cost, most)}
    spark.conf.set(cost, 4 << 20)
    spark.conf.set(most, 16 << 20)
    try:
        df = whole_files(spark, str(tmp_path), "*.txt")
        assert df.rdd.getNumPartitions() <= files.LISTING_TASKS
        assert sorted((r.name, r.value) for r in df.collect()) == [(f"{i:03d}.txt", f"text {i}\r\n") for i in range(400)]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_slices_are_cut_by_bytes(tmp_path, monkeypatch):
    sizes = {f"{i:03d}.txt": 10_000 if i % 50 == 0 else 10 for i in range(200)}
    for name, n in sizes.items():
        (tmp_path / name).write_bytes(b"x" * n)
    monkeypatch.setattr(files, "SLICE_BYTES", 8_000)
    monkeypatch.setattr(files, "FILE_COST", 100)
    parts = [p for task in range(3) for p in files._list_share(str(tmp_path), ".txt", 3)([pd.DataFrame({"id": [task]})])]
    listed = pd.concat(parts)
    assert sorted(listed["name"]) == sorted(sizes)
    for _, names in listed.groupby("slice")["name"]:
        held = [sizes[n] + 100 for n in names]
        assert sum(held) <= 8_000 or len(held) == 1
    # the shares of three tasks use numbers of their own
    assert all(len(set(p["slice"] % 3)) == 1 for p in parts)


def test_paths_are_those_of_the_text_source(spark, tmp_path):
    folder = tmp_path / "a folder"
    folder.mkdir()
    for name in ("a.txt", "b c.txt", "_u.txt", "é ü.txt", "x+y%20#?.txt", "中文.txt", "q'(1)!~*.txt", "br[1]{2}.txt", "nbsp x.txt", "^`|.txt", "empty.txt", ".h.txt", "z.TXT"):
        (folder / name).write_bytes(b"" if name == "empty.txt" else name.encode())
    (folder / "dir.txt").mkdir()
    for path in (str(folder), f"{folder}/"):
        got, want = (sorted(map(tuple, f(spark, path, "*.txt").collect())) for f in (whole_files, files._text_files))
        assert got == want and len(got) == 10


def test_a_folder_without_files(spark, tmp_path):
    assert whole_files(spark, str(tmp_path), "*.txt").collect() == []


def test_files_are_handed_on_in_batches_of_bytes(tmp_path, monkeypatch):
    for i in range(50):
        (tmp_path / f"{i:02d}.txt").write_bytes(b"x" * 100)
    monkeypatch.setattr(files, "READ_BATCH_BYTES", 1_000)
    listed = pa.RecordBatch.from_pydict({"name": [f"{i:02d}.txt" for i in range(50)]})
    batches = list(files._read_files(str(tmp_path))(iter([listed])))
    assert max(b.num_rows for b in batches) <= 10 and sum(b.num_rows for b in batches) == 50


def test_staged_texts_are_not_copied_into_python(tmp_path, monkeypatch):
    monkeypatch.setattr("pyspark.TaskContext.get", lambda: SimpleNamespace(partitionId=lambda: 3, taskAttemptId=lambda: 7))
    text = "é中" * 20_000
    batch = lambda k: pa.RecordBatch.from_pydict({"name": [f"{k}-{i}" for i in range(100)], "content": [text] * 100})
    given, staged = [batch(k) for k in range(2)], []
    tracemalloc.start()
    try:
        for out in _stage(str(tmp_path), False)(iter(given)):
            staged += out.to_pylist()
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 1 << 20 < given[0].nbytes
    assert {r["name"]: r["bytes"] for r in staged} == {f"{k}-{i}": 100_000 for k in range(2) for i in range(100)}
    assert all((tmp_path / r["staged"]).read_text(encoding="utf-8") == text for r in staged[::50])


def test_parquet_parts_follow_the_data(spark, tmp_path, monkeypatch):
    rows = [(i, "x" * 1_000 if i % 4 else None) for i in range(400)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(fixtures, "PART_BYTES", 10_000)
    out = spark.read.parquet(fixtures.write_parquet_parts(spark, str(tmp_path)))
    by_file = out.groupBy(out["_metadata.file_name"].alias("f")).count().collect()
    assert 20 <= len(by_file) <= 30 and max(r["count"] for r in by_file) <= 40
    assert sorted(tuple(r) for r in out.select("doc_id", "text").collect()) == rows
