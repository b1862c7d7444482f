"""Job commit of named files, mapped data kept on disk, slices of archives, hidden names."""

import io
import os
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from trainprep.sinks.files import write_files
from trainprep.sources.files import scan_zip_txt, whole_files, zip_slices
from trainprep.sources.kept import load_mapped


CALLS: list = []


def _listing(folder):
    return {n: open(os.path.join(folder, n)).read() for n in sorted(os.listdir(folder))} if os.path.isdir(folder) else {}


def test_files_are_published_together(spark, tmp_path):
    out = str(tmp_path / "out")
    df = spark.range(50).select(F.format_string("f%02d.txt", "id").alias("name"), F.col("id").cast("string").alias("content")).repartition(5)
    assert tuple(write_files(df, out).first()) == (50, 90)
    assert _listing(out) == {f"f{i:02d}.txt": str(i) for i in range(50)}
    # a second job replaces files of its names only
    write_files(spark.createDataFrame([("f00.txt", "new"), ("g.txt", "g")], "name string, content string"), out)
    now = _listing(out)
    assert now["f00.txt"] == "new" and now["g.txt"] == "g" and len(now) == 51


@pytest.mark.parametrize("rows, message", [([("a", "1"), ("b", "2"), ("a", "3")], "share a file name"), ([("a", "1"), ("b", None)], "no content"), ([("a", "1"), ("c", "boom")], "boom")])
def test_a_failing_job_leaves_the_folder_as_it_was(spark, tmp_path, rows, message):
    out = tmp_path / "out"
    out.mkdir()
    (out / "a").write_text("before")
    content = F.when(F.col("content") == "boom", F.raise_error(F.lit("boom")).cast("string")).otherwise(F.col("content"))
    df = spark.createDataFrame(rows, "name string, content string").repartition(3).withColumn("content", content)
    with pytest.raises(Exception, match=message):
        write_files(df, str(out))
    assert _listing(out) == {"a": "before"}


def test_mapped_data_is_kept(spark, tmp_path):
    source, cache = tmp_path / "in.parquet", str(tmp_path / "cache")
    spark.range(10).write.parquet(str(source))
    calls = CALLS  # a global: what a mapper encloses is part of its state
    calls.clear()

    def mapper(df, add):
        CALLS.append(add)
        return df.select((F.col("id") + add).alias("x"))

    def load(add=1, **kw):
        return sorted(r.x for r in load_mapped(spark, str(source), mapper, load_from_cache=kw.pop("again", True), cache_dir=cache, add=add, **kw).collect())

    assert load() == load() == list(range(1, 11)) and calls == [1]
    assert load(add=2) == list(range(2, 12)) and calls == [1, 2]
    assert load(again=False) == list(range(1, 11)) and calls == [1, 2, 1]
    spark.range(20, 22).write.mode("append").parquet(str(source))
    assert load() == [*range(1, 11), 21, 22] and calls == [1, 2, 1, 1]
    # a write that did not end is not read
    for folder, _, names in os.walk(cache):
        if "_SUCCESS" in names:
            os.rename(os.path.join(folder, "_SUCCESS"), os.path.join(folder, "_STOPPED"))
    assert load() == [*range(1, 11), 21, 22] and calls[4:] == [1]


def test_another_mapper_of_one_name_is_another_state(spark, tmp_path):
    source, cache = tmp_path / "in.parquet", str(tmp_path / "cache")
    spark.range(3).write.parquet(str(source))
    got = []
    for k in (10, 20):
        def mapper(df, k=k):
            return df.select((F.col("id") + k).alias("x"))

        got.append(sorted(r.x for r in load_mapped(spark, str(source), mapper, load_from_cache=True, cache_dir=cache).collect()))
    assert got == [[10, 11, 12], [20, 21, 22]]


def test_archives_are_cut_by_bytes(spark, tmp_path):
    rng = random.Random(2)
    want = []
    for a, sizes in enumerate([[200_000] + [50] * 300, [10] * 5, []]):
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w") as zf:
            zf.writestr("x.md", "no")
            for i, n in enumerate(sizes):
                text = "".join(rng.choices("ab\r\n", k=n))
                zf.writestr(f"m{rng.randrange(10**6):06d}-{i}.txt", text)
                want.append((f"{a}.zip", text))
        (tmp_path / f"{a}.zip").write_bytes(buf.getvalue())
    slices = zip_slices(spark, str(tmp_path), slice_bytes=10_000).groupBy("archive", "slice").count().collect()
    by = sorted((r.archive[-5:], r["slice"], r["count"]) for r in slices)
    huge = [n for a, s, n in by if a == "0.zip"]
    # the large member alone, the small ones in even runs, no number for two archives
    assert huge[0] == 1 and max(huge) <= 10_000 // 114 + 1 and len({s for _, s, _ in by}) == len(by)
    got = sorted((r.archive.rsplit("/", 1)[1], r.text) for r in scan_zip_txt(spark, str(tmp_path)).collect())
    assert got == sorted(want)
    (tmp_path / "none").mkdir()
    assert scan_zip_txt(spark, str(tmp_path / "none")).count() == 0


def test_hidden_names_are_packed_by_bytes(spark, tmp_path):
    for i in range(60):
        (tmp_path / f"{'_' if i % 2 else ''}{i:02d}.txt").write_text(f"text {i}")
    df = whole_files(spark, str(tmp_path), "*.txt")
    assert sorted((r.name, r.value) for r in df.collect()) == sorted((f"{'_' if i % 2 else ''}{i:02d}.txt", f"text {i}") for i in range(60))
    assert df.rdd.getNumPartitions() < 20
