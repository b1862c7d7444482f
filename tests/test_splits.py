"""CSV and JSON files read by many tasks equal Python's own readers."""

import csv
import io
import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from trainprep.sources.files import load_dataset, scan_openers
from trainprep.sources.splits import csv_line_ends_inside, csv_records, json_elements, json_piece


@pytest.fixture()
def small_splits(spark):
    def cut(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield cut
    for k, v in before.items():
        spark.conf.set(k, v)


@settings(max_examples=600, deadline=None)
@given(st.lists(st.text(st.sampled_from('a",\r é'), max_size=8), max_size=8))
def test_line_state_is_that_of_the_csv_module(lines):
    """Outside behind a line: what follows starts a record of its own."""
    inside = False
    for k, line in enumerate(lines):
        inside = csv_line_ends_inside(line, inside)
        text = "".join(x + "\n" for x in lines[: k + 1])
        rows = list(csv.reader(io.StringIO(text + "MARK,2\n", newline="")))
        assert (rows[-1] == ["MARK", "2"]) == (not inside) or inside and rows[-1] != ["MARK", "2"]


@settings(max_examples=300, deadline=None)
@given(st.recursive(st.none() | st.booleans() | st.text(st.sampled_from('a"\\{}[] é\n'), max_size=6), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text(st.sampled_from('k"}\\'), max_size=3), x, max_size=3), max_leaves=12), st.booleans())
def test_pieces_of_json_balance(value, ascii_only):
    pieces = json.dumps([value], ensure_ascii=ascii_only).split("}")
    inside, depth = False, 0
    for k, piece in enumerate(pieces):
        inside, moved = json_piece(piece, inside)
        depth += moved - (not inside and k < len(pieces) - 1)
    assert not inside and depth == 0


def _csv_text(rng, n):
    out = io.StringIO(newline="")
    for _ in range(n):
        row = [rng.choice(["plain", "", " pad ", 'say "hi"', "a,b", "x\ny", "\n\n\n", "r\rs", "c\r\nd", "é漢", "q" * rng.randrange(40)]) for _ in range(rng.randrange(4))]
        if rng.random() < 0.2:
            out.write(rng.choice(['bare "quotes" in, a field\n', 'x"y,z\r\n', "\n", '"closed"junk,2\n', "lone\rreturn,1\n"]))
        else:
            csv.writer(out, quoting=rng.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]), lineterminator=rng.choice(["\n", "\r\n"])).writerow(row)
    return out.getvalue()


@pytest.mark.parametrize("size", [7, 40, 1 << 20])
def test_csv_of_many_splits_equals_python(spark, tmp_path, small_splits, size):
    rng = random.Random(size)
    want = {}
    for k in range(3):
        text = _csv_text(rng, 60) + ('"open to the end\nof the file' if k == 1 else "")
        (tmp_path / f"{k}.csv").write_bytes(text.encode())
        want[f"{k}.csv"] = list(csv.reader(io.StringIO(text, newline="")))
    # a field over many splits
    long = "first,second\n" + 'a,"' + "line of a long field\n" * 40 + '"\nlast,row'
    (tmp_path / "9.csv").write_bytes(long.encode())
    want["9.csv"] = list(csv.reader(io.StringIO(long, newline="")))
    small_splits(size)
    df = csv_records(spark, str(tmp_path))
    got = {}
    for r in sorted(df.collect(), key=lambda r: (r.path, r.begin, r.seq)):
        got.setdefault(r.path.rsplit("/", 1)[1], []).append(r.fields)
    # the module gives an unfinished last field without a line end of its own
    clean = lambda rows: [[f.rstrip("\n") if i == len(rows) - 1 else f for f in r] for i, r in enumerate(rows)]
    assert {k: clean(v) for k, v in got.items()} == {k: clean(v) for k, v in want.items()}
    if size < 100:
        assert len({(r.path, r.begin) for r in df.collect()}) > 8


def test_openers_of_one_file_by_many_tasks(spark, tmp_path, small_splits):
    rng = random.Random(3)
    pairs = [("".join(rng.choices('ab, "\n', k=rng.randrange(30))), "".join(rng.choices('cd, "\n', k=rng.randrange(30)))) for _ in range(300)]
    with open(tmp_path / "o.csv", "w", newline="") as f:
        csv.writer(f).writerows([("think", "respond"), *pairs])
    small_splits(300)
    got = [tuple(r) for r in scan_openers(spark, str(tmp_path), skip_header=True).orderBy("opener_id").collect()]
    want = [(a.strip(), b.strip()) for a, b in pairs if a.strip() and b.strip()]
    assert got == [(i, *p) for i, p in enumerate(want)]


def test_bad_bytes_name_the_file(spark, tmp_path):
    (tmp_path / "o.csv").write_bytes(b"a,b\n\xff,c\n")
    with pytest.raises(Exception, match="invalid UTF-8 in .*o.csv"):
        csv_records(spark, str(tmp_path)).collect()


def _objects(rng, n):
    text = lambda: "".join(rng.choices('ab "\\{}[],:é漢\n', k=rng.randrange(12)))
    return [{"n": i, "t": text(), "deep": {"a": [{"b": text()}, {}], "c": None}, "l": [text() for _ in range(rng.randrange(3))]} for i in range(n)]


@pytest.mark.parametrize("size", [9, 64, 1 << 20])
@pytest.mark.parametrize("indent", [None, 2])
def test_arrays_of_many_splits_equal_python(spark, tmp_path, small_splits, size, indent):
    rng = random.Random(size)
    want = {}
    for k, n in enumerate([40, 1, 0]):
        rows = _objects(rng, n)
        body = json.dumps(rows, indent=indent, ensure_ascii=k == 0)
        (tmp_path / f"{k}.json").write_bytes((" \n" if k else "").encode() + body.encode() + (b"\n" if n else b""))
        if rows:
            want[f"{k}.json"] = rows
    (tmp_path / "one.json").write_bytes(b"\xef\xbb\xbf" + json.dumps(_objects(rng, 1)[0], indent=indent).encode())
    small_splits(size)
    rows = sorted(json_elements(spark, str(tmp_path)).collect(), key=lambda r: (r.path, r.begin, r.seq))
    got = {}
    for r in rows:
        got.setdefault(r.path.rsplit("/", 1)[1], []).append(json.loads(r.element))
    assert len(got.pop("one.json")) == 1
    assert got == want


@pytest.mark.parametrize("bad", ['[{"a": 1}', '[{"a": 1}, 2]', "[1, 2]", '[{"a": 1}]]', '[{"a": "x}]', '{"a": {"b": 1}', '[[{"a": 1}]]', '{"a": 1} {"a": 2}', '[{"a": 1} {"a": 2}]'])
def test_broken_arrays_are_errors(spark, tmp_path, bad):
    (tmp_path / "x.json").write_text(bad)
    with pytest.raises(Exception, match="JSON|objects"):
        json_elements(spark, str(tmp_path)).collect()


def test_one_array_is_loaded_by_many_tasks(spark, tmp_path, small_splits):
    rows = [{"a": i, "b": "x" * 50} for i in range(2000)]
    (tmp_path / "rows.json").write_text(json.dumps(rows))
    small_splits(10_000)
    df = load_dataset(spark, str(tmp_path / "rows.json"))
    assert df.rdd.getNumPartitions() > 4
    assert sorted(map(tuple, df.collect())) == [(r["a"], r["b"]) for r in rows]
