"""Exact top-k search by tiled matrix products.

Vectors become integers, floor(scale * x); the score is the integer inner
product.  Vectors are packed in tiles.  Every group of query tiles meets
every shard of candidate tiles once: both sides are dealt to (group, shard)
tasks, so a task holds one group and one shard whatever the size of the
table.  A task multiplies tile by tile, selects the best of each tile with a
partial sort and keeps a top list per query; lists are merged in a tree, at
most ``fan_in`` at a time.

Tiles are kept and shuffled in the narrowest integers that hold them; a task
widens one query tile at a time.  Products run in float64 where every sum is below 2^53, hence exact, and in
Python integers otherwise; scores beyond 64 bits are cut to them.
Defined results: vectors null or holding null or non-finite components take
no part; only vectors of equal length meet; a row with a null
id takes no part; a query's own row is no candidate, another row with its id
is; equal scores go to the smaller id; fewer candidates than k give fewer rows; a query without
any gives none; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trainprep.llm.common import parts_for, staged

TILE = 2048
_TILE_SCHEMA = "dim int, tile long, n int, ids binary, rows binary, asks binary, mat binary, cell string, wide boolean"


def _tile(dim: int, tile: int, ids, rows, asks, mat) -> pa.RecordBatch:
    top = float(np.abs(mat).max()) if mat.size else 0.0
    cell = "<i2" if top < 2**15 else "<i4" if top < 2**31 else "<f8"  # the narrowest that holds the integers
    cells = [dim, tile, len(mat), *(x.tobytes() for x in (ids.astype("<i8"), rows.astype("<i8"), asks.astype(bool), mat.astype(cell))), cell, top**2 * dim >= 2.0**52]
    kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.string(), pa.bool_())
    names = [c.split()[0] for c in _TILE_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(cells, kinds)], names=names)


def _opened(row: dict) -> dict:
    """A tile's arrays, its vectors by ascending id."""
    ids, rows = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["rows"], "<i8")
    order = np.lexsort((rows, ids))
    mat = np.frombuffer(row["mat"], row["cell"]).reshape(row["n"], row["dim"])
    asks = np.frombuffer(row["asks"], bool)
    return row | {"ids": ids[order], "rows": rows[order], "mat": mat[order], "asks": asks[order]}


def _widened(tile: dict) -> dict:
    return tile | {"mat": tile["mat"].astype("<f8")}


def _packer(tile: int):
    """Collects (ids, rows, asks, matrix) parts by dimension into tiles."""
    from pyspark import TaskContext

    seq, held = TaskContext.get().partitionId() << 32, {}

    def add(dim: int, part: tuple | None, final: bool = False):
        nonlocal seq
        parts = held.setdefault(dim, [])
        if part is not None:
            parts.append(part)
        while parts and (final or sum(len(p[0]) for p in parts) >= tile):
            whole = [np.concatenate(x) for x in zip(*parts)]
            parts[:] = [tuple(x[tile:] for x in whole)] if len(whole[0]) > tile else []
            seq += 1
            yield _tile(dim, seq, *(x[:tile] for x in whole))

    def rest():
        for dim in list(held):
            yield from add(dim, None, True)

    return add, rest


def _candidate_tiles(vectors: DataFrame, scale: float, tile: int) -> DataFrame:
    def run(batches):
        from pyspark import TaskContext

        add, rest = _packer(tile)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            ids, vecs, asks = (batch.column(i) for i in range(3))
            ids, asks = ids.to_numpy(zero_copy_only=False), asks.to_numpy(zero_copy_only=False)
            rows = np.arange(row, row + len(ids))
            row += len(ids)
            sizes = vecs.value_lengths().to_numpy(zero_copy_only=False)
            for dim in np.unique(sizes).tolist():
                own = np.flatnonzero(sizes == dim)
                flat = vecs.take(pa.array(own)).flatten().to_numpy(zero_copy_only=False).astype(float)
                mat = np.floor(flat.reshape(len(own), dim) * scale)
                yield from add(dim, (ids[own], rows[own], asks[own], mat))
        yield from rest()

    return vectors.mapInArrow(run, _TILE_SCHEMA)


def _query_tiles(tiles: DataFrame, tile: int) -> DataFrame:
    def run(batches):
        add, rest = _packer(tile)
        for batch in batches:
            for row in batch.to_pylist():
                t = _opened(row)
                at = t["asks"]
                if at.any():
                    yield from add(t["dim"], (t["ids"][at], t["rows"][at], at[at], t["mat"][at]))
        yield from rest()

    return tiles.mapInArrow(run, _TILE_SCHEMA)


def _products(q: np.ndarray, c: np.ndarray, wide: bool) -> np.ndarray:
    if not wide:
        return (q @ c.T).astype(np.int64)
    whole = [np.array([int(x) for x in m.reshape(-1)], object).reshape(m.shape) for m in (q, c)]
    return np.clip(whole[0] @ whole[1].T, -(2**63), 2**63 - 1).astype(np.int64)


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Columns of each row's k best, best first.  Columns are in the order
    of their ids, so a stable sort settles ties."""
    n = scores.shape[1]
    if n <= 4 * k:
        return np.argsort(~scores, axis=1, kind="stable")[:, :k]
    # partial selection of the k-th best, then all columns that reach it
    floor = np.partition(scores, n - k, axis=1)[:, n - k]
    out = np.empty((len(scores), k), np.int64)
    for i, low in enumerate(floor):
        at = np.flatnonzero(scores[i] >= low)
        out[i] = at[np.argsort(~scores[i, at], kind="stable")[:k]]
    return out


def _merge(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int):
    order = np.lexsort((rows, ids, ~scores), axis=1)[:, :k]
    return tuple(np.take_along_axis(x, order, 1) for x in (scores, ids, rows))


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 256.0,
    tile: int = TILE, group_tiles: int = 32, shard_tiles: int = 2, fan_in: int = 32,
) -> DataFrame:
    """``(query_id, rank, id, score)`` of the rows where ``is_query`` holds,
    against all rows."""
    finite = F.forall(vector_col, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
    rows = vectors.where(F.col(id_col).isNotNull() & F.coalesce(finite, F.lit(False)))
    rows = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    tiles = staged(_candidate_tiles(rows, scale, tile), "tiles")
    queries = staged(_query_tiles(tiles, tile), "query-tiles")
    n_shards, n_groups = parts_for(tiles.count(), shard_tiles), parts_for(queries.count(), group_tiles)
    shard, group = (F.pmod(F.xxhash64("tile"), F.lit(n)).cast("int") for n in (n_shards, n_groups))
    left = tiles.withColumn("s", shard).withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))))
    right = queries.withColumn("g", group).withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))))
    names = ("shard", "qid", "qrow", "id", "row", "score")

    def search(cand: pa.Table, quer: pa.Table) -> pa.Table:
        out: dict[str, list] = {c: [np.empty(0, np.int64)] for c in names}
        tiles_of = [_widened(_opened(r)) for r in cand.to_pylist()]
        for q in (_widened(_opened(r.as_py())) for r in quer.to_struct_array()):
            top = tuple(np.empty((q["n"], 0), np.int64) for _ in range(3))
            for c in tiles_of:
                if c["dim"] == q["dim"]:
                    got = _products(q["mat"], c["mat"], q["wide"] or c["wide"])
                    # one more than k: one may be the query's own row
                    at = _best(got, min(k + 1, c["n"]))
                    new = np.take_along_axis(got, at, 1), c["ids"][at], c["rows"][at]
                    top = _merge(*(np.concatenate(x, axis=1) for x in zip(top, new)), k + 1)
            m = top[0].shape[1]
            cells = [np.full(q["n"] * m, quer["s"][0].as_py()), np.repeat(q["ids"], m), np.repeat(q["rows"], m), top[1], top[2], top[0]]
            for c, x in zip(names, cells):
                out[c].append(x.reshape(-1))
        return pa.table({c: np.concatenate(x).astype(np.int64) for c, x in out.items()})

    found = left.groupBy("g", "s").cogroup(right.groupBy("g", "s")).applyInArrow(search, ", ".join(f"{c} long" for c in names))
    found = found.where("row <> qrow")
    # ascending order of the complement is descending order of the score
    entry = F.struct(F.bitwise_not("score").alias("low"), "id", "row")
    width, lists = n_shards, found.groupBy("qid", "qrow", "shard").agg(F.slice(F.sort_array(F.collect_list(entry)), 1, k).alias("top"))
    while width > 1:  # merge the lists of a query in a tree
        width = parts_for(width, fan_in)
        merged = F.slice(F.sort_array(F.flatten(F.collect_list("top"))), 1, k)
        lists = lists.withColumn("shard", F.pmod("shard", F.lit(width))).groupBy("qid", "qrow", "shard").agg(merged.alias("top"))
    flat = lists.select(F.col("qid").alias("query_id"), F.posexplode("top").alias("at", "e"))
    return flat.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("e.id").alias(id_col), F.bitwise_not("e.low").alias("score"))
