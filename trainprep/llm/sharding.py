"""Sharding by Karmarkar-Karp differencing.

Groups of equal texts are indivisible.  A partial partition is a row of
``shards`` byte sums with the groups of each; two are combined by adding the
largest sum of one to the smallest of the other, and so on in opposite
order.  The two with the largest spread are combined first, until one is
left.

At scale the groups are cut into blocks of about ``block_groups`` by a hash,
each differenced in a task of its own, and the blocks' partial partitions are
differenced in turn, ``FAN_IN`` to a task, level by level.  They are not yet
shards but ``pieces`` times as many pieces of near equal bytes.  Groups larger
than a piece's fair share (fewer than there are pieces, so bounded) take no
part in the blocks: they and the pieces, a few thousand sums, are differenced
last.  So large groups of any size meet pieces that are small enough to fill
the shards up around them, and a corpus of few groups, where every piece is
one group, gets plain differencing.

Slots number the rows of a shard without gaps: rows are counted in small
units dealt by a hash of the id, and each unit starts after the units before
it, so no task holds a shard.

Defined results: a null text weighs ``overhead`` bytes and is a group of its
own apart from the empty text's; equal ids and equal rows each keep a row
and a slot; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from bisect import insort
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trainprep.llm.common import parts_for, staged

Partial = list[tuple[int, list]]  # (sum, groups), largest first
PIECES = 128  # to a shard
FAN_IN = 32


def _least(x: tuple[int, list]) -> int:
    return -x[0]


def combine(a: Partial, b: Partial, shards: int) -> Partial:
    """Largest sums of one with smallest of the other; both are used up."""
    if len(a) + len(b) <= shards:
        if not a or not b or a[-1][0] >= b[0][0]:
            a.extend(b)
            return a
        out = a + b
    elif len(a) == shards and len(b) == 1:
        s, g = a.pop()
        g.extend(b[0][1])
        insort(a, (s + b[0][0], g), key=_least)
        return a
    else:
        out = []
        for i, (s, g) in enumerate(a):
            j = shards - 1 - i
            if j < len(b):
                t, h = b[j]
                big, small = (g, h) if len(g) >= len(h) else (h, g)
                big.extend(small)
                out.append((s + t, big))
            else:
                out.append((s, g))
        out += b[: shards - len(a)]
    out.sort(key=lambda x: -x[0])
    return out


def _spread(p: Partial, shards: int) -> int:
    return p[0][0] - (p[-1][0] if len(p) == shards else 0)


def difference(parts: list[Partial], shards: int) -> Partial:
    """All partial partitions combined, largest spread first."""
    heap = [(-_spread(p, shards), i, p) for i, p in enumerate(parts) if p]
    heapify(heap)
    count = len(parts)
    while len(heap) > 1:
        a, b = heappop(heap)[2], heappop(heap)[2]
        new = combine(a, b, shards)
        count += 1
        heappush(heap, (-_spread(new, shards), count, new))
    return heap[0][2] if heap else []


def assign(groups: DataFrame, shards: int, block_groups: int = 8192, pieces: int = PIECES) -> DataFrame:
    """``(key, shard)`` for ``groups (key, size)``; keys are distinct."""
    spark = groups.sparkSession
    total, n = groups.agg(F.sum("size"), F.count("*")).first()
    total, n_pieces = int(total or 0), shards * pieces
    limit = max(1, total // n_pieces)
    large = groups.where(F.col("size") > limit).orderBy(F.desc("size"), "key").collect()  # under n_pieces rows
    n_blocks = parts_for(int(n) - len(large), block_groups)

    def solve(table: pa.Table) -> pa.Table:
        keys, sizes = table["key"].to_pylist(), table["size"].to_pylist()
        order = sorted(range(len(keys)), key=lambda i: (-sizes[i], keys[i]))
        piece = [0] * len(keys)
        for place, (_, members) in enumerate(difference([[(sizes[i], [i])] for i in order], n_pieces)):
            for m in members:
                piece[m] = place
        return pa.table({"block": table["block"], "key": table["key"], "size": table["size"], "piece": pa.array(piece, pa.int32())})

    blocked = groups.where(F.col("size") <= limit).withColumn("block", F.pmod(F.xxhash64("key"), F.lit(n_blocks)).cast("long"))
    solved = staged(blocked.groupBy("block").applyInArrow(solve, "block long, key binary, size long, piece int"), "kk-blocks")
    names, sums = _relabelled(solved, n_pieces, FAN_IN)
    parts: list[Partial] = [[(int(r["size"]), [bytes(r["key"])])] for r in large] + [[(s, [name])] for name, s in sums]
    parts.sort(key=lambda p: -p[0][0])
    place = {m: i for i, (_, members) in enumerate(difference(parts, shards)) for m in members}
    whole = spark.createDataFrame([(bytes(r["key"]), place[bytes(r["key"])]) for r in large], "key binary, shard int")
    of_piece = F.broadcast(spark.createDataFrame([(name, place[name]) for name, _ in sums], "name int, shard int"))  # n_pieces rows
    return solved.join(names, ["block", "piece"]).join(of_piece, "name").select("key", "shard").unionByName(whole)


def _relabelled(solved: DataFrame, pieces: int, fan_in: int) -> tuple[DataFrame, list[tuple[int, int]]]:
    """``(block, piece, name)``: the blocks' partial partitions differenced in
    levels, ``pieces`` rows a block; and the sum under each name."""
    now = staged(solved.groupBy("block", "piece").agg(F.sum("size").alias("size")), "kk-level")
    names = now.select("block", "piece", F.col("block").alias("node"), F.col("piece").alias("name"))
    nodes = now.select("block").distinct().count()
    level = now.select(F.col("block").alias("node"), F.col("piece").alias("name"), "size")

    def solve(table: pa.Table) -> pa.Table:
        by: dict[int, Partial] = {}
        for node, name, size in zip(*(table[c].to_pylist() for c in ("node", "name", "size"))):
            by.setdefault(node, []).append((size, [(node, name)]))
        parts = [sorted(by[k], key=lambda x: (-x[0], x[1])) for k in sorted(by)]
        out = [(node, name, place) for place, (_, members) in enumerate(difference(parts, pieces)) for node, name in members]
        up = table["up"][0].as_py() if table.num_rows else 0
        cols = list(zip(*out)) or [[], [], []]
        return pa.table({"node": pa.array(cols[0], pa.int64()), "name": pa.array(cols[1], pa.int32()), "up": pa.array([up] * len(out), pa.int64()), "place": pa.array(cols[2], pa.int32())})

    while nodes > 1:
        nodes = parts_for(nodes, fan_in)
        grouped = level.withColumn("up", F.pmod(F.xxhash64("node"), F.lit(nodes)).cast("long")).groupBy("up")
        moved = staged(grouped.applyInArrow(solve, "node long, name int, up long, place int"), "kk-level")
        names = names.join(moved, ["node", "name"]).select("block", "piece", F.col("up").alias("node"), F.col("place").alias("name"))
        names = staged(names, "kk-names")
        level = level.join(moved, ["node", "name"]).groupBy(F.col("up").alias("node"), F.col("place").alias("name")).agg(F.sum("size").alias("size"))
        level = staged(level, "kk-sums")
    sums = level.groupBy("name").agg(F.sum("size").alias("size")).orderBy("name").collect()  # at most ``pieces`` rows
    return names.select("block", "piece", "name"), [(r["name"], int(r["size"])) for r in sums]


def shard(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text", overhead: int = 8, unit_rows: int = 20_000, block_groups: int = 8192) -> DataFrame:
    """``(id, size, text_crc32, shard, slot)``, one row per row of ``docs``."""
    body = F.col(text_col).cast("binary")
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        (F.coalesce(F.octet_length(body), F.lit(0)).cast("long") + overhead).alias("size"),
        F.crc32(F.coalesce(body, F.lit(b""))).alias("text_crc32"),
        F.unhex(F.coalesce(F.sha2(body, 256), F.lit("00"))).alias("key"),
    )
    rows = staged(rows, "shard-rows")
    groups = staged(rows.groupBy("key").agg(F.sum("size").alias("size")), "shard-groups")
    placed = staged(assign(groups, shards, block_groups), "shard-of")
    # both sides are plain scans: Spark splits a group of very many rows
    dealt = rows.join(placed, "key").select("id", "size", "text_crc32", "shard", F.monotonically_increasing_id().alias("tie"))
    n_units = parts_for(rows.count(), unit_rows)
    units = dealt.withColumn("unit", F.pmod(F.xxhash64("id", F.when(F.col("id").isNull(), F.col("tie"))), F.lit(n_units)).cast("int"))
    units = staged(units.drop("tie"), "shard-units")
    sizes = units.groupBy("shard", "unit").count()
    # shards x units rows
    before = sizes.select("shard", "unit", (F.sum("count").over(Window.partitionBy("shard").orderBy("unit")) - F.col("count")).alias("first"))
    inner = F.row_number().over(Window.partitionBy("shard", "unit").orderBy("id", "text_crc32", "size")) - 1
    return units.withColumn("inner", inner).join(before, ["shard", "unit"]).select(
        F.col("id").alias(id_col), "size", "text_crc32", "shard", (F.col("inner") + F.col("first")).cast("long").alias("slot")
    )
