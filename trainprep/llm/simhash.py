"""SimHash near-duplicates: fingerprints linked by BK-trees.

Each text gets a 64-bit SimHash of its word shingles.  Two distinct
fingerprints link when they differ in at most ``radius`` bits; linked
fingerprints form components.

Links are found by BK-trees (children keyed by the integer Hamming distance
to their parent, only edges within the radius are followed).  The trees are
sharded: the bits fall into ``radius + 2`` blocks, so two fingerprints
within the radius agree on at least two whole blocks, and there is one tree
for every pair of blocks and value on them.  Shard trees are dealt out by
a shuffle, not broadcast: together they grow with the data.  A value that
more than ``tree_rows`` fingerprints share is split into several trees, and
each is searched by the members of one other tree at a time, so no group
holds more than two trees' members.  A search reports one link to a root per
member (a spanning forest of its links, not all pairs); components over all
trees follow by repeated minimum over stars.

Defined results: a null or blank text has fingerprint zero and links like
any other; equal texts share a fingerprint, hence a component; a null id
takes no part in the smallest id; extra columns are ignored; no rows give
no rows.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trainprep.llm.common import sliced, staged

BITS = 64
TREE_ROWS = 20_000


def simhash64(hashes) -> int:
    """Bit b is one if it is one in over half of the hashes (none: zero)."""
    import numpy as np

    h = np.asarray(hashes, dtype="<u8")
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(h), 1 << 16):
        part = h[at : at + (1 << 16)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(h)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def shingle_hashes(text: bytes, shingle: int, seed: int) -> list[int]:
    """XXH64 of every run of ``shingle`` words (A-Z lower-cased, split at
    ASCII white space, joined by one space); fewer words: of all of them."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= shingle:
        return [xxh64_intdigest(joined, seed)]
    ends = list(accumulate((len(w) + 1 for w in words)))
    starts = [0, *ends]
    return [xxh64_intdigest(joined[s : e - 1], seed) for s, e in zip(starts, ends[shingle - 1 :])]


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42, key: Column | None = None
) -> DataFrame:
    """``(id, fp)``, with ``key`` ``(id, fp, key)``: one signed 64-bit
    fingerprint per row."""
    keys = [] if key is None else [key.cast("binary").alias("key")]
    extra = len(keys)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("body"), *keys)

    def compute(batches):
        for batch in sliced(batches, 1, 2 << 20):
            fps = [simhash64(shingle_hashes(t or b"", shingle, seed)) for t in batch.column(1).to_pylist()]
            signed = [f - (1 << 64) if f >> 63 else f for f in fps]
            own = [batch.column(2)] if extra else []
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(signed, pa.int64()), *own], names=["id", "fp", "key"][: 2 + len(own)])

    return rows.mapInArrow(compute, "id long, fp long" + ", key binary" * extra)


class BKTree:
    """Children keyed by the Hamming distance to their parent."""

    def __init__(self) -> None:
        self.root: tuple[int, dict] | None = None

    def add(self, value: int) -> None:
        if self.root is None:
            self.root = (value, {})
            return
        node = self.root
        while True:
            d = (node[0] ^ value).bit_count()
            if not d:
                return
            child = node[1].get(d)
            if child is None:
                node[1][d] = (value, {})
                return
            node = child

    def within(self, value: int, radius: int) -> list[int]:
        found, stack = [], [self.root] if self.root else []
        while stack:
            here, children = stack.pop()
            d = (here ^ value).bit_count()
            if d <= radius:
                found.append(here)
            for edge, child in children.items():
                if d - radius <= edge <= d + radius:
                    stack.append(child)
        return found


def _forest(members: list[int], others: list[int], radius: int) -> list[tuple[int, int]]:
    """(value, root) for each value linked to another: a spanning forest of
    the links among ``members``, or from ``others``, where there are any, to
    ``members``."""
    tree, parent = BKTree(), {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    for value in members:
        for near in tree.within(value, radius) if not others else ():
            a, b = sorted((root(value), root(near)))
            parent[b] = a
        tree.add(value)
    for value in others:
        for near in tree.within(value, radius):
            a, b = sorted((root(value), root(near)))
            parent[b] = a
    return [(v, r) for v in parent if (r := root(v)) != v]


def _bands(bits: int, radius: int) -> list[tuple[int, int]]:
    """(first bit, width) of ``radius + 2`` blocks."""
    k = radius + 2
    cuts = [bits * i // k for i in range(k + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def near_links(distinct: DataFrame, radius: int = 2, tree_rows: int = TREE_ROWS) -> DataFrame:
    """``(a, b)`` links between distinct fingerprints ``fp`` at ``radius`` or
    fewer bits: a spanning forest per shard tree, every component kept whole."""
    spark = distinct.sparkSession
    blocks = _bands(BITS, radius)
    keys = []
    for t, (i, j) in enumerate(combinations(range(len(blocks)), 2)):
        part = [F.shiftrightunsigned("fp", at).bitwiseAND((1 << w) - 1) for at, w in (blocks[i], blocks[j])]
        keys.append(F.struct(F.lit(t).alias("t"), F.shiftleft(part[0], blocks[j][1]).bitwiseOR(part[1]).alias("v")))
    banded = distinct.select("fp", F.explode(F.array(*keys)).alias("k")).select("fp", "k.t", "k.v")
    # values that very many fingerprints share: several trees; tree s meets
    # its own members (o = s) and those of each later tree o
    hot = banded.groupBy("t", "v").count().where(F.col("count") > tree_rows)
    hot = hot.select("t", "v", F.ceil(F.col("count") / tree_rows).cast("int").alias("trees"))
    trees, own, other = F.coalesce("trees", F.lit(1)), F.col("own"), F.col("other")
    dealt = banded.join(hot, ["t", "v"], "left").select(
        "fp", "t", "v", F.pmod(F.xxhash64("fp"), trees).cast("int").alias("own"), F.explode(F.sequence(F.lit(0), trees - 1)).alias("other")
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = ["t", "v", "s", "o"]
    ordered = dealt.select("fp", "t", "v", F.least(own, other).alias("s"), F.greatest(own, other).alias("o"), (own <= other).alias("member"))
    ordered = ordered.repartition(parts, *key).sortWithinPartitions(*key)

    def search(batches):
        import numpy as np

        held: list = []  # rows of the last key of a batch, which may go on

        def solve(fp, key_change, member):
            a, b = [], []
            bounds = np.flatnonzero(key_change)
            sizes = np.diff(np.append(bounds, len(fp)))
            for at, n in zip(bounds[sizes > 1].tolist(), sizes[sizes > 1].tolist()):
                values, mine = fp[at : at + n].tolist(), member[at : at + n].tolist()
                values = [v & (2**64 - 1) for v in values]
                pairs = _forest([v for v, m in zip(values, mine) if m], [v for v, m in zip(values, mine) if not m], radius)
                for x, y in pairs:
                    a.append(x - 2**64 if x >> 63 else x)
                    b.append(y - 2**64 if y >> 63 else y)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        def ready(final: bool):
            cols = [np.concatenate([h[i] for h in held]) for i in range(6)]
            fp, t, v, s, o, member = cols
            change = np.ones(len(fp), bool)
            change[1:] = (t[1:] != t[:-1]) | (v[1:] != v[:-1]) | (s[1:] != s[:-1]) | (o[1:] != o[:-1])
            last = len(fp) if final else int(np.flatnonzero(change)[-1])
            held[:] = [] if final else [[c[last:] for c in cols]]
            return solve(fp[:last], change[:last], member[:last])

        for batch in batches:
            if batch.num_rows:
                held.append([batch.column(i).to_numpy(zero_copy_only=False) for i in range(6)])
                first, last = held[0], held[-1]
                if any(first[i][0] != last[i][-1] for i in (1, 2, 3, 4)):
                    yield ready(False)
        if held:
            yield ready(True)

    return ordered.mapInArrow(search, "a long, b long").distinct()


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of ``links (a, b)``: the smallest node
    of its component, by alternating large and small stars.  Each round is
    written to the shared folder; rounds grow with the logarithm of the
    longest chain."""
    edges = staged(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc")
    before = None
    for _ in range(max_rounds):
        # large star: every larger neighbour points to the smallest neighbour
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: a node and its smaller neighbours point to the smallest
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = staged(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "cc")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
    raise RuntimeError("components did not settle")


def grouped(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 2, seed: int = 42, tree_rows: int = TREE_ROWS,
    key: Column | None = None,
) -> DataFrame:
    """``(fp, id, component_id, root)`` and, if given, ``key``, one row per
    row of ``docs``; ``root`` names the component whatever its ids."""
    fps = staged(fingerprints(docs, id_col, text_col, shingle, seed, key), "simhash")
    classes = staged(fps.groupBy("fp").agg(F.min("id").alias("first")), "simhash-classes")
    roots = components(near_links(classes.select("fp"), radius, tree_rows))
    named = classes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    # committed before the join, so that a fingerprint of very many copies
    # is a plain skewed join, which Spark splits
    of_fp = staged(named.join(least, "root").select("fp", "component_id", "root"), "simhash-components")
    return fps.join(of_fp, "fp")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 2, seed: int = 42, tree_rows: int = TREE_ROWS
) -> DataFrame:
    """``(id, fingerprint, component_id)``, one row per row of ``docs``:
    16 lower-case hex digits and the smallest id that links reach."""
    return grouped(docs, id_col, text_col, shingle, radius, seed, tree_rows).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
