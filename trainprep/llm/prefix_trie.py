"""Conversation prefix trie by burst tries.

Every distinct sequence of first turns is a node.  A turn is a 128-bit id of
its role and text; a conversation is the string of its turns' ids, so that
strings compare as their sequences do.

1. conversations of one string become one entry with a count and the least
   id, summed up within tasks first: thousands of copies weigh as one;
2. all entries start in one container under the root.  A container of over
   ``container`` entries bursts: its trie head is the longest beginning that
   all its entries share, and each goes on to the container of its next turn
   id (entries that end at the head stay with it).  Rounds of joins do this to
   all oversized containers at once; entries of the others are left alone.
   A beginning shared by many is one head however many turns it has, so the
   rounds follow the branching, not the length;
3. the remaining containers are dealt out by a hash of their head, sorted and
   swept: neighbours' common beginnings open and close the nodes, and a node
   that closes knows its members, children, leaves and savings;
4. heads get theirs from their containers, round by round upwards.

The digest of the ids that end at a node is sequential, so it reads a stream:
ranges of (string, id) are joined to text by tasks of their own, and these
pieces meet in order.

Defined results: rows without a conversation id are left out; turns stand in
order of turn (null first), then of their ids; a null role or text is empty;
equal rows are turns each; an empty table gives no nodes; extra columns are
ignored.  A conversation is one record, of 16 bytes a turn, in the task that
holds it; a text is never held.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trainprep.llm.common import parts_for, staged

WIDTH = 16  # bytes of a turn id
CONTAINER = 256
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
WORD = r"[^\x20\x09-\x0D]+"


def sequences(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv_id, turns)``: each conversation's turns in order, as
    ``(id, words)``; the texts go no further."""
    who, said = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    rows = turns.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"),
        F.md5(F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, said)).alias("id"), F.regexp_count(said, F.lit(WORD)).alias("words"),
    )
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "id", "words"))).alias("t"))
    return grouped.select("conv_id", F.transform("t", lambda x: F.struct(x["id"].alias("id"), x["words"].alias("words"))).alias("turns"))


def share_beginnings(convs: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Each conversation's first ``crc32(id) mod most`` turns replaced by
    those of the conversation whose id is the last multiple of ``every``."""
    own = convs.select("conv_id", "turns", (F.col("conv_id") - F.col("conv_id") % every).alias("base"), (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int").alias("h"))
    base = convs.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, most - 1).alias("first"))
    first = F.coalesce(F.slice("first", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    return own.join(base, "base", "left").select("conv_id", F.concat(first, F.slice("turns", F.col("h") + 1, F.size("turns"))).alias("turns"))


def _digests(ids: DataFrame) -> DataFrame:
    """``(entry, ends_sha256)`` of ``ids (entry, conv_id)``."""
    ranged = ids.repartitionByRange("entry", "conv_id").sortWithinPartitions("entry", "conv_id")

    def joined(batches):
        for batch in batches:
            entry = batch.column(0).to_pylist()
            convs = batch.column(1).to_pylist()
            cuts = [0, *(i for i in range(1, len(entry)) if entry[i] != entry[i - 1]), len(entry)]
            spans = [(a, b) for a, b in zip(cuts, cuts[1:]) if a < b]
            yield pa.RecordBatch.from_arrays(
                [pa.array([entry[a] for a, _ in spans], pa.binary()), pa.array([convs[a] for a, _ in spans], pa.int64()),
                 pa.array([",".join(map(str, convs[a:b])) for a, b in spans], pa.string())],
                names=["entry", "at", "piece"],
            )

    pieces = ranged.mapInArrow(joined, "entry binary, at long, piece string")
    dealt = pieces.repartition("entry").sortWithinPartitions("entry", "at")

    def hashed(batches):
        now, state = None, None
        for batch in batches:
            done: list = [[], []]
            for entry, piece in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if entry == now:
                    state.update(b"," + piece.encode())
                    continue
                if now is not None:
                    done[0].append(now)
                    done[1].append(state.hexdigest())
                now, state = entry, hashlib.sha256(piece.encode())
            yield pa.RecordBatch.from_arrays([pa.array(done[0], pa.binary()), pa.array(done[1], pa.string())], names=["entry", "ends_sha256"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([state.hexdigest()], pa.string())], names=["entry", "ends_sha256"])

    return dealt.mapInArrow(hashed, "entry binary, ends_sha256 string")


def _common(a: bytes, b: bytes) -> int:
    """Turns that two strings share at their beginning."""
    n = min(len(a), len(b)) // WIDTH
    x, y = (np.frombuffer(s, f"S{WIDTH}", n) for s in (a, b))
    # numpy drops trailing zero bytes of both alike, so compare as numbers
    differ = (x.view("<u8").reshape(-1, 2) != y.view("<u8").reshape(-1, 2)).any(axis=1)
    return int(differ.argmax()) if differ.any() else n


_HEADS = "key binary, parent binary, depth int, common int, rest array<long>"


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Oversized containers with their longest common beginning, and for each
    node from their top to there its words and those of the nodes behind it."""
    for batch in batches:
        out: list = [[] for _ in range(5)]
        for row in batch.to_pylist():
            common = _common(row["least"]["seq"], row["most"])
            words = np.array([0, *row["least"]["words"]][row["depth"] : common + 1], np.int64)
            for cell, x in zip(out, (row["key"], row["parent"], row["depth"], common, words[::-1].cumsum()[::-1])):
                cell.append(x)
        yield pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.binary()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.int32()), pa.array(out[3], pa.int32()), pa.array(out[4], pa.list_(pa.int64()))],
            names=["key", "parent", "depth", "common", "rest"],
        )


_NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, entry binary, under binary, top boolean"
_NODE_NAMES = [c.split()[0] for c in _NODE.split(", ")]


def _swept(table: pa.Table) -> pa.Table:
    """All nodes of the containers of a shard.  ``under`` is the head above a
    container, given at its top node, whose parent is found later."""
    rows = sorted(table.to_pylist(), key=lambda r: (r["key"], r["seq"]))
    out: list[list] = [[] for _ in _NODE_NAMES]
    open_: list[dict] = []

    def close(keep: int, top: bytes | None) -> None:
        """Closes all open nodes but the first ``keep``."""
        while len(open_) > keep:
            node = open_.pop()
            is_top = not open_
            row = len(out[0])
            leaves = node["leaves"] if node["below"] else 1
            saved = node["saved"] + (node["n"] - 1) * node["words"]
            values = (node["least"], node["depth"], None, node["n"], len(node["below"]), leaves, saved, node["entry"], top if is_top else None, is_top)
            for column, x in zip(out, values):
                column.append(x)
            for child in node["below"]:
                out[2][child] = node["least"]
            if open_:
                up = open_[-1]
                up["below"].append(row)
                up["n"] += node["n"]
                up["least"] = min(up["least"], node["least"])
                up["leaves"] += leaves
                up["saved"] += saved

    before: dict | None = None
    for row in rows:
        base, seq = row["depth"], row["seq"]
        if before is None or row["key"] != before["key"]:
            close(0, before and before["parent"])
            shared = base - 1  # nothing of this container is open
        else:
            shared = _common(seq, before["seq"])
            close(shared - base + 1, None)
        words = [0, *row["words"]]
        for depth in range(shared + 1, len(seq) // WIDTH + 1):
            open_.append({"depth": depth, "least": row["least"], "n": 0, "leaves": 0, "saved": 0, "words": words[depth], "below": [], "entry": None})
        end = open_[-1]
        end["n"] += row["n"]
        end["least"] = min(end["least"], row["least"])
        end["entry"] = row["entry"]
        before = row
    close(0, before and before["parent"])
    kinds = {"long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
    return pa.table({c.split()[0]: pa.array(x, kinds[c.split()[1]]) for c, x in zip(_NODE.split(", "), out)})


def _begins(length: Column) -> Column:
    """Key of the container of the first ``length`` turns of ``seq``."""
    return F.unhex(F.md5(F.substring(F.col("seq"), F.lit(1), length * WIDTH)))


def trie(convs: DataFrame, container: int = CONTAINER) -> DataFrame:
    """One row per node of ``convs (conv_id, turns)``: ``conv_id`` (least
    member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens``, ``ends_sha256``."""
    seq = F.unhex(F.array_join(F.transform("turns", lambda x: x["id"]), ""))
    strings = staged(convs.select("conv_id", seq.alias("seq"), F.transform("turns", lambda x: x["words"]).alias("words")).withColumn("entry", F.unhex(F.md5("seq"))), "trie-strings")
    digests = staged(_digests(strings.select("entry", "conv_id")), "trie-digests")
    entries = strings.groupBy("entry").agg(F.min("conv_id").alias("least"), F.count("*").alias("n"), F.any_value("seq").alias("seq"), F.any_value("words").alias("words"))
    root = F.unhex(F.md5(F.lit(b"")))
    now = staged(entries.withColumns({"key": root, "depth": F.lit(0), "parent": F.lit(None).cast("binary")}), "trie-entries")
    n_entries = now.count()

    closed, heads, ends = [], [], []
    while True:
        # sums, and the first and last string, of each container; hot ones are summed up within tasks
        full = now.groupBy("key").agg(F.count("*").alias("c"), F.max("depth").alias("depth"), F.max("parent").alias("parent"), F.min(F.struct("seq", "words")).alias("least"), F.max("seq").alias("most"))
        burst = staged(full.where(F.col("c") > container).drop("c").mapInArrow(_heads, _HEADS), "trie-heads")
        if burst.isEmpty():
            closed.append(now)
            break
        heads.append(burst)
        met = now.join(burst.select("key", "common"), "key", "left")
        longer = F.octet_length("seq") > F.col("common") * WIDTH
        gone = F.when(F.col("common").isNull(), "closed").when(longer, "open").otherwise("end")
        met = staged(met.withColumn("state", gone), "trie-round")
        closed.append(met.where("state = 'closed'").drop("state", "common"))
        ends.append(met.where("state = 'end'").select(F.col("key").alias("under"), "entry", "least", "n"))
        now = met.where("state = 'open'").select(
            "entry", "least", "n", "seq", "words", _begins(F.col("common") + 1).alias("key"), (F.col("common") + 1).alias("depth"), F.col("key").alias("parent")
        )

    every = closed[0]
    for other in closed[1:]:
        every = every.unionByName(other)
    shard = F.pmod(F.xxhash64("key"), F.lit(parts_for(n_entries, 2 * container))).alias("shard")
    swept = staged(every.select(shard, "key", "parent", "depth", "seq", "words", "least", "n", "entry").groupBy("shard").applyInArrow(_swept, _NODE), "trie-nodes")
    found = [swept.where("not top").drop("under", "top")]
    tops = swept.where("top")  # nodes whose parents are heads of rounds not yet summed up

    # upwards: a head adds up the nodes right below it and the entry that ends there
    for burst, ended in zip(reversed(heads), reversed(ends)):
        below = tops.where("under is not null").groupBy("under").agg(
            F.count("*").alias("children"), F.sum("n_convs").alias("n"), F.min("conv_id").alias("least"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")
        )
        own = ended.withColumnsRenamed({"least": "end_least", "n": "end_n"})
        head = burst.join(below, burst.key == below.under).drop("under").join(own, burst.key == own.under, "left").drop("under")
        head = head.withColumns({"n": F.col("n") + F.coalesce("end_n", F.lit(0)), "least": F.least("least", "end_least")}).drop("end_n", "end_least")
        head = staged(head, "trie-sums")
        parents = head.select(F.col("key").alias("under"), F.col("least").alias("above"))
        named = tops.join(parents, "under", "left")
        found.append(named.where("above is not null").withColumn("parent_conv_id", F.col("above")).drop("under", "top", "above"))
        # the head and the nodes from its container's top to it have the same members
        place = F.posexplode("rest").alias("step", "to_pay")
        chain = head.select("*", place).select(
            F.col("least").alias("conv_id"), (F.col("depth") + F.col("step")).cast("long").alias("depth"), F.when(F.col("step") > 0, F.col("least")).alias("parent_conv_id"),
            F.col("n").alias("n_convs"), F.when(F.col("depth") + F.col("step") == F.col("common"), F.col("children")).otherwise(F.lit(1)).alias("n_children"), F.col("leaves").alias("n_leaves"),
            (F.col("saved") + (F.col("n") - 1) * F.col("to_pay")).alias("saved_tokens"),
            F.when(F.col("depth") + F.col("step") == F.col("common"), F.col("entry")).alias("entry"), F.when(F.col("step") == 0, F.col("parent")).alias("under"), (F.col("step") == 0).alias("top"),
        )
        chain = staged(chain, "trie-chains")
        found.append(chain.where("not top").drop("under", "top"))
        tops = named.where("above is null").drop("above").unionByName(chain.where("top"))
    found.append(tops.drop("under", "top"))  # the root, or nothing

    nodes = found[0]
    for other in found[1:]:
        nodes = nodes.unionByName(other)
    nodes = nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "entry")
    # inner nodes, most of all, need no digest and take no part in the join
    with_ends = nodes.where("entry is not null").join(digests, "entry").drop("entry")
    return nodes.where("entry is null").withColumn("ends_sha256", F.lit(EMPTY_SHA256)).drop("entry").unionByName(with_ends)
