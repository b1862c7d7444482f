"""Secret scans by multipart credential linking, in native functions.

Strong parts (assignments of a secret, access keys, long hex runs) are
reported wherever they stand.  Weak parts (login names, endpoints, opaque
strings) are ordinary text by themselves, so they are reported only when
complementary parts stand in the same scope, that is within ``scope`` code
points of the text: a login next to a secret, an opaque string next to an
access identifier, an endpoint next to both.

The interval join of parts with complementary parts is a sweep: the parts of
a row in order of their start, each with the furthest end seen before it and
the nearest start still to come of every role.  It is linear in the parts;
no pairs are made.  Only positions are shuffled, once, by row.

Positions come from the matches and the gaps between them (``split``), in
code points.  Defined results: a null text is empty; rows with equal ids each
give a row; extra columns are ignored; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_VALUE = r"[A-Za-z0-9+/_.=-]+"
_SET = r"""["']?\x20*[:=]\x20*["']?"""

#: kind, role, base, pattern, group whose length counts, its least length
#: (a longest run of fixed characters may state its length in the pattern)
KINDS = [
    ("assign", "secret", True, rf"((?i:password|passwd|secret|token|api_?key)){_SET}({_VALUE})", 2, 12),
    ("access", "ident", True, r"AKIA[A-Z0-9]{14,}", 0, 18),
    ("hex", "secret", True, r"[0-9a-f]{16,}", 0, 16),
    ("login", "ident", False, rf"((?i:user_?name|user|login|client_?id|access_?key_?id)){_SET}([A-Za-z0-9+/_.@=-]+)", 2, 3),
    ("endpoint", "endpoint", False, r"""(?i:https?|ftp|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\s"'<>]+""", 0, 10),
    ("opaque", "secret", False, r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[a-z0-9+/_-]*[A-Z])[A-Za-z0-9+/_-]{20,}", 0, 20),
]
SCOPE = 200


def _matches(text: Column, number: int) -> Column:
    """Per match: kind, its place in the row's matches of that kind, code
    points from the end of the match before, its own, and if it counts."""
    _, _, _, pattern, group, least = KINDS[number]
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    zipped = F.arrays_zip(whole.alias("w"), F.split(text, pattern, -1).alias("g"), value.alias("v"))
    # one more gap than matches: the last has no match
    rows = F.transform(
        zipped,
        lambda x, i: F.struct(
            F.lit(number).alias("kind"), i.alias("nth"), F.length(x["g"]).alias("gap"), F.length(x["w"]).alias("len"),
            (F.length(x["v"]) >= least).alias("ok"),
        ),
    )
    return F.when(F.size(whole) > 0, F.filter(rows, lambda x: x["len"].isNotNull()))


def parts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE, payload: list[str] | None = None) -> DataFrame:
    """``(row, id, keep, kind, start, end)``: the reported spans, and one row
    with null kind for a row of ``docs`` without any; ``keep`` holds the
    ``payload`` columns once per row."""
    body = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    own = F.struct(*[F.col(c) for c in payload]) if payload else F.lit(None).cast("int")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), own.alias("own"), body.alias("body"))
    empty = F.array().cast("array<struct<kind:int,nth:int,gap:int,len:int,ok:boolean>>")
    every = F.concat(*[F.coalesce(_matches(F.col("body"), k), empty) for k in range(len(KINDS))])
    flat = rows.select("row", "id", "own", F.posexplode_outer(every).alias("pos", "m"))
    flat = flat.select("row", "id", F.when(F.coalesce("pos", F.lit(0)) == 0, F.col("own")).alias("keep"), "m.*").repartition("row")
    order = Window.partitionBy("row", "kind").orderBy("nth")
    placed = flat.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(order).cast("int"))
    placed = placed.withColumn("start", F.col("end") - F.col("len"))

    base = F.col("kind") < sum(k[2] for k in KINDS)
    counts = F.coalesce("ok", F.lit(False))
    sweep = Window.partitionBy("row").orderBy(F.col("start"), F.col("end"), F.col("kind"))
    before, after = sweep.rowsBetween(Window.unboundedPreceding, -1), sweep.rowsBetween(1, Window.unboundedFollowing)

    def furthest(which: Column) -> Column:
        return F.max(F.when(which, F.col("end"))).over(before)

    def nearest(which: Column) -> Column:
        return F.min(F.when(which, F.col("start"))).over(after)

    # a login or opaque string inside a base span is that span already
    solid = counts & base
    covered = (furthest(solid) > F.col("start")) | (nearest(solid) < F.col("end"))
    alone = (F.col("kind") == _number("endpoint")) | base | ~F.coalesce(covered, F.lit(False))
    live = placed.withColumn("part", counts & alone)
    for role in ("ident", "secret", "endpoint"):
        of_role = F.col("part") & F.col("kind").isin([k for k, x in enumerate(KINDS) if x[1] == role])
        close = (F.col("start") - furthest(of_role) <= scope) | (nearest(of_role) - F.col("end") <= scope)
        live = live.withColumn(f"near_{role}", F.coalesce(close, F.lit(False)))
    linked = (
        F.when(F.col("kind") == _number("login"), F.col("near_secret"))
        .when(F.col("kind") == _number("opaque"), F.col("near_ident"))
        .when(F.col("kind") == _number("endpoint"), F.col("near_ident") & F.col("near_secret"))
        .otherwise(F.lit(True))
    )
    good = F.col("part") & linked
    return live.select(
        "row", "id", "keep", F.when(good, F.col("kind")).alias("kind"), F.when(good, F.col("start")).alias("start"), F.when(good, F.col("end")).alias("end")
    )


def _number(kind: str) -> int:
    return [k[0] for k in KINDS].index(kind)


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k[0]) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE, payload: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: id, ``spans`` (array of kind, start, end
    by start, then kind) and its ``payload`` struct."""
    found = parts(docs, id_col, text_col, scope, payload)
    span = F.when(F.col("kind").isNotNull(), F.struct("start", "kind", "end"))
    grouped = found.groupBy("row").agg(F.first("id").alias(id_col), F.first("keep", True).alias("payload"), F.sort_array(F.collect_list(span)).alias("spans"))
    return grouped.drop("row")


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, hash of the base spans and all spans as text."""
    spans = F.col("spans")
    names = [k[0] for k in KINDS if k[2]]
    kinds = F.transform(spans, lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{name}") for k, name in enumerate(names)]
    base = F.filter(spans, lambda s: s["kind"] < len(names))
    return found.select(id_col, *counts, F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(spans).alias("spans"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE, mask: str = "[SECRET]") -> DataFrame:
    """The rows of ``docs`` with every reported span replaced by ``mask``
    (overlapping spans by one)."""
    found = find(docs, id_col, text_col, scope, payload=docs.columns)
    body = F.col("payload")[text_col]
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        before = F.substring(body, acc["at"] + 1, s["start"] - acc["at"])
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(fresh, F.concat(acc["out"], before, F.lit(mask))).otherwise(acc["out"]).alias("out"),
        )

    clean = F.aggregate("spans", start, step, lambda acc: F.concat(acc["out"], F.substring(body, acc["at"] + 1, F.length(body))))
    return found.select(*[(F.when(F.size("spans") > 0, clean).otherwise(body) if c == text_col else F.col("payload")[c]).alias(c) for c in docs.columns])
