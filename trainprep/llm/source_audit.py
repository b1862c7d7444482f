"""Source divergence audit: how far the wording of each source lies from its peers.

Terms are runs of letters (A-Z and a-z, lower-cased, and every character
beyond ASCII).  The tokenizer is one table: ``bytes.translate`` lowers the
letters and blanks everything else below 128 in one pass, ``bytes.split``
cuts, and a ``Counter`` per document gives the occurrences (its values) and
the document frequencies (its keys).

Execution, with sparse counts from the first step on:

1. tasks add the documents' counters up by (language, source) and emit them
   whenever ``entries`` of them are held, so a worker's memory does not grow;
2. one shuffle by (language, term) adds them up, and decides there which
   terms are in at least ``min_docs`` documents of the language; the kept
   (language, source, term) counts are written once;
3. term scores are columns of that table, and the best ``top`` of each source
   are taken within tasks first;
4. distances between sources: tiles of ``tile`` sources meet over buckets of
   about ``bucket_terms`` terms.  A task holds two small matrices of shares
   and adds up differences over the terms that its sources use; the terms
   that neither uses differ by the same amount each and are added at the end
   as one product.

Shares are integers: ``1 + floor(scale * (count + 5) / (N + 5 V))``, with the
product in decimals, so counts of any size are exact.

Defined results: null text, language or source read as ''; a source without
any term still takes part, with the share of an unseen term; a language
without kept terms gives distances of zero; equal rows count each; an empty
table gives no rows; extra columns are ignored; a text of any length is cut
and counted by pieces of ``PIECE`` bytes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trainprep.llm.common import sliced, staged

PIECE = 1 << 20
SMOOTHING = 5
#: ASCII letters lower-cased, every other ASCII byte a blank, the rest as it is
TABLE = bytes(b if b >= 128 else ord(chr(b).lower()) if chr(b).isalpha() else 32 for b in range(256))


def words(text: bytes, piece: int = PIECE) -> Iterator[list[bytes]]:
    """Terms of a text, a list for each piece of it."""
    rest = b""
    for at in range(0, len(text), piece):
        part = rest + text[at : at + piece].translate(TABLE)
        out = part.split()
        rest = out.pop() if out and not part.endswith(b" ") and at + piece < len(text) else b""
        yield out


def count_terms(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", entries: int = 200_000) -> DataFrame:
    """``(lang, source, term, n, df)``: partial counts, several rows a term."""
    plain = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("")), F.coalesce(F.col(source).cast("string"), F.lit("")),
        F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary"),
    )

    def run(batches):
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def emitted():
            for (in_lang, of_source), (n, df) in held.items():
                rows = len(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([in_lang] * rows, pa.string()), pa.array([of_source] * rows, pa.string()), pa.array(list(n), pa.binary()).cast(pa.string()),
                     pa.array(list(n.values()), pa.int64()), pa.array([df[t] for t in n], pa.int64())],
                    names=["lang", "source", "term", "n", "df"],
                )

        size = 0
        for batch in sliced(batches, 2, 4 << 20):
            for in_lang, of_source, body in zip(*(c.to_pylist() for c in batch.columns)):
                own: Counter = Counter()
                for found in words(body):
                    own.update(found)
                n, df = held.setdefault((in_lang, of_source), (Counter(), Counter()))
                size -= len(df)
                for term, k in own.items():
                    n[term] += k
                df.update(own.keys())
                size += len(df)
                if size >= entries:
                    yield from emitted()
                    held, size = {}, 0
        yield from emitted()

    return plain.toDF("lang", "source", "text").mapInArrow(run, "lang string, source string, term string, n long, df long")


def kept_terms(counts: DataFrame, min_docs: int = 30) -> DataFrame:
    """``(lang, source, term, n, lang_n, leads)`` of the terms in at least
    ``min_docs`` documents of the language; ``leads`` marks one row a term."""
    term = Window.partitionBy("lang", "term")
    # the counts come added up from the tasks; one exchange serves the sums by source and by language
    summed = counts.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    seen = summed.select(
        "lang", "source", "term", "n", F.sum("n").over(term).alias("lang_n"), F.sum("df").over(term).alias("docs"),
        (F.min("source").over(term) == F.col("source")).alias("leads"),
    )
    return seen.where(F.col("docs") >= min_docs).drop("docs")


def share(count: Column, n: Column, v: Column, scale: int) -> Column:
    """Smoothed share as an integer; 1 where no term is kept."""
    exact = lambda c: c.cast("decimal(20,0)")
    top = exact(count + SMOOTHING) * F.lit(scale).cast("decimal(10,0)")
    below = exact(n + v * SMOOTHING)
    return F.when(v > 0, F.lit(1) + F.call_function("div", top, below)).otherwise(F.lit(1)).cast("long")


def _distances(key: tuple, table: pa.Table) -> pa.Table:
    """Differences of the sources of two tiles over one bucket of terms;
    ``apart`` is that of a term which neither source has, ``seen`` the number
    of terms added up."""
    low, high = key[1].as_py(), key[2].as_py()
    term = table["term"].combine_chunks()
    mark = term.is_null().to_numpy(zero_copy_only=False)
    place, p = table["place"].to_numpy(), table["p"].to_numpy()
    order = np.argsort(place[mark], kind="stable")
    at, base = place[mark][order], p[mark][order]
    names = np.array(table["source"].filter(pa.array(mark)).to_pylist(), object)[order]
    tiles = table["tile"].to_numpy()[mark][order]
    coded = term.filter(pa.array(~mark)).dictionary_encode()
    shares = np.repeat(base[:, None], len(coded.dictionary), axis=1)
    shares[np.searchsorted(at, place[~mark]), coded.indices.to_numpy(zero_copy_only=False)] = p[~mark]
    out: list = [[], [], [], []]
    for i in np.flatnonzero(tiles == low):
        others = np.flatnonzero((tiles == high) & (at > at[i]))
        out[0] += [names[i]] * len(others)
        out[1] += names[others].tolist()
        out[2].append(np.abs(shares[others] - shares[i]).sum(axis=1))
        out[3].append(np.abs(base[others] - base[i]))
    value, apart = (np.concatenate(x).astype(np.int64) if x else np.empty(0, np.int64) for x in out[2:])
    n = len(value)
    return pa.table({
        "lang": pa.array([key[0].as_py()] * n, pa.string()), "a": pa.array(out[0], pa.string()), "b": pa.array(out[1], pa.string()),
        "value": value, "apart": apart, "seen": np.full(n, len(coded.dictionary), np.int64),
    })


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = 30, top: int = 50, scale: int = 1_000_000_000,
          tile: int = 64, bucket_terms: int = 4096) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: distance of every source
    to each other of its language (part ``pair``), and the terms that it uses
    most beyond the language's share (part ``term``, first ``top``)."""
    kept = staged(kept_terms(count_terms(docs, lang, source, text), min_docs), "audit-terms")
    by_lang = kept.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.sum(F.col("leads").cast("long")).alias("v"))
    by_source = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    every = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source")))).distinct()
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    numbered = every.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
    groups = numbered.join(by_source, ["lang", "source"], "left").join(by_lang, "lang", "left")
    groups = staged(groups.select("lang", "source", "place", zero("total"), zero("lang_total"), zero("v"), F.max("place").over(Window.partitionBy("lang")).alias("last")), "audit-groups")

    shares = kept.join(groups, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("total"), F.col("v"), scale))
    q = share(F.col("lang_n"), F.col("lang_total"), F.col("v"), scale)
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    over = shares.withColumn("value", F.col("p") - q).where("value > 0").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    terms = over.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)

    buckets = F.floor(F.col("v") / bucket_terms).cast("long") + 1
    unseen = groups.select("lang", "source", "place", "last", F.lit(None).cast("string").alias("term"), share(F.lit(0), F.col("total"), F.col("v"), scale).alias("p"),
                           F.explode(F.sequence(F.lit(0).cast("long"), buckets - 1)).alias("bucket"))
    used = shares.select("lang", "source", "place", "last", "term", "p", F.pmod(F.xxhash64("term"), buckets).alias("bucket"))
    own = F.floor(F.col("place") / tile).cast("int")
    met = used.unionByName(unseen).withColumn("tile", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.floor(F.col("last") / tile).cast("int"))))
    met = met.select("lang", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"), "bucket", "tile", "place", "source", "term", "p")
    parts = met.groupBy("lang", "low", "high", "bucket").applyInArrow(_distances, "lang string, a string, b string, value long, apart long, seen long")
    summed = parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.max("apart").alias("apart"), F.sum("seen").alias("seen"))
    far = summed.join(by_lang.select("lang", "v"), "lang", "left")
    far = far.withColumn("value", F.when(F.col("v") > 0, F.col("value") + (F.col("v") - F.col("seen")) * F.col("apart")).otherwise(F.lit(0)))
    both = far.select("lang", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("x"), "value")
    pairs = both.select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value").withColumn("rank", F.row_number().over(best))
    return pairs.unionByName(terms).select("lang", "source", "part", "item", F.col("value").cast("long").alias("value"), F.col("rank").cast("int").alias("rank"))
