"""Training-log tables: dict extraction, routing to train / eval rows,
best evaluation, rank comparison, early-stop point."""

from __future__ import annotations

import ast

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trainprep.functions.text import py_float
from trainprep.operators.columns import computed_once
from trainprep.operators.ordinal import range_sorted
from trainprep.operators.scan import stop_points

# Output column order of the two log tables.
TRAIN_COLUMNS = ["loss", "grad_norm", "learning_rate", "epoch"]
EVAL_COLUMNS = ["loss", "epoch"]

DICT_PATTERN = r"\{[^}]*\}"

# Python literals and their JSON spelling.
PY_LITERALS = (("None", "null"), ("True", "true"), ("False", "false"))


def first_dict(line: str | Column) -> Column:
    """Shortest ``{...}`` on the line, null when there is none (L1)."""
    c = F.col(line) if isinstance(line, str) else line
    return F.nullif(F.regexp_extract(c, DICT_PATTERN, 0), F.lit(""))


def parse_dict(text: str | Column) -> Column:
    """Python-dict literal -> ``map<string,string>``; unparsable -> null (L2).

    Single quotes are accepted; values keep their literal text.  Bare
    Python ``None`` / ``True`` / ``False`` in value position become JSON
    ``null`` / ``true`` / ``false`` first.
    """
    c = F.col(text) if isinstance(text, str) else text
    rewritten = c
    for py, js in PY_LITERALS:
        rewritten = F.regexp_replace(rewritten, rf"(?<=[:,\[\{{]\s{{0,8}}){py}(?=\s*[,\}}\]])", js)
    c = F.when(c.rlike("None|True|False"), rewritten).otherwise(c)
    return F.from_json(c, "map<string,string>", {"allowSingleQuotes": "true", "mode": "PERMISSIVE"})


def _literal_items(text: str | None) -> dict | None:
    """String-keyed entries of a Python dict literal as text that Python's
    ``float`` reads where it reads the value; anything else is None."""
    try:
        d = ast.literal_eval(text)
    except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
        return None
    if not isinstance(d, dict):
        return None
    return {
        k: v if v is None or isinstance(v, str) else str(int(v)) if isinstance(v, bool) else repr(v)
        for k, v in d.items()
        if isinstance(k, str)
    }


def parse_literal(text: str | Column) -> Column:
    """L2 by Python's own rules (trailing commas, ``.5``, ``1_0``, tuples,
    other keys; ``true`` is no literal), in an Arrow-batched helper."""

    @F.pandas_udf("map<string,string>")
    def parse(texts: pd.Series) -> pd.Series:
        return texts.map(_literal_items, na_action="ignore")

    return parse.asNondeterministic()(F.col(text) if isinstance(text, str) else text)


# Dict literals that JSON reads alike: plain strings, and numbers as both write them.
_PLAIN_STRING = r"'[^'\\\p{Cntrl}]*'|\"[^\"\\\p{Cntrl}]*\""
_PLAIN_VALUE = rf"(?:{_PLAIN_STRING}|-?(?:0|[1-9][0-9]{{0,15}})(?:\.[0-9]+)?(?:[eE][+-]?[0-9]{{1,2}})?)"
PLAIN_DICT = rf"^\{{ *(?:(?:{_PLAIN_STRING}) *: *{_PLAIN_VALUE} *(?:, *(?:{_PLAIN_STRING}) *: *{_PLAIN_VALUE} *)*)?\}}$"


def dict_get(d: Column, key: str) -> Column:
    """Value of ``key`` in a parsed dict, the last one when the key repeats
    (as a Python dict keeps it; a parsed map keeps every entry and ``d[key]``
    would return the first)."""
    hits = F.filter(F.map_entries(d), lambda e: e["key"] == F.lit(key))
    return F.try_element_at(hits, F.lit(-1))["value"]


def log_dicts(lines: DataFrame, line: str = "value", exact: bool = True) -> DataFrame:
    """Lines -> parsed dicts (column ``d``), unmatched or unparsable lines
    dropped, by the rules of Python's literals.

    Dicts of plain strings and numbers, nearly all of a log, are parsed by
    Spark, which reads them as Python does; only the others go through the
    helper (a null costs it nothing).  ``exact=False`` reads all of them by
    JSON's rules instead, without Python workers.
    """
    keep = [c for c in lines.columns if c != line]
    matched = computed_once(lines, keep, _m=first_dict(line))
    if not exact:
        parsed = computed_once(matched, keep, d=parse_dict("_m"))
        return parsed.where(F.col("d").isNotNull())
    routed = computed_once(matched.where(F.col("_m").isNotNull()), [*keep, "_m"], _plain=F.col("_m").rlike(PLAIN_DICT))
    other = routed.withColumn("_other", parse_literal(F.when(~F.col("_plain"), F.col("_m"))))
    parsed = computed_once(other, keep, d=F.when(F.col("_plain"), parse_dict("_m")).otherwise(F.col("_other")))
    return parsed.where(F.col("d").isNotNull())


def eval_rows(dicts: DataFrame, keep=()) -> DataFrame:
    """Dicts with ``eval_loss`` -> ``(loss, epoch)``; a value that is missing
    or not a float drops the row (L3)."""
    d = F.col("d")
    rows = computed_once(
        dicts.where(F.map_contains_key(d, "eval_loss")), keep,
        loss=py_float(dict_get(d, "eval_loss")), epoch=py_float(dict_get(d, "epoch")),
    )
    return rows.where(F.col("loss").isNotNull() & F.col("epoch").isNotNull())


def train_rows(dicts: DataFrame, keep=()) -> DataFrame:
    """Dicts with ``loss`` and without ``eval_loss`` -> the four train
    columns, all required (L4)."""
    d = F.col("d")
    has = F.map_contains_key(d, "loss") & ~F.map_contains_key(d, "eval_loss")
    rows = computed_once(dicts.where(has), keep, **{c: py_float(dict_get(d, c)) for c in TRAIN_COLUMNS})
    cond = F.lit(True)
    for c in TRAIN_COLUMNS:
        cond = cond & F.col(c).isNotNull()
    return rows.where(cond)


def best_eval(evals: DataFrame, run: str = "rank") -> DataFrame:
    """Lowest evaluation loss per run, earliest epoch on ties."""
    best = F.min(F.struct("loss", "epoch")).alias("b")
    return evals.groupBy(run).agg(best, F.count(F.lit(1)).alias("n_evals")).select(
        run, F.col("b.loss").alias("best_loss"), F.col("b.epoch").alias("best_epoch"), "n_evals"
    )


def compare_runs(dicts: DataFrame, run: str = "rank") -> DataFrame:
    """Runs side by side (A7), from the parsed dicts of :func:`log_dicts` in
    one pass: best eval loss and epoch, eval / train row counts, last train
    loss, and the place of each run by best loss.  Of train rows of one
    epoch the last is the one of the greatest ``line`` where the dicts carry
    it, else of the greatest loss.

    Equal losses share a place (NaN behind infinity, runs without an
    evaluation last, as SQL's ``rank`` with nulls last).
    """
    d = F.col("d")
    wanted = dict.fromkeys(["eval_loss", *TRAIN_COLUMNS])
    late = "line" if "line" in dicts.columns else "loss"
    rows = computed_once(dicts, list(dict.fromkeys([run, *(["line"] if late == "line" else [])])), _eval=F.map_contains_key(d, "eval_loss"), **{c: py_float(dict_get(d, c)) for c in wanted})
    evaluated = F.col("_eval") & F.col("eval_loss").isNotNull() & F.col("epoch").isNotNull()
    trained = ~F.col("_eval")
    for c in TRAIN_COLUMNS:
        trained = trained & F.col(c).isNotNull()
    per_run = rows.where(evaluated | trained).groupBy(run).agg(
        F.min(F.when(evaluated, F.struct("eval_loss", "epoch"))).alias("_best"),
        F.nullif(F.count_if(evaluated), F.lit(0)).alias("n_evals"),
        F.nullif(F.count_if(trained), F.lit(0)).alias("n_train"),
        F.max_by(F.when(trained, F.col("loss")), F.when(trained, F.struct("epoch", late))).alias("last_train_loss"),
    )
    runs = per_run.select(
        run, F.col("_best.eval_loss").alias("best_loss"), F.col("_best.epoch").alias("best_epoch"),
        "n_evals", "n_train", "last_train_loss",
    )
    # one row per run, so the window that ranks them is small
    place = F.rank().over(Window.orderBy(F.col("best_loss").asc_nulls_last())).cast("long").alias("place")
    return runs.select("*", place)


def early_stop(
    evals: DataFrame,
    run: str = "rank",
    order: str = "epoch",
    patience: int = 3,
    threshold: float = 1e-3,
    num_partitions: int | None = None,
) -> DataFrame:
    """First evaluation at which ``patience`` evaluations in a row failed to
    beat the best so far by more than ``threshold`` (W6), per run.

    An evaluation improves when no earlier one exists or
    ``best_before - loss > threshold``; the stop is the first row with
    ``idx - last_improved_idx >= patience``.  Runs that never stop get a
    null ``stop_epoch``.  A NaN or null loss improves nothing, and nothing
    improves on one that came first.  The scans are those of
    :mod:`trainprep.operators.scan`: a run may span many partitions.
    """
    if patience < 1:
        raise ValueError("patience must be >= 1")
    ranged = range_sorted(evals.select(run, order, "loss"), [run, order], num_partitions)
    found = stop_points(ranged, run, order, "loss", patience, float(threshold))
    return found.select(
        run,
        F.col("stop_order").alias("stop_epoch"),
        F.coalesce(F.col("stop"), F.col("n")).cast("long").alias("evals_seen"),
        F.col("n").alias("n_evals"),
    )
