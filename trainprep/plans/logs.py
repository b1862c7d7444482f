"""Training-log queries over run logs written from ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from trainprep.functions.text import py_float
from trainprep.operators.logs import (
    best_eval,
    compare_runs,
    dict_get,
    early_stop,
    eval_rows,
    first_dict,
    log_dicts,
    parse_dict,
    train_rows,
)
from trainprep.plans.fixtures import RANK_SQL, write_noisy_log, write_run_logs
from trainprep.plans.registry import query
from trainprep.plans.tables import table
from trainprep.sources.files import log_lines, run_log_lines

PATIENCE = 3
THRESHOLD = 1e-3


def _lines(spark, sf_dir):
    return run_log_lines(spark, write_run_logs(spark, sf_dir))


def _evals(spark, sf_dir, keep=("rank",)):
    return eval_rows(log_dicts(_lines(spark, sf_dir).select(*keep, "value")), keep=list(keep))


def _trains(spark, sf_dir, keep=("rank",)):
    return train_rows(log_dicts(_lines(spark, sf_dir).select(*keep, "value")), keep=list(keep))


# Place of each event's line in its run's log.
LINE_SQL = f"SELECT event_id, CAST(row_number() OVER (PARTITION BY {RANK_SQL} ORDER BY event_id) - 1 AS BIGINT) AS line FROM events"
EVAL_SQL = f"SELECT {RANK_SQL} AS rank, value AS loss, event_id / 1000 AS epoch FROM events WHERE event_type = 'view'"
TRAIN_SQL = f"""
SELECT {RANK_SQL} AS rank, value AS loss, value / 7 AS grad_norm, 1e-05 * user_id AS learning_rate,
       event_id / 1000 AS epoch
FROM events WHERE event_type = 'click'
"""


@query(
    "rank_log_scan",
    f"""
SELECT {RANK_SQL} AS rank, count(*) AS n_lines, count(*) FILTER (WHERE event_type <> 'purchase') AS n_dict_lines
FROM events GROUP BY 1
""",
)
def rank_log_scan(spark, sf_dir):
    lines = _lines(spark, sf_dir)
    return lines.groupBy("rank").agg(
        F.count(F.lit(1)).alias("n_lines"), F.count(first_dict("value")).alias("n_dict_lines")
    )


@query(
    "log_lines",
    """
SELECT CAST(row_number() OVER (ORDER BY event_id) - 1 AS BIGINT) AS line,
       event_id || ' ' || CASE event_id % 3 WHEN 0 THEN chr(65533) || 'A' || chr(65533) WHEN 1 THEN 'é' ELSE '' END || '|' AS value
FROM events
""",
)
def log_lines_query(spark, sf_dir):
    """Lines of several files with their number, bytes that are no UTF-8 replaced."""
    return log_lines(spark, write_noisy_log(spark, sf_dir))


@query(
    "log_line_kinds",
    f"""
SELECT {RANK_SQL} AS rank,
       CASE WHEN event_type = 'purchase' THEN 'text' WHEN event_type = 'error' THEN 'broken' ELSE 'dict' END AS kind,
       count(*) AS n
FROM events GROUP BY 1, 2
""",
)
def log_line_kinds(spark, sf_dir):
    m = first_dict("value")
    kind = F.when(m.isNull(), "text").when(parse_dict(m).isNull(), "broken").otherwise("dict")
    return _lines(spark, sf_dir).groupBy("rank", kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "log_dict",
    f"""
WITH e AS (
  SELECT {RANK_SQL} AS rank, line, unnest(CASE event_type
    WHEN 'click' THEN [{{'key': 'loss', 'value': value}}, {{'key': 'grad_norm', 'value': value / 7}},
                       {{'key': 'learning_rate', 'value': 1e-05 * user_id}}, {{'key': 'epoch', 'value': event_id / 1000}}]
    WHEN 'view' THEN [{{'key': 'eval_loss', 'value': value}}, {{'key': 'eval_runtime', 'value': 1.5}}, {{'key': 'epoch', 'value': event_id / 1000}}]
    WHEN 'signup' THEN [{{'key': 'train_runtime', 'value': value}}, {{'key': 'train_steps_per_second', 'value': 1.5}}, {{'key': 'epoch', 'value': event_id / 1000}}]
    END) AS kv
  FROM events JOIN ({LINE_SQL}) l USING (event_id))
SELECT rank, line, kv.key AS key, CAST(kv.value AS DOUBLE) AS value FROM e
""",
)
def log_dict(spark, sf_dir):
    """Every entry of every dict, by run and line."""
    dicts = log_dicts(_lines(spark, sf_dir))
    return dicts.select("rank", "line", F.explode("d").alias("key", "text")).select("rank", "line", "key", F.col("text").cast("double").alias("value"))


# Python literals that JSON does not have, and lines that are no literals; %s is the event's id.
_LITERALS = (
    ("{'loss': 1.0, 'epoch': %s, }", "loss", 1.0), ("{'loss': .5, 'step': %s}", "loss", 0.5), ("{'loss': 1_0, 'step': %s}", "loss", 10.0),
    ("{'loss': 2.5, 'at': (%s, 2)}", "loss", 2.5), ("{'loss': True, 'step': %s}", "loss", 1.0), ('{"loss": "7", "step": %s}', "loss", 7.0),
    ("{'loss': true, 'step': %s}", None, None), ("{'loss': 01, 'step': %s}", None, None), ("{'loss': null, 'step': %s}", None, None),
)


@query(
    "log_dict_literals",
    "WITH k(kind, loss) AS (VALUES " + ", ".join(f"({k}, {v if v is not None else 'NULL'}::DOUBLE)" for k, (_, _, v) in enumerate(_LITERALS)) + """)
SELECT event_id AS line, k.loss FROM events JOIN k ON kind = event_id % 9 WHERE k.loss IS NOT NULL
""",
)
def log_dict_literals(spark, sf_dir):
    """Dicts in every form of a Python literal, written from the events."""
    events = table(spark, sf_dir, "events").select("event_id")
    forms = F.array(*[F.lit(form) for form, _, _ in _LITERALS])
    kind = (F.col("event_id") % len(_LITERALS) + 1).cast("int")
    lines = events.select(F.col("event_id").alias("line"), F.replace(F.element_at(forms, kind), F.lit("%s"), F.col("event_id").cast("string")).alias("value"))
    return log_dicts(lines).select("line", py_float(dict_get(F.col("d"), "loss")).alias("loss"))


@query("log_train", f"SELECT t.*, l.line FROM ({TRAIN_SQL.replace('SELECT', 'SELECT event_id,', 1)}) t JOIN ({LINE_SQL}) l USING (event_id)".replace("t.*", "t.rank, t.loss, t.grad_norm, t.learning_rate, t.epoch"))
def log_train(spark, sf_dir):
    return _trains(spark, sf_dir, ("rank", "line"))


@query("log_eval", f"SELECT t.rank, t.loss, t.epoch, l.line FROM ({EVAL_SQL.replace('SELECT', 'SELECT event_id,', 1)}) t JOIN ({LINE_SQL}) l USING (event_id)")
def log_eval(spark, sf_dir):
    return _evals(spark, sf_dir, ("rank", "line"))


BEST_SQL = f"""
SELECT rank, best_loss, min(epoch) AS best_epoch, n_evals
FROM (SELECT rank, loss, epoch, min(loss) OVER (PARTITION BY rank) AS best_loss,
             count(*) OVER (PARTITION BY rank) AS n_evals FROM ({EVAL_SQL}) e) x
WHERE loss = best_loss GROUP BY rank, best_loss, n_evals
"""


@query("best_eval", BEST_SQL)
def best_eval_query(spark, sf_dir):
    return best_eval(_evals(spark, sf_dir))


@query(
    "rank_compare",
    f"""
WITH b AS ({BEST_SQL}),
t AS (SELECT rank, count(*) AS n_train, arg_max(loss, (epoch, event_id)) AS last_train_loss FROM ({TRAIN_SQL.replace('SELECT', 'SELECT event_id,', 1)}) x GROUP BY rank)
SELECT coalesce(b.rank, t.rank) AS rank, b.best_loss, b.best_epoch, b.n_evals, t.n_train, t.last_train_loss,
       CAST(rank() OVER (ORDER BY b.best_loss ASC NULLS LAST) AS BIGINT) AS place
FROM b FULL JOIN t ON b.rank = t.rank
""",
)
def rank_compare(spark, sf_dir):
    return compare_runs(log_dicts(_lines(spark, sf_dir)))


@query(
    "early_stop",
    f"""
WITH e AS ({EVAL_SQL}),
a AS (SELECT rank, epoch, loss,
             min(loss) OVER (PARTITION BY rank ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best_before,
             row_number() OVER (PARTITION BY rank ORDER BY epoch) AS idx
      FROM e),
b AS (SELECT *, max(CASE WHEN best_before IS NULL OR best_before - loss > {THRESHOLD} THEN idx END)
                OVER (PARTITION BY rank ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_improved
      FROM a),
s AS (SELECT rank, min(idx) AS stop_idx FROM b WHERE idx - last_improved >= {PATIENCE} GROUP BY rank),
n AS (SELECT rank, count(*) AS n_evals FROM e GROUP BY rank)
SELECT n.rank, b.epoch AS stop_epoch, CAST(coalesce(s.stop_idx, n.n_evals) AS BIGINT) AS evals_seen, n.n_evals
FROM n LEFT JOIN s ON n.rank = s.rank LEFT JOIN b ON b.rank = s.rank AND b.idx = s.stop_idx
""",
)
def early_stop_query(spark, sf_dir):
    return early_stop(_evals(spark, sf_dir), "rank", "epoch", PATIENCE, THRESHOLD)


@query("log_table_sink", TRAIN_SQL)
def log_table_sink(spark, sf_dir):
    """Train table written as CSV with its fixed header (K6), read back."""
    from trainprep.operators.logs import TRAIN_COLUMNS
    from trainprep.session import scratch_dir
    from trainprep.sinks.files import write_log_table

    out = scratch_dir(spark, "train_table")
    write_log_table(_trains(spark, sf_dir), out, ["rank", *TRAIN_COLUMNS])
    schema = "rank long, loss double, grad_norm double, learning_rate double, epoch double"
    return spark.read.schema(schema).option("header", "true").csv(out)


@query("log_eval_sink", EVAL_SQL)
def log_eval_sink(spark, sf_dir):
    """Evaluation table written as parquet with its fixed columns (K6), read back."""
    from trainprep.operators.logs import EVAL_COLUMNS
    from trainprep.session import scratch_dir
    from trainprep.sinks.files import write_log_table

    out = scratch_dir(spark, "eval_table")
    write_log_table(_evals(spark, sf_dir), out, ["rank", *EVAL_COLUMNS], fmt="parquet")
    return spark.read.parquet(out)
