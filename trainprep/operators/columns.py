"""Small DataFrame helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, keep, **exprs: Column) -> DataFrame:
    """``keep`` columns plus ``exprs``, each evaluated once per row.

    A plain projection followed by filters lets the optimizer push the
    filters below it and copy the expressions into them (a parse would run
    once per condition); columns produced by a generator stay computed once.
    """
    return df.select(*keep, F.inline(F.array(F.struct(*[e.alias(n) for n, e in exprs.items()]))))
