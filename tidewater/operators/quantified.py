"""``x op SOME/ALL (subquery)`` through one-row summaries of the subquery.

The summary (min, max, row count, non-NULL count) is one row whatever the size
of the subquery, so it reaches the outer rows as a scalar subquery and nothing
is joined row by row. Equality with SOME (and inequality with ALL) is IN / NOT
IN and stays a join, which Catalyst plans with the right NULL handling.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORDERED = {"<": ("max", "min"), "<=": ("max", "min"), ">": ("min", "max"), ">=": ("min", "max")}


def summary(values: DataFrame, col: str) -> DataFrame:
    v = F.col(col)
    return values.agg(
        F.min(v).alias("lo"), F.max(v).alias("hi"), F.count(F.lit(1)).alias("n"), F.count(v).alias("known"),
    ).select(F.struct("lo", "hi", "n", "known").alias("s"))


def _compare(x: Column, op: str, y: Column) -> Column:
    return {
        "<": x < y, "<=": x <= y, ">": x > y, ">=": x >= y, "=": x == y, "<>": x != y,
    }[op]


def some(x: Column, op: str, values: DataFrame, col: str) -> Column:
    """TRUE if any comparison is; unknown when only NULLs could decide it."""
    s = summary(values, col).scalar()
    lo, hi, n, known = (s.getField(f) for f in ("lo", "hi", "n", "known"))
    if op in ORDERED:
        hit = _compare(x, op, hi if ORDERED[op][0] == "max" else lo)
    elif op == "<>":
        hit = (x != lo) | (x != hi)
    else:
        raise ValueError("use in_query for = SOME")
    return F.when(n == 0, F.lit(False)).when(hit, F.lit(True)).when(
        x.isNull() | (known < n), F.lit(None).cast("boolean")
    ).otherwise(F.lit(False))


def every(x: Column, op: str, values: DataFrame, col: str) -> Column:
    """FALSE if any comparison is; TRUE on an empty subquery."""
    s = summary(values, col).scalar()
    lo, hi, n, known = (s.getField(f) for f in ("lo", "hi", "n", "known"))
    if op in ORDERED:
        held = _compare(x, op, lo if ORDERED[op][1] == "min" else hi)
    elif op == "=":
        held = (x == lo) & (x == hi)
    else:
        raise ValueError("use not_in_query for <> ALL")
    return F.when(n == 0, F.lit(True)).when(~held, F.lit(False)).when(
        x.isNull() | (known < n), F.lit(None).cast("boolean")
    ).otherwise(F.lit(True))


def in_query(df: DataFrame, x: str, values: DataFrame, col: str) -> DataFrame:
    """Rows with ``x = SOME (values)``: a semi join."""
    v = values.select(F.col(col).alias("__v"))
    return df.join(v, F.col(x) == F.col("__v"), "left_semi")


def not_in_query(df: DataFrame, x: str, values: DataFrame, col: str) -> DataFrame:
    """Rows with ``x <> ALL (values)``, that is NOT IN.

    An empty subquery keeps every row, a NULL in it drops every row, and a NULL
    ``x`` is kept only by the empty one; the rest is an equi anti join, where
    the built-in null-aware form would need a broadcast.
    """
    v = values.select(F.col(col).alias("__v"))
    s = summary(values, col).scalar()
    n, known = s.getField("n"), s.getField("known")
    kept = df.join(v.where(F.col("__v").isNotNull()), F.col(x) == F.col("__v"), "left_anti")
    return kept.where((n == 0) | ((known == n) & F.col(x).isNotNull()))
