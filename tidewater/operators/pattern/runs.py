"""Greedy loops of consecutive events as runs (gaps and islands).

A run folds any number of events into one row by a partial aggregate, so a
sequence of runs can be searched like a sequence of events.
"""

from __future__ import annotations

from collections.abc import Sequence as Seq
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators import sequence as S


def runs(
    df: DataFrame, by: Seq[str], ts: str, tie: Seq[str], label: Column, aggs: Seq[Column] = (),
    width: timedelta | None = None,
) -> DataFrame:
    """One row per maximal run of equal ``label``: ``run_id`` (1, 2, ... per
    key), ``label``, ``n``, ``first_ts``, ``last_ts`` and ``aggs``."""
    seq = S.sequence(df, by, ts, tie, width)
    d = S.islands(df.withColumn("label", label), seq, F.col("label"))
    # The chunk stays in the first grouping, which needs no shuffle of its own.
    return d.groupBy(*by, "run_id", "label").agg(
        F.count(F.lit(1)).alias("n"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), *aggs)
