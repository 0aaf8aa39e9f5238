"""Joins Spark has no operator for: as-of, time-bounded and range joins."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators import sequence as S


def asof_join(
    left: DataFrame, right: DataFrame, by: list[str], left_ts: str, right_ts: str, take: list[str],
    width: timedelta | float | None = None, allow_equal: bool = True, keep_unmatched: bool = True,
) -> DataFrame:
    """Each left row with the latest right row of its key at or before its time.

    One union, one shuffle on (key, time chunk), one backward-looking carry; no
    pairs are formed. Among right rows of equal time the greatest one (by the
    ``take`` columns) wins. A NULL key or time matches nothing.
    """
    lcols = left.columns
    packed = F.struct(*[F.col(c) for c in dict.fromkeys([right_ts, *take])])
    rtype = right.select(packed.alias("r")).schema["r"].dataType
    ltype = left.select(F.struct(*lcols).alias("l")).schema["l"].dataType
    side_first = 0 if allow_equal else 1
    a = left.select(
        *by, F.col(left_ts).alias("__t"), F.lit(0 if side_first else 1).alias("__side"),
        F.struct(*lcols).alias("__l"), F.lit(None).cast(rtype).alias("__r"),
    )
    b = right.dropna(subset=[right_ts, *by]).select(
        *by, F.col(right_ts).alias("__t"), F.lit(side_first).alias("__side"),
        F.lit(None).cast(ltype).alias("__l"), packed.alias("__r"),
    )
    both = a.unionByName(b)
    seq = S.sequence(both, by, "__t", ("__side", "__r"), width)
    out = S.carry(both, seq, {"__m": F.col("__r")}, inclusive=True).where(F.col("__l").isNotNull())
    if not keep_unmatched:
        out = out.where(F.col("__m").isNotNull())
    names = [c if c not in lcols else f"right_{c}" for c in take]
    return out.select("__l.*", *[F.col("__m")[c].alias(n) for c, n in zip(take, names)])


def interval_join(
    left: DataFrame, right: DataFrame, left_key: list[str], right_key: list[str], left_ts: str, right_ts: str,
    reach: timedelta, how: str = "inner",
) -> DataFrame:
    """Pairs with ``left_ts <= right_ts < left_ts + reach``.

    Equi join on (key, time bucket): a left row looks into its own bucket and
    the next, a right row sits in one. AQE splits buckets that run hot.
    """
    step = S.micros(reach)
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    b = F.floor(us(left_ts) / F.lit(step))
    a = left.withColumn("__b", F.explode(F.array(b, b + 1)))
    c = right.withColumn("__b2", F.floor(us(right_ts) / F.lit(step)))
    cond = (F.col("__b") == F.col("__b2"))
    for lk, rk in zip(left_key, right_key):
        cond = cond & (F.col(lk) == F.col(rk))
    cond = cond & (us(right_ts) >= us(left_ts)) & (us(right_ts) < us(left_ts) + step)
    if how not in ("inner",):
        raise ValueError("outer interval joins: pad the left side from an anti join of the result")
    return a.join(c, cond, how).drop("__b", "__b2")


def range_join(points: DataFrame, ranges: DataFrame, x: str, lo: str, hi: str, width: float) -> DataFrame:
    """Pairs with ``lo <= x < hi`` through an equi join on buckets of ``width``.

    A range is copied once per bucket it touches; pick a width near the usual
    range length.
    """
    bucket = lambda c: F.floor(F.col(c) / F.lit(width))
    r = ranges.withColumn("__b", F.explode(F.sequence(bucket(lo), bucket(hi))))
    p = points.withColumn("__b", bucket(x))
    return p.join(r, "__b").where((F.col(x) >= F.col(lo)) & (F.col(x) < F.col(hi))).drop("__b")
