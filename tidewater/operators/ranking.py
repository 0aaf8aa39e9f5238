"""Ranking functions and partial-frame control over hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.operators import sequence as S


def ranked(df: DataFrame, seq: S.Sequence, buckets: int | None = None) -> DataFrame:
    """Add row_number, rank, dense_rank, percent_rank, cume_dist (and ntile).

    Equal order values share a chunk, so a row's rank is its rank in the chunk
    plus the rows (or distinct values) of the chunks before it.
    """
    d = S.chunked(df, seq)
    ts = F.col(seq.ts)
    per_chunk = d.groupBy(S.KEY, S.CHUNK, ts).agg(F.count(F.lit(1)).alias("n")) \
        .groupBy(S.KEY, S.CHUNK).agg(F.sum("n").alias("__n"), F.count(F.lit(1)).alias("__d"))
    before = S.over_chunks().rowsBetween(*S.BEFORE)
    whole = Window.partitionBy(S.KEY)
    base = per_chunk.select(
        S.KEY, S.CHUNK,
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__bn"),
        F.coalesce(F.sum("__d").over(before), F.lit(0)).alias("__bd"),
        F.sum("__n").over(whole).alias("__total"),
    )
    by_value = Window.partitionBy(S.KEY, S.CHUNK).orderBy(ts.desc_nulls_last() if seq.desc else ts.asc_nulls_last())
    d = d.select(
        "*",
        F.row_number().over(S.local(seq)).alias("__rn"),
        F.rank().over(by_value).alias("__rk"),
        F.dense_rank().over(by_value).alias("__dr"),
        F.count(F.lit(1)).over(by_value.rangeBetween(Window.unboundedPreceding, 0)).alias("__le"),
    )
    d = S.join_chunks(d, base)
    n, rn = F.col("__total"), F.col("__rn") + F.col("__bn")
    rank = F.col("__rk") + F.col("__bn")
    d = d.select(
        "*", rn.alias("row_number"), rank.alias("rank"),
        (F.col("__dr") + F.col("__bd")).alias("dense_rank"),
        F.when(n > 1, (rank - 1) / (n - 1)).otherwise(F.lit(0.0)).alias("percent_rank"),
        ((F.col("__le") + F.col("__bn")) / n).alias("cume_dist"),
    )
    if buckets:
        d = d.withColumn("ntile", _ntile(rn, n, buckets))
    return S.unchunked(d.drop("__rn", "__rk", "__dr", "__le", "__bn", "__bd", "__total"))


def _ntile(rn: Column, n: Column, buckets: int) -> Column:
    """The first ``n mod buckets`` tiles hold one row more than the others."""
    small = F.floor(n / buckets)
    extra = n % buckets
    cut = extra * (small + 1)
    return F.when(rn <= cut, F.ceil(rn / (small + 1))).otherwise(extra + F.ceil((rn - cut) / small)).cast("int")


def full_frame_only(value: Column, window, size: int) -> Column:
    """``DISALLOW PARTIAL``: NULL until the frame holds ``size`` rows."""
    return F.when(F.count(F.lit(1)).over(window) == size, value)


def top_per_group(df: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    """First k rows per group. Spark keeps k rows per task before the shuffle
    (WindowGroupLimit), so a hot group sends k rows per task, not all of them."""
    rn = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("rn", rn).where(F.col("rn") <= k)
