"""Connected components by alternating large and small stars, on tables only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import cut


def _large(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    # Every larger neighbour points at the least of the neighbourhood.
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    return down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(
        least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """id and label (the least id of its component) of every id in ``edges`` (u, v)."""
    now = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    total = F.struct(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
    before = None
    while True:
        now = cut(_small(_large(now)).distinct(), "edges")
        state = now.agg(total.alias("s")).first()[0]
        if state == before:
            break
        before = state
    return now.select(F.col("u").alias("id"), F.col("v").alias("label")).union(
        now.select(F.col("v").alias("id"), F.col("v").alias("label")).distinct())
