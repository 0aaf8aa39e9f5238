"""Joins of two streams of JSON texts on keys inside the texts."""

from __future__ import annotations

from collections.abc import Sequence as Seq
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass
class JsonSide:
    """A stream of texts: the column that holds them, their schema, the field of the event time, and its unit."""

    stream: DataFrame
    text: str
    schema: T.StructType
    time: str
    unit: str = "micros"
    delay: str = "1 hour"

    def rows(self, name: str) -> DataFrame:
        """The parsed rows as the struct ``name`` beside their time; texts that do not parse or have no time are left out."""
        instant = {"micros": F.timestamp_micros, "millis": F.timestamp_millis, "seconds": F.timestamp_seconds}[self.unit]
        # FAILFAST would end the stream, PERMISSIVE gives rows of NULLs, which have no time.
        parsed = self.stream.select(F.from_json(F.col(self.text), self.schema).alias(name))
        at = f"{name}_time"
        return parsed.withColumn(at, instant(F.col(name)[self.time])).where(F.col(at).isNotNull()).withWatermark(at, self.delay)


def json_join(left: JsonSide, right: JsonSide, on: Seq[tuple[str, str]], before: str, after: str, how: str = "inner") -> DataFrame:
    """``left`` and ``right`` (structs of the parsed fields, NULL where an outer join found no partner).

    Rows meet whose key fields are equal and whose right time lies at most ``before`` ahead of and
    ``after`` behind the left time. Both watermarks together with these bounds say when a row
    can have no more partner: then it leaves the state, and an outer join emits it alone.
    A NULL key has no partner.
    """
    if how not in ("inner", "left_outer", "right_outer", "full_outer"):
        raise ValueError(f"unknown join {how}")
    a, b = left.rows("left"), right.rows("right")
    equal: Column = F.lit(True)
    for x, y in on:
        equal = equal & (F.col("left")[x] == F.col("right")[y])
    near = F.expr(f"right_time >= left_time - INTERVAL {before} AND right_time <= left_time + INTERVAL {after}")
    width = _micros(a.sparkSession, before) + _micros(a.sparkSession, after)
    if width <= 0 or how == "full_outer":
        return a.join(b, equal & near, how).select("left", "right")
    # A row is compared with the state of its key only in the one or two stretches of time it can reach, not with the whole
    # state of the key. The side that an outer join may emit alone stays single, the other comes once per stretch.
    stretch = lambda t: F.floor(F.unix_micros(t) / F.lit(width)).cast("long")
    if how == "right_outer":
        b = b.withColumn("right_stretch", stretch(F.col("right_time")))
        lo, hi = (stretch(F.expr(f"left_time {x}")) for x in (f"- INTERVAL {before}", f"+ INTERVAL {after}"))
        a = a.withColumn("left_stretch", F.explode(F.sequence(lo, hi)))
    else:
        a = a.withColumn("left_stretch", stretch(F.col("left_time")))
        lo, hi = (stretch(F.expr(f"right_time {x}")) for x in (f"- INTERVAL {after}", f"+ INTERVAL {before}"))
        b = b.withColumn("right_stretch", F.explode(F.sequence(lo, hi)))
    return a.join(b, equal & (F.col("left_stretch") == F.col("right_stretch")) & near, how).select("left", "right")


def _micros(spark: SparkSession, interval: str) -> int:
    return spark.range(1).select(F.unix_micros(F.expr(f"timestamp_micros(0) + INTERVAL {interval}"))).first()[0]
