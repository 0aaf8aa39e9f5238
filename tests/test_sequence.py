"""Chunked sequence operators against plain window functions."""

from datetime import timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.operators import ranking as R
from tidewater.operators import sequence as S
from tidewater.session import load_events

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def ev(spark):
    # One hot key holds most rows; some keys are NULL.
    d = load_events(spark, SF)
    return d.withColumn("u", F.when(F.col("user_id") % 3 == 0, None).otherwise(F.least("user_id", F.lit(4)))).cache()


SEQ = S.Sequence(("u",), "ts", ("event_id",), timedelta(hours=5))


def W():
    return Window.partitionBy("u").orderBy("ts", "event_id")


ALL = Window.unboundedPreceding, Window.unboundedFollowing


def same(a, b, *cols):
    a, b = a.select("event_id", *cols), b.select("event_id", *cols)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0 and a.count() == b.count()


def click():
    return F.when(F.col("event_type") == "click", F.col("event_id"))


@pytest.mark.parametrize("forward", [False, True])
@pytest.mark.parametrize("inclusive", [False, True])
def test_carry(ev, forward, inclusive):
    at = 0 if inclusive else 1
    want = F.first(click(), True).over(W().rowsBetween(at, ALL[1])) if forward else F.last(click(), True).over(W().rowsBetween(ALL[0], -at))
    same(S.carry(ev, SEQ, {"x": click()}, forward, inclusive), ev.withColumn("x", want), "x")


def test_running_and_positions(ev):
    got = S.running(S.positions(ev, SEQ), SEQ, {"m": ("max", F.col("value")), "lo": ("min", F.col("value")), "n": ("count", click()), "s": ("sum", click())})
    want = ev.select("*", F.row_number().over(W()).alias("pos"), F.max("value").over(W()).alias("m"), F.min("value").over(W()).alias("lo"),
                     F.count(click()).over(W()).alias("n"), F.sum(click()).over(W()).alias("s"))
    same(got, want, "pos", "m", "lo", "n", "s")


@pytest.mark.parametrize("k", [1, 4, -1, -3])
def test_shift(ev, k):
    want = F.lag("event_id", k).over(W()) if k > 0 else F.lead("event_id", -k).over(W())
    same(S.shift(ev, SEQ, {"x": F.col("event_id")}, k), ev.withColumn("x", want), "x")


def test_halos(ev):
    w = S.halo_window().rowsBetween(-3, 2)
    got = S.row_halo(ev, SEQ, 3, 2, rows=7).withColumn("x", F.sum("event_id").over(w)).where("__own")
    same(got, ev.withColumn("x", F.sum("event_id").over(W().rowsBetween(-3, 2))), "x")
    us = F.unix_micros("ts")
    reach = timedelta(hours=9)
    wr = Window.partitionBy(S.KEY, S.CHUNK).orderBy(us).rangeBetween(-S.micros(reach), S.micros(reach))
    got = S.time_halo(ev, SEQ, reach, reach).withColumn("x", F.sum("event_id").over(wr)).where("__own")
    want = F.sum("event_id").over(Window.partitionBy("u").orderBy(us).rangeBetween(-S.micros(reach), S.micros(reach)))
    same(got, ev.withColumn("x", want), "x")


@pytest.mark.parametrize("desc", [False, True])
def test_ranked(ev, desc):
    seq = S.Sequence(("u",), "v", ("event_id",), 7.0, desc=desc)
    d = ev.withColumn("v", F.floor("value"))
    o = F.col("v").desc() if desc else F.col("v").asc()
    w, wt = Window.partitionBy("u").orderBy(o), Window.partitionBy("u").orderBy(o, "event_id")
    want = d.select("*", F.row_number().over(wt).alias("row_number"), F.rank().over(w).alias("rank"), F.dense_rank().over(w).alias("dense_rank"),
                    F.percent_rank().over(w).alias("percent_rank"), F.cume_dist().over(w).alias("cume_dist"), F.ntile(7).over(wt).alias("ntile"))
    same(R.ranked(d, seq, 7), want, "row_number", "rank", "dense_rank", "percent_rank", "cume_dist", "ntile")


def test_islands(ev):
    prev = F.lag("event_type").over(W())
    starts = ev.withColumn("z", F.when(prev.eqNullSafe(F.col("event_type")), 0).otherwise(1))
    same(S.islands(ev, SEQ, F.col("event_type")), starts.withColumn("run_id", F.sum("z").over(W())), "run_id")


def test_rows_are_shuffled_once(ev, spark):
    """The carry adds no exchange of the rows: they stay on (key, chunk)."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        d = load_events(spark, SF).withColumn("u", F.col("user_id"))
        plan = S.carry(d, SEQ, {"x": click()})._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    wide = [line for line in plan.splitlines() if "Exchange hashpartitioning(__key" in line]
    # Rows; partial ends per chunk; ends per key; carried values per chunk.
    assert len(wide) == 4


def test_measured_width_bounds_the_hottest_chunk(spark):
    d = load_events(spark, SF).withColumn("u", F.when(F.col("event_id") % 3 == 0, 0).otherwise(F.col("user_id")))
    wide = S.sequence(d, ("u",), "ts", ("event_id",))
    assert wide.width > timedelta(days=28)
    width = S.fit_width(d, wide, target_rows=20)
    top = S.chunked(d, S.Sequence(("u",), "ts", ("event_id",), width)).groupBy(S.KEY, S.CHUNK).count().agg(F.max("count")).first()[0]
    assert top <= 40
