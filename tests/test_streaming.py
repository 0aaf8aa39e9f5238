"""Streams against the table operators."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tidewater.operators.pattern import PatternError, Skip, begin, match
from tidewater.session import load_events, work_dir
from tidewater.streaming import state as ST
from tidewater.streaming.matcher import BatchMatcher, stream_match
from tidewater.streaming.runner import run_slices, write_all

SF = "/root/testdata/sf0.001"
HOUR = timedelta(hours=1)
c = F.col
P = begin("a").where("event_type = 'click'").followed_by("b").where("event_type = 'purchase'").within(6 * HOUR)
LOOP = begin("a").where("event_type = 'click'").one_or_more().followed_by("b").where("event_type = 'purchase'")


@pytest.fixture(scope="module")
def ev(spark):
    return load_events(spark, SF).select("event_id", "user_id", "event_type", "ts").cache()


def by_day(ev, cuts=("2024-01-08", "2024-01-20")):
    lo, hi = cuts
    return [ev.where(c("ts") < lo), ev.where((c("ts") >= lo) & (c("ts") < hi)), ev.where(c("ts") >= hi)]


def flat(m, timeouts=False):
    ids = lambda s: F.array_join(F.transform(s, lambda x: x.event_id), ",").alias(f"{s}_ids")
    return m.select("user_id", *(["kind", "timeout_ts"] if timeouts else []), "end_ts", ids("a"), ids("b"))


@pytest.mark.parametrize("pattern,timeouts", [(P, True), (LOOP, False)], ids=["timeouts", "no_bound"])
def test_state_matcher_equals_table(spark, ev, pattern, timeouts):
    out = work_dir(spark, "out")

    def start(stream, ck):
        m = stream_match(stream.withWatermark("ts", "1 hour"), pattern, ["user_id"], "ts", ["event_id"], ["event_id"], timeouts)
        write_all(flat(m, timeouts), checkpoint=ck, path=out)

    ck = run_slices(spark, by_day(ev), start)
    got = spark.read.parquet(out)
    mark = ev.agg(F.max("ts")).first()[0] - HOUR
    table = pattern if pattern.within_ else pattern.within(timedelta(days=400))
    want = flat(match(ev, table, ["user_id"], "ts", ["event_id"], ["event_id"], timeouts=timeouts, width=timedelta(days=30)), timeouts)
    at = F.coalesce(c("timeout_ts"), c("end_ts")) if timeouts else c("end_ts")
    # The millisecond of the watermark itself is decided by the next batch.
    closed = lambda d: d.where(at < F.lit(mark) - F.expr("INTERVAL 1 SECOND"))
    a, b = closed(got), closed(want)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0 and a.count() > 5
    timers = ST.timeouts(spark, ck)
    assert timers.columns == ["user_id", "fires_at"] and timers.count() > 0


def test_batch_matcher_equals_table(spark, ev):
    sink = BatchMatcher(spark, P, ["user_id"], "ts", ["event_id"], ["event_id"], HOUR)

    def start(stream, ck):
        stream.writeStream.foreachBatch(sink).option("checkpointLocation", ck).trigger(availableNow=True).start().awaitTermination()

    run_slices(spark, by_day(ev), start)
    mark = ev.agg(F.max("ts")).first()[0] - HOUR
    a = flat(sink.matches())
    b = flat(match(ev, P, ["user_id"], "ts", ["event_id"], ["event_id"])).where(c("end_ts") <= F.lit(mark))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0 and a.count() > 5


@pytest.mark.parametrize("skip", [Skip("past_last"), Skip("to_last", "a")], ids=lambda s: s.kind)
def test_skips_across_batches_equal_table(spark, ev, skip):
    p = begin("a", skip).where("event_type = 'click'").times(2).followed_by("b").where("event_type = 'purchase'").within(48 * HOUR)
    flatly = lambda m: m.select("user_id", *[F.transform(s, lambda x: x.event_id).alias(s) for s in "ab"])
    want = flatly(match(ev, p, ["user_id"], "ts", ["event_id"], ["event_id"]).where(c("start_ts") <= F.lit(ev.agg(F.max("ts")).first()[0] - 49 * HOUR))).collect()
    sink = BatchMatcher(spark, p, ["user_id"], "ts", ["event_id"], ["event_id"], HOUR, width=timedelta(days=30))
    for i, part in enumerate(by_day(ev)):
        sink(part, i)
        # A retry of the same batch leaves the same.
        if i == 1:
            sink(part, i)
    assert sorted(flatly(sink.matches()).collect()) == sorted(want) and len(want) > 5


def test_what_stream_matchers_refuse(spark, ev):
    with pytest.raises(PatternError):
        BatchMatcher(spark, LOOP, ["user_id"], "ts", ["event_id"], [], HOUR)
    with pytest.raises(PatternError):
        stream_match(ev, P.after_match(Skip("next")), ["user_id"], "ts")


def test_offsets_and_rewritten_state(spark, ev):
    counts = lambda s: s.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    home = ST.bootstrap(ev.select("user_id"), counts)
    assert ST.source_positions(spark, f"{home}/checkpoint").select("batch").first()[0] == 0
    state = ST.keyed_state(spark, f"{home}/checkpoint").withColumn("one", F.explode(F.array_repeat(F.lit(1), c("count").cast("int"))))
    kept = ST.rewrite(state, c("user_id") < 5, [c("user_id")], counts)
    got = ST.keyed_state(spark, f"{kept}/checkpoint")
    assert {r.user_id for r in got.collect()} == {r.user_id for r in ev.where("user_id < 5").select("user_id").distinct().collect()}


def test_retract_log_is_compacted(spark):
    """Many batches leave few runs, a retry changes nothing, and snapshot and changes are those of the batches."""
    import random

    from tidewater.streaming.changes import RetractSink

    r = random.Random(3)
    sink = RetractSink(spark, ["k"], fanout=2)
    state, want = {}, []
    for b in range(10):
        new = {k: r.randrange(3) for k in r.sample(range(8), 3)}
        df = spark.createDataFrame([(None if k == 7 else k, v) for k, v in new.items()], "k int, n int").coalesce(1)
        sink(df, b)
        if b in (3, 6):
            sink(df, b)
        for k, v in new.items():
            if k != 7 and state.get(k) is None:
                want.append(("+I", k, v))
            elif k != 7 and state[k] != v:
                want += [("-U", k, state[k]), ("+U", k, v)]
            state[k] = v
    got = [(x.op, x.k, x.n) for x in sink.changes().where("k IS NOT NULL").collect()]
    assert sorted(got) == sorted(want)
    assert len(sink.runs(9)) <= 4 and {lv for lv, _ in sink.runs(9)} <= {1, 2, 3}
    assert {(x.k, x.n) for x in sink.snapshot(9, df.schema).where("k IS NOT NULL").collect()} == {(k, v) for k, v in state.items() if k != 7}
