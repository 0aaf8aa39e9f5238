"""Rules that change on a stream, and event-time replay in any number of batches."""

import shutil
from datetime import datetime, timedelta

import oracle
import pytest
from pyspark.sql import functions as F

from tidewater.operators.pattern import Skip, begin
from tidewater.operators.pattern.spec import PatternError
from tidewater.plans import streams
from tidewater.session import load_events
from tidewater.streaming.rules import RuleMatcher
from tidewater.streaming.runner import event_time_slices

SF = "/root/testdata/sf0.001"
HOUR = timedelta(hours=1)
START = datetime(2024, 1, 1)
CLICKS = begin("x").where("kind = 'click'").next("y").where("kind = 'click'").within(3 * HOUR)
VIEWS = begin("x").where("kind = 'view'").followed_by("y").where("kind = 'view'").within(3 * HOUR)


def batch(spark, rows):
    """(id, hour, kind, rule) rows of one user."""
    return spark.createDataFrame([(1, i, START + h * HOUR, kind, rule) for i, h, kind, rule in rows], "user long, id long, ts timestamp, kind string, rule string")


def matcher(spark, **more):
    return RuleMatcher(spark, F.col("rule"), ["user"], "ts", ["id"], ["id"], HOUR, width=timedelta(days=1), **more)


def found(sink):
    return sorted((r.epoch, *[e["event"]["id"] for e in r.events]) for r in sink.matches().collect())


@pytest.fixture(scope="module")
def batches(spark):
    return [
        batch(spark, [(1, 0, "click", None), (2, 1, "click", None), (3, 2, "click", None)]),
        # The switch lies between two clicks, so they do not match; a view of the old time is no match for the new rule.
        batch(spark, [(4, 3, None, VIEWS.to_json()), (5, 4, "click", None), (6, 2.5, "view", None), (7, 5, "view", None), (8, 6, "view", None)]),
        # Late: at the mark of the batch before, or earlier.
        batch(spark, [(9, 4.5, "view", None), (10, 5, None, "clicks"), (11, 6.5, "view", None), (12, 7, None, "clicks")]),
        batch(spark, [(13, 8, "click", None), (14, 9, "click", None), (15, 20, "click", None)]),
    ]


def test_rules_switch_between_batches_and_retries_agree(spark, batches):
    sink = matcher(spark, rules={"clicks": CLICKS}, first_rule="clicks")
    for i, b in enumerate(batches):
        sink(b, i)
        before = found(sink)
        # The same batch again, as after a failure.
        sink(b, i)
        assert found(sink) == before
    assert found(sink) == [(0, 1, 2), (0, 2, 3), (1, 7, 8), (1, 8, 11), (2, 13, 14)]
    assert [(r.epoch, r.rule) for r in sink.rules_at().orderBy("epoch").collect()] == [(1, VIEWS.to_json()), (2, "clicks")]
    assert sink.rules_at(1).count() == 1 and sink.rules_at(0).count() == 0


def test_rules_do_not_depend_on_the_batches(spark, batches):
    ordered = batches[0].unionAll(batches[1]).unionAll(batches[3]).orderBy("ts", "id").collect()
    want = None
    for size in (5, len(ordered)):
        sink = matcher(spark, rules={"clicks": CLICKS}, first_rule="clicks")
        for i in range(0, len(ordered), size):
            sink(spark.createDataFrame(ordered[i:i + size], batches[0].schema), i // size)
        want = want or found(sink)
        assert found(sink) == want and len(want) >= 3


def test_no_rule_and_no_rows(spark, batches):
    sink = matcher(spark)
    sink(batches[0].where("false"), 0)
    sink(batches[0], 1)
    sink(batches[0].where("false"), 2)
    assert not (sink.spark.read.parquet(f"{sink.path}/waiting/batch=2").count() > 3) and sink.rules_at().count() == 0
    with pytest.raises(PatternError):
        matcher(spark, rules={"x": begin("x").where("true").next("y").where("true")})
    with pytest.raises(PatternError):
        matcher(spark, rules={"x": begin("x", Skip("past_last")).where("true").next("y").where("true").within(HOUR)})


@pytest.mark.parametrize(("name", "batches"), [("stream_tumble", 1), ("stream_tumble", 20), ("stream_interval_join", 4), ("stream_cep_event_time", 4)])
def test_replay_in_any_number_of_batches(spark, monkeypatch, name, batches):
    replayed = streams.timed
    monkeypatch.setattr(streams, "timed", lambda spark, d, build, n=None, checkpoint=None, **more: replayed(spark, d, build, batches, checkpoint, **more))
    fn, sql = streams.__dict__[name], {**__import__("tidewater.plans", fromlist=["x"]).all_queries()[1]}[name]
    assert oracle.compare(fn(spark, SF), oracle.connect(SF), sql) is None


def test_replay_of_a_table_of_many_files(spark, tmp_path):
    load_events(spark, SF).withColumn("ts", F.col("ts").cast("timestamp_ntz")).repartition(60).write.parquet(f"{tmp_path}/events.parquet")
    fn, sql = streams.stream_tumble, __import__("tidewater.plans", fromlist=["x"]).all_queries()[1]["stream_tumble"]
    assert oracle.compare(fn(spark, str(tmp_path)), oracle.connect(SF), sql) is None
    shutil.rmtree(tmp_path / "events.parquet")


def test_slices_hold_every_row_once(spark):
    rows = [(i, None if i % 9 == 0 else START + (i % 5) * HOUR) for i in range(50)]
    d = spark.createDataFrame(rows, "id long, ts timestamp")
    for n in (1, 2, 3, 40):
        got = [[r.id for r in s.collect()] for s in event_time_slices(d, "ts", n)]
        assert sorted(sum(got, [])) == list(range(50))
        times = [{rows[i][1] for i in s if rows[i][1]} for s in got]
        assert all(max(a) < min(b) for a, b in zip(times, times[1:]) if a and b)
    assert sum(s.count() for s in event_time_slices(d.where("false"), "ts", 3)) == 0
