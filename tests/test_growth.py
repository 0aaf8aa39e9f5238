"""What must not grow faster than the input: sketches per pair, state that a join looks through, calls to the state."""

import re
import sys
from datetime import datetime, timedelta

import pytest
from pyspark import cloudpickle
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.plans import all_queries
from tidewater.session import work_dir
from tidewater.streaming import keyed as K
from tidewater.streaming import state as ST
from tidewater.streaming import windows as W
from tidewater.streaming.joins import JsonSide, json_join
from tidewater.streaming.runner import run_slices, write_all

START = datetime(2024, 1, 1)
HOUR = timedelta(hours=1)
c = F.col
# Workers cannot import the tests.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def test_sketches_are_kept_per_event_type_only(spark, tmp_path):
    rows = [("a", u % 40) for u in range(100)] + [("b", None), ("b", None), (None, 1), (None, 2)]
    spark.createDataFrame(rows, "event_type string, user_id long").write.parquet(str(tmp_path / "events.parquet"))
    out = all_queries()[0]["agg_approx_distinct"](spark, str(tmp_path))
    assert {tuple(r) for r in out.collect()} == {("a", 40, True), ("b", 0, True), (None, 2, True)}
    plan = out._jdf.queryExecution().sparkPlan().toString()
    sketched = [line for line in plan.splitlines() if "approx_count_distinct" in line and "Aggregate" in line]
    assert sketched and not any("user_id" in re.search(r"keys=\[(.*?)\]", line)[1] for line in sketched)


def table(spark, rows):
    return spark.createDataFrame([(k, i, START + h * HOUR) for k, i, h in rows], "k string, id long, ts timestamp")


def test_one_timer_per_key_not_per_window(spark):
    """A key with several open windows: those due together close together, the others wait for the first of them."""
    def build(s):
        rows, key = K.in_windows(s.withWatermark("ts", "0 seconds"), W.tumble("ts", "6 hours"), ["k"])
        assert key == ["k"]
        p = K.WindowElements(["id"], "id bigint", ["ts", "id"], lambda key, pane, rows: [(key[0], key[1], key[2], pane, [r["id"] for r in rows])], 2)
        return K.process(rows, key, p, "k string, since timestamp, until timestamp, pane bigint, ids array<bigint>")

    # After the second slice two windows of a are due, one of them at the mark itself.
    slices = [table(spark, [("a", i, 5 * i) for i in range(1, 5)]), table(spark, [("a", 5, 21), ("a", 10, 24), ("b", 6, 30)]), table(spark, [("a", 7, 31), ("a", 8, 32), ("a", 9, 45)])]
    out, ck, waiting = work_dir(spark, "out"), work_dir(spark, "ckpt"), []

    def start(s, ckpt):
        write_all(build(s), checkpoint=ckpt, path=out)
        waiting.append(sorted((r.k, r["at"]) for r in ST.read_state(spark, ckpt, timers=True).select("key.k", c("expiration_timestamp_ms").alias("at")).collect()))

    with K.list_state_store(spark):
        run_slices(spark, slices, start, ck)
    at = lambda h: int((START + h * HOUR - datetime(1970, 1, 1)) / timedelta(milliseconds=1))
    assert waiting == [[("a", at(24))], [("b", at(36))], [("a", at(48))]]
    rows = spark.read.parquet(out).withColumns({x: ((F.unix_millis(x) - at(0)) / 3_600_000).cast("int") for x in ("since", "until")})
    got = sorted((r.k, r.since, r.until, r.pane, r.ids) for r in rows.collect())
    assert got == [("a", 0, 6, 0, [1]), ("a", 6, 12, 0, [2]), ("a", 12, 18, 0, [3]), ("a", 18, 24, 0, [4, 5]), ("a", 24, 30, 0, [10]), ("a", 30, 36, 0, [7, 8]), ("b", 30, 36, 0, [6])]
    state = ST.read_state(spark, ck, variable="elements").select("key.k", "list_element.id", F.timestamp_micros("list_element.window_start").alias("since"))
    assert [(r.k, r.id, r.since) for r in state.collect()] == [("a", 9, START + 42 * HOUR)]


class Calls:
    """A state variable or handle that notes the calls made to it."""

    def __init__(self, value=None):
        self.value, self.made = value, []

    def __getattr__(self, name):
        def call(*args):
            self.made.append(name)
            return {"exists": self.value is not None, "get": self.value, "listTimers": [1]}.get(name)

        return call


def test_calls_to_the_state_of_a_key():
    """A key that has no value yet is not looked up; of a map, each key is looked up once."""
    add = lambda old, row: ((old[0] if old else 0) + 1,)
    p = K.KeyedProcessor([K.Value("n", "n bigint", add), K.Entries("m", "k string", "n bigint", lambda row: (row["k"],), add)], timer=lambda row: 7)
    rows = [Row(k=k) for k in "xyxyz"]

    def made(value, started=False):
        p.state, p.handle, p.started = {"n": Calls(value), "m": Calls()}, Calls(), started
        list(p.handleInputRows(("a",), iter(rows), None))
        return [p.state["n"].made, p.state["m"].made, p.handle.made]

    put = ["updateValue"] * 3
    assert made(None) == [["exists", "update"], put, ["registerTimer"]]
    look = [["get", "update"], ["getValue"] * 3 + put, ["listTimers", "deleteTimer", "registerTimer"]]
    assert made((1,)) == [["exists", *look[0]], *look[1:]]
    # With a table to start from, a key may have any state.
    assert made(None, started=True) == look


@pytest.mark.parametrize("how", ["inner", "left_outer", "right_outer"])
def test_json_join_looks_at_reachable_times_only(spark, how):
    """Bounds on both sides, times on the edges of a stretch, repeated rows, NULL keys and texts without a time."""
    rows = [(s, i, k, t) for s, shift in (("l", 0), ("r", 100)) for i, (k, t) in enumerate([(1, 0), (1, 3), (1, 3), (2, 7), (1, 11), (None, 5), (1, -4), (2, None), (1, 30), (2, 31)], shift)]
    rows += [("r", 200 + i, 1 + i % 2, i - 6) for i in range(40)]
    df = spark.createDataFrame([(s, i, k, t, START + timedelta(hours=t or 0)) for s, i, k, t in rows], "s string, id long, k int, h int, ts timestamp")
    far = [spark.createDataFrame([(s, -1, None, 400, START + 400 * HOUR) for s in "lr"], df.schema), spark.createDataFrame([(s, -1, None, 800, START + 800 * HOUR) for s in "lr"], df.schema)]
    body = F.to_json(F.struct("id", "k", F.when(c("h").isNotNull(), F.unix_micros("ts")).alias("t")))
    out = work_dir(spark, "out")

    def start(s, ckpt):
        side = lambda name: JsonSide(s.where(c("s") == name).select(body.alias("body")), "body", T.StructType.fromDDL("id bigint, k int, t bigint"), "t")
        j = json_join(side("l"), side("r"), [("k", "k")], "2 HOURS", "4 HOURS", how)
        assert "stretch" in j._jdf.queryExecution().analyzed().toString()
        write_all(j.select(c("left.id").alias("a"), c("right.id").alias("b")), checkpoint=ckpt, path=out)

    run_slices(spark, [df, *far], start)
    left, right = ([(i, k, t) for x, i, k, t in rows if x == s and t is not None] for s in "lr")
    want = [(i, j) for i, k, t in left for j, m, u in right if k == m and k is not None and t - 2 <= u <= t + 4]
    alone = lambda side, met: [i for i, _, _ in side if i not in met]
    want += [(i, None) for i in alone(left, {a for a, _ in want})] * (how == "left_outer")
    want += [(None, j) for j in alone(right, {b for _, b in want})] * (how == "right_outer")
    got = [r for r in map(tuple, spark.read.parquet(out).collect()) if -1 not in r]
    assert sorted(got, key=str) == sorted(want, key=str)
