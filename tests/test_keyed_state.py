"""List, map and value state, timers, and windows kept as elements."""

import sys
from datetime import datetime, timedelta

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tidewater.session import work_dir
from tidewater.streaming import keyed as K
from tidewater.streaming import state as ST
from tidewater.streaming import windows as W
from tidewater.streaming.runner import run_slices, write_all

START = datetime(2024, 1, 1)
HOUR = timedelta(hours=1)
c = F.col
# Workers cannot import the tests.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def table(spark, rows):
    return spark.createDataFrame([(k, i, None if h is None else START + h * HOUR) for k, i, h in rows], "k string, id long, ts timestamp")


def run(spark, slices, build):
    out, ck = work_dir(spark, "out"), work_dir(spark, "ckpt")
    with K.list_state_store(spark):
        run_slices(spark, slices, lambda s, ckpt: write_all(build(s), checkpoint=ckpt, path=out), ck)
    return out, ck


def ids(key, pane, rows):
    return [(key[0], pane, [r["id"] for r in rows])]


def windows(last=None, span=None, count=None):
    def build(s):
        rows, key = K.in_windows(s.withWatermark("ts", "0 seconds"), W.tumble("ts", "6 hours"), ["k"])
        p = K.WindowElements(["id", "ts"], "id bigint, ts timestamp", ["ts", "id"], ids, count, last, span, "ts")
        return K.process(rows, key, p, "k string, pane bigint, ids array<bigint>")

    return build


@pytest.mark.parametrize(("options", "want"), [
    ({}, [("a", 0, [1, 2, 3, 4]), ("b", 0, [7]), ("a", 0, [5])]),
    ({"last": 2}, [("a", 0, [3, 4]), ("b", 0, [7]), ("a", 0, [5])]),
    ({"span": HOUR}, [("a", 0, [3, 4]), ("b", 0, [7]), ("a", 0, [5])]),
    ({"count": 2}, [("a", 0, [1, 2]), ("a", 1, [3, 4]), ("b", 0, [7]), ("a", 0, [5]), ("b", 0, [6, 10])]),
    ({"count": 3, "last": 1}, [("a", 0, [3]), ("a", 1, [4]), ("b", 0, [7]), ("a", 0, [5])]),
], ids=["whole", "last", "span", "count", "count_last"])
def test_windows_as_elements(spark, options, want):
    """Rows of a batch come in any order; late rows (8) and rows without a time (9) take no part."""
    slices = [table(spark, [("a", 2, 1), ("a", 1, 0), ("b", 7, 2), ("a", 9, None)]), table(spark, [("a", 4, 5.5), ("a", 3, 5)]),
              table(spark, [("a", 5, 7)]), table(spark, [("b", 6, 30), ("a", 8, 0)]), table(spark, [("b", 10, 31)])]
    out, ck = run(spark, slices, windows(**options))
    got = [(r.k, r.pane, r.ids) for r in spark.read.parquet(out).collect()]
    assert sorted(got) == sorted(want)
    assert sorted(r.id for r in ST.read_state(spark, ck, variable="elements").select("list_element.id").collect()) == ([6, 10] if options.get("count") != 2 else [])


def counter():
    total = K.Value("total", "n bigint", lambda old, row: ((old[0] if old else 0) + 1,))
    seen = K.Items("seen", "id bigint", lambda row: (row["id"],) if row["id"] % 2 else None)
    best = K.Entries("best", "odd boolean", "id bigint", lambda row: (row["id"] % 2 == 1,), lambda old, row: (max(old[0] if old else 0, row["id"]),))
    return [total, seen, best]


def test_state_from_a_table_then_from_rows(spark):
    first = spark.createDataFrame(
        [("a", (5,), [(1,), (3,)], [((True,), (3,))], 1000), ("z", (1,), None, None, None)],
        "k string, total struct<n: bigint>, seen array<struct<id: bigint>>, best array<struct<k: struct<odd: boolean>, v: struct<id: bigint>>>, timer bigint")
    build = lambda s: K.process(s, ["k"], K.KeyedProcessor(counter(), on_timer=lambda key, state, at: [(key[0], state["total"].get()[0], at)],
                                emit=lambda key, state: [(key[0], state["total"].get()[0], None)]), "k string, n bigint, at bigint", first)
    rows = table(spark, [("a", 7, 1), ("a", 8, 2), ("b", 1, 1), (None, 2, 1)])
    out, ck = run(spark, [rows, table(spark, [("b", 4, 40)])], lambda s: build(s.withWatermark("ts", "0 seconds")))
    got = sorted(((r.k or "-", r.n, r["at"]) for r in spark.read.parquet(out).collect()), key=str)
    assert got == sorted([("a", 7, None), ("b", 1, None), ("-", 1, None), ("b", 2, None), ("a", 7, 1000)], key=str)
    state = lambda name: ST.read_state(spark, ck, variable=name)
    assert {(r.k, r.n) for r in state("total").select("key.k", "value.n").collect()} == {("a", 7), ("b", 2), (None, 1), ("z", 1)}
    assert sorted((r.k, r.id) for r in state("seen").select("key.k", "list_element.id").collect()) == [("a", 1), ("a", 3), ("a", 7), ("b", 1)]
    best = state("best").select("key.k", "user_map_key.odd", "user_map_value.id").collect()
    assert {(r.k, r.odd, r.id) for r in best} == {("a", True, 7), ("a", False, 8), ("b", True, 1), ("b", False, 4), (None, False, 2)}


def test_a_later_timer_replaces_the_earlier_one(spark):
    ms = lambda row: int(row["ts"].timestamp() * 1000) + 3_600_000 if row["ts"] else None
    build = lambda s: K.process(s.withWatermark("ts", "0 seconds"), ["k"], K.KeyedProcessor(counter(), timer=ms, on_timer=lambda key, state, at: [(key[0], at)]), "k string, at bigint")
    slices = [table(spark, [("a", 1, 0), ("a", 2, 0.5), ("b", 3, 0)]), table(spark, [("a", 4, 1.2)]), table(spark, [("c", 5, 9)])]
    out, ck = run(spark, slices, build)
    at = lambda h: int((START + h * HOUR - datetime(1970, 1, 1)) / timedelta(milliseconds=1))
    assert sorted((r.k, r["at"]) for r in spark.read.parquet(out).collect()) == [("a", at(2.2)), ("b", at(1))]
    assert [(r.k, r.expiration_timestamp_ms) for r in ST.read_state(spark, ck, timers=True).select("key.k", "expiration_timestamp_ms").collect()] == [("c", at(10))]
