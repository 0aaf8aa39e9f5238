"""Spark engines against the slow matcher, with chunks a few events wide."""

import random
from datetime import datetime, timedelta

import pytest
from brute import matches, skipped
from patterns import LOOPS, PATTERNS
from pyspark.sql import functions as F
from test_pattern_machine import holds

from tidewater.operators.pattern import Skip, match
from tidewater.operators.pattern.api import find
from tidewater.operators.pattern.graph import build

T0 = datetime(2024, 1, 1)
SECOND = timedelta(seconds=1)


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(7)
    keys = {}
    for k in range(70):
        n = rnd.randint(1, 10)
        # Some seconds are empty, so chunks are missing in between.
        t, rows = 0, []
        for _ in range(n):
            t += rnd.choice([0, 0, 1, 1, 4])
            rows.append((t, {"label": rnd.choice("ABCN")}))
        keys[k] = rows
    rows = [(k if k else None, T0 + t * SECOND, j, r["label"]) for k, ev in keys.items() for j, (t, r) in enumerate(ev)]
    df = spark.createDataFrame(rows, "k int, ts timestamp, seq int, label string").repartition(4).cache()
    return keys, df


def got(df, pattern, engine, width, timeouts=False):
    g = build(pattern)
    out = find(df, pattern, g, ["k"], "ts", ["seq"], ["seq"], width, timeouts, engine)
    names = [s.name for s in g.slots]
    rows = out.select(F.col("__key.k").alias("k"), "kind", "timeout_ts", F.transform("items", lambda x: F.struct(x.slot, x.e.seq)).alias("i")).collect()
    return sorted((r.k or 0, r.kind, tuple((names[s], q) for s, q in r.i)) for r in rows)


def want(keys, pattern, within=None):
    return sorted((k, "match", m) for k, ev in keys.items()
                  for m in skipped(matches(pattern.steps, ev, holds, within), pattern.skip)) if pattern.skip.kind != "none" else \
        sorted((k, "match", m) for k, ev in keys.items() for m in matches(pattern.steps, ev, holds, within))


@pytest.mark.parametrize("name", list(PATTERNS))
def test_window_form(data, name):
    keys, df = data
    assert got(df, PATTERNS[name], "chain", SECOND * 2) == want(keys, PATTERNS[name])


def test_window_form_within(data):
    keys, df = data
    p = PATTERNS["relaxed3"].within(SECOND * 5)
    assert got(df, p, "chain", SECOND * 2) == want(keys, p, 5)


@pytest.mark.parametrize("name", ["any", "any3", "plus", "plus_greedy_until", "star", "plus_not", "times_combinations"])
def test_chunk_form(data, name):
    keys, df = data
    p = LOOPS[name].within(SECOND * 6)
    assert got(df, p, "chunks", SECOND * 4) == want(keys, p, 6)


def test_pair_form(data):
    keys, df = data
    p = LOOPS["any"].within(SECOND * 6)
    assert got(df, p, "pairs", SECOND * 2) == want(keys, p, 6)


@pytest.mark.parametrize("skip", [Skip("next"), Skip("past_last"), Skip("to_first", "b"), Skip("to_last", "a")], ids=lambda s: s.kind)
@pytest.mark.parametrize("engine", ["chain", "chunks"])
def test_skip(data, skip, engine):
    keys, df = data
    base = PATTERNS["times_range"] if engine == "chain" else LOOPS["plus"]
    p = base.within(SECOND * 8).after_match(skip)
    assert got(df, p, engine, SECOND * 3) == want(keys, p, 8)


@pytest.mark.parametrize("name", ["relaxed3", "not_followed_mid", "mixed"])
def test_timeouts_agree(data, name):
    _, df = data
    p = PATTERNS[name].within(SECOND * 5)
    a, b = got(df, p, "chain", SECOND * 2, True), got(df, p, "chunks", SECOND * 3, True)
    assert a == b and any(kind == "timeout" for _, kind, _ in a)


def test_match_shape(data):
    _, df = data
    m = match(df, PATTERNS["optional_relaxed"], ["k"], "ts", ["seq"], ["seq", "label"])
    assert m.columns == ["k", "start_ts", "end_ts", "a", "b", "c"]
    assert m.where("b is null").count() > 0
