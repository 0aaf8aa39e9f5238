"""Pattern errors, rules, row patterns and running conditions."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewater.operators.pattern import Pattern, PatternError, Running, Skip, begin, match
from tidewater.operators.pattern import recognize as M
from tidewater.operators.pattern import rules as RU

T0 = datetime(2024, 1, 1)
S1 = timedelta(seconds=1)
A, B = "label = 'A'", "label = 'B'"


@pytest.mark.parametrize("make", [
    lambda: begin("a").not_followed_by("n").check(),
    lambda: begin("a").next("a").check(),
    lambda: begin("a", Skip("to_last", "x")).check(),
    lambda: begin("a").optional().not_next("n"),
    lambda: begin("a").optional().not_followed_by("n"),
    lambda: begin("a").times(2).one_or_more(),
    lambda: begin("a").not_next("n").times(2),
    lambda: begin("a").not_next("n").optional(),
    lambda: begin("a").until(A),
    lambda: begin("a").times(2).until(A),
    lambda: begin("a").one_or_more().until(A).until(B),
    lambda: begin("a").consecutive(),
    lambda: begin("a").allow_combinations(),
    lambda: begin("a").one_or_more().consecutive().allow_combinations(),
    lambda: begin("a").greedy(),
    lambda: begin("a").one_or_more().allow_combinations().greedy(),
    lambda: begin("a").one_or_more().greedy().allow_combinations(),
    lambda: begin(begin("a")).times(2).greedy(),
    lambda: begin("a").one_or_more().greedy().optional(),
    lambda: begin("a").optional().optional(),
    lambda: begin("a").times(3, 2),
    lambda: begin("a").times(0),
    lambda: begin(begin("a")).where(A),
    lambda: begin(begin("a")).or_(A),
    lambda: begin(begin("a")).subtype("x"),
])
def test_malformed_patterns(make):
    with pytest.raises(PatternError):
        make()


def frame(spark, keys):
    rows = [(k, T0 + t * S1, j, x, float(v)) for k, ev in keys.items() for j, (t, x, v) in enumerate(ev)]
    return spark.createDataFrame(rows, "k int, ts timestamp, seq int, label string, v double")


def letters(text):
    return [(j, x, j) for j, x in enumerate(text)]


def test_unbounded_pattern_is_refused(spark):
    df = frame(spark, {1: letters("AB")})
    with pytest.raises(PatternError, match="within"):
        match(df, begin("a").where(A).one_or_more().followed_by("b"), ["k"], "ts", ["seq"])


def test_json_round_trip():
    p = begin("a", Skip("past_last")).where(A).times(2).consecutive().next("b").where(Running("a", "v", ">", 9)).within(S1 * 5)
    assert Pattern.from_json(p.to_json()) == p
    g = begin(begin("x").where(A).next("y").where(B)).times(2)
    assert Pattern.from_json(g.to_json()) == g


def test_reference_inputs(spark):
    """The sensor lines and the patterns of the demo jobs."""
    from pyspark.sql import types as T
    from tidewater.sources.readers import delimited

    lines = spark.createDataFrame([(x,) for x in (
        "sensor_1,1,10", "sensor_1,2,20", "sensor_2,3,30", "sensor_1,4,40", "sensor_2,5,50", "sensor_1,6,60")], "value string")
    d = delimited(lines, T.StructType.fromDDL("id string, ts timestamp, vc int"), seconds=["ts"])
    assert match(d, begin("start").where("id = 'sensor_1'"), [], "ts", []).count() == 4
    lines = spark.createDataFrame([(x,) for x in (
        "1,40,10", "1,40,20", "1,40,30", "2,40,70", "1,40,40", "2,50,50", "1,60,60", "2,50,40")], "value string")
    d = delimited(lines, T.StructType.fromDDL("dp string, value double, ts timestamp"), seconds=["ts"])
    assert match(d, begin("s").where("dp = '1'"), ["dp"], "ts", []).count() == 5
    assert match(d, begin("s").where("dp = '2'"), ["dp"], "ts", []).count() == 3


def test_rule_switch(spark):
    """A control row changes the pattern for all keys and drops partial matches."""
    text = "A1 A2 B1 C A1 B1 B2 B1 C A1"
    rows = []
    for j, x in enumerate(text.split()):
        rows.append((int(x[1]) if len(x) > 1 else 0, T0 + j * S1, j, x[0], None))
    df = spark.createDataFrame(rows, "k int, ts timestamp, seq int, label string, v double")
    rules = {"ab": begin("x").where(A).next("y").where(B), "bb": begin("x").where(B).next("y").where(B).to_json()}
    rule = F.when((F.col("label") == "C") & (F.col("seq") < 5), "bb").when(F.col("label") == "C", "ab")
    got = RU.match_rules(df, rules, rule, ["k"], "ts", ["seq"], ["seq"], first_rule="ab", width=S1 * 2)
    out = sorted((r.k, r.rule_id, r.epoch, [e.event.seq for e in r.events]) for r in got.collect())
    # Key 2's partial match of the first rule dies with the switch.
    assert out == [(1, "ab", 0, [0, 2]), (1, "bb", 1, [5, 7])]


def test_running_condition_on_free_skip_and_callable(spark):
    df = frame(spark, {1: [(0, "A", 3), (1, "B", 1), (2, "B", 5), (3, "B", 9)]})
    p = begin("a").where(A).followed_by("b").where(B, Running("a", "v", ">", 7)).within(S1 * 9)
    assert [r.b[0].v for r in match(df, p, ["k"], "ts", ["seq"]).collect()] == [5.0]
    f = begin("a").where(A).followed_by("b").where(B, lambda e, matched: e["v"] > 2 * matched("a")[0]["v"]).within(S1 * 9)
    assert [r.b[0].v for r in match(df, f, ["k"], "ts", ["seq"]).collect()] == [9.0]


def brute_rows(node, labels, define, start, stop):
    """Ends of the row pattern from ``start`` by preference, with labels."""
    if node.kind == "var":
        if start < stop and define[node.name](labels, start):
            yield start + 1, [(node.name, start)]
    elif node.kind == "seq":
        def go(i, at, got):
            if i == len(node.parts):
                yield at, got
                return
            for e, m in brute_rows(node.parts[i], labels, define, at, stop):
                yield from go(i + 1, e, got + m)
        yield from go(0, start, [])
    elif node.kind == "alt":
        for p in node.parts:
            yield from brute_rows(p, labels, define, start, stop)
    elif node.kind == "repeat":
        def rep(n, at, got):
            more = (x for e, m in brute_rows(node.parts[0], labels, define, at, stop) if e > at for x in rep(n + 1, e, got + m)) \
                if node.high is None or n < node.high else iter(())
            here = [(at, got)] if n >= node.low else []
            if node.greedy:
                yield from more
                yield from here
            else:
                yield from here
                yield from more
        yield from rep(0, start, [])


V = M.var
ROW_PATTERNS = {
    "seq_opt": M.seq("A", V("B").opt(), "C"),
    "alt": M.alt(M.seq("A", "B"), "A"),
    "bounded": M.seq("A", V("X").times(0, 2), "B"),
    "bounded_lazy": M.seq("A", V("X").times(0, 2, greedy=False), "B"),
    "permute": M.permute("A", "B", "C"),
    "plus": M.seq("A", V("X").plus(), "B"),
    "plus_lazy": M.seq("A", V("X").plus(greedy=False), "B"),
    "star_alt": M.seq(M.alt("A", "B").star(), "C"),
}
DEFINE = {"A": A, "B": B, "C": "label = 'C'"}


@pytest.mark.parametrize("name", list(ROW_PATTERNS))
@pytest.mark.parametrize("skip", ["next", "past_last"])
def test_row_patterns(spark, name, skip):
    rnd = random.Random(name + skip)
    keys = {k: letters("".join(rnd.choice("AABBCN") for _ in range(rnd.randint(3, 10)))) for k in range(25)}
    node = ROW_PATTERNS[name]
    names = M._variables(node)
    m = M.match_recognize(
        frame(spark, keys), ["k"], "ts", node, DEFINE, {"rows": "array_join(transform(array_sort(flatten(array(" + ", ".join(
            f"transform({n}, x -> named_struct('s', x.seq, 'n', '{n}'))" for n in names) + "))), x -> x.n || x.s), ' ')"},
        tie=["seq"], after_match=Skip(skip), within=S1 * 6, payload=["seq"])
    got = sorted((r.k, r.match_number, r.rows) for r in m.collect())
    define = {n: (lambda labels, i, n=n: n == "X" or labels[i] == n) for n in names}
    want = []
    for k, ev in keys.items():
        labels = [x for _, x, _ in ev]
        at, number = 0, 0
        while at < len(labels):
            hit = next((m for e, m in brute_rows(node, labels, define, at, min(at + 6, len(labels))) if e > at), None)
            if hit:
                number += 1
                want.append((k, number, " ".join(f"{n}{i}" for n, i in hit)))
                at = hit[-1][1] + 1 if skip == "past_last" else at + 1
            else:
                at += 1
    assert got == sorted(want)


def test_row_pattern_without_bound(spark):
    m = M.match_recognize(frame(spark, {1: letters("ABCAB")}), ["k"], "ts", M.seq("A", V("X").plus()), {"X": "label <> 'A'"}, {"n": "size(X)"})
    assert sorted(tuple(r) for r in m.collect()) == [(1, 1, 2), (1, 2, 1)]
