"""Structured Streaming queries over the events table, run to completion."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators.pattern import Skip, begin
from tidewater.plans.registry import query
from tidewater.sources.readers import good_and_broken
from tidewater.streaming import keyed as K
from tidewater.streaming import state as ST
from tidewater.streaming import windows as W
from tidewater.streaming.changes import RetractSink
from tidewater.streaming.joins import JsonSide, json_join
from tidewater.streaming.matcher import BatchMatcher, stream_match
from tidewater.streaming.rules import RuleMatcher
from tidewater.streaming.runner import (
    collect_table, each_batch, latest_table, replay, run_slices, stream_events, stream_table)
from tidewater.session import load, load_events, work_dir

c = F.col
HOUR = timedelta(hours=1)


def path(d):
    return f"{d}/events.parquet"


def ntz(*names):
    return [c(n).cast("timestamp_ntz").alias(n) for n in names]


def _aggs():
    return [F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total")]


def timed(spark, d, build, batches=None, checkpoint=None, delay="1 hour"):
    """The events replayed in event-time order, with a watermark."""
    return replay(load_events(spark, d), "ts", lambda s: build(s.withWatermark("ts", delay) if delay else s), batches, checkpoint)


# Windows that end by (greatest time - delay) are closed and come out. The mark
# is cut to milliseconds, as the engine keeps it.
_CLOSED = "(SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 HOUR FROM events)"


@query("stream_tumble", f"""
    SELECT event_type, time_bucket(INTERVAL 6 HOUR, ts) AS window_start, time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR AS window_end,
           count(*) AS n, round(sum(value), 4) AS total FROM events
    GROUP BY 1, 2, 3 HAVING time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR <= {_CLOSED}""")
def stream_tumble(spark, d):
    out = timed(spark, d, lambda ev: W.window_agg(ev, W.tumble("ts", "6 hours"), ["event_type"], _aggs()))
    return out.select("event_type", *ntz("window_start", "window_end"), "n", "total")


@query("stream_hop", f"""
    SELECT event_type, s AS window_start, s + INTERVAL 6 HOUR AS window_end, count(*) AS n, round(sum(value), 4) AS total
    FROM (SELECT *, unnest([time_bucket(INTERVAL 2 HOUR, ts), time_bucket(INTERVAL 2 HOUR, ts) - INTERVAL 2 HOUR, time_bucket(INTERVAL 2 HOUR, ts) - INTERVAL 4 HOUR]) AS s FROM events)
    GROUP BY ALL HAVING window_end <= {_CLOSED}""")
def stream_hop(spark, d):
    out = timed(spark, d, lambda ev: W.window_agg(ev, W.hop("ts", "2 hours", "6 hours"), ["event_type"], _aggs()))
    return out.select("event_type", *ntz("window_start", "window_end"), "n", "total")


@query("stream_session", f"""
    WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 2 HOUR THEN 0 ELSE 1 END AS s FROM events),
         k AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts) AS id FROM g)
    SELECT user_id, min(ts) AS window_start, max(ts) + INTERVAL 2 HOUR AS window_end, count(*) AS n, round(sum(value), 4) AS total
    FROM k GROUP BY user_id, id HAVING max(ts) + INTERVAL 2 HOUR <= {_CLOSED}""")
def stream_session(spark, d):
    out = timed(spark, d, lambda ev: W.window_agg(ev, W.session("ts", "2 hours"), ["user_id"], _aggs()))
    return out.select("user_id", *ntz("window_start", "window_end"), "n", "total")


@query("stream_rolling_sum", "SELECT user_id, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY user_id")
def stream_rolling_sum(spark, d):
    return latest_table(stream_events(spark, path(d)).groupBy("user_id").agg(*_aggs()), ["user_id"])


@query("stream_union_filter", """
    SELECT event_id, user_id FROM events WHERE event_type = 'view' AND value > 20 UNION ALL SELECT event_id, user_id FROM events WHERE event_type = 'click' AND value < 5""")
def stream_union_filter(spark, d):
    ev = stream_table(spark, path(d))
    a = ev.where("event_type = 'view' AND value > 20").select("event_id", "user_id")
    return collect_table(a.union(ev.where("event_type = 'click' AND value < 5").select("event_id", "user_id")))


@query("stream_interval_join", """
    SELECT a.event_id AS click_id, b.event_id AS buy_id FROM events a JOIN events b ON a.user_id = b.user_id AND b.ts >= a.ts AND b.ts < a.ts + INTERVAL 1 HOUR
    WHERE a.event_type = 'click' AND b.event_type = 'purchase'""")
def stream_interval_join(spark, d):
    def join(ev):
        a = ev.where("event_type = 'click'").select(c("event_id").alias("click_id"), "user_id", c("ts").alias("t1"))
        b = ev.where("event_type = 'purchase'").select(c("event_id").alias("buy_id"), c("user_id").alias("u2"), c("ts").alias("t2"))
        return a.join(b, F.expr("user_id = u2 AND t2 >= t1 AND t2 < t1 + INTERVAL 1 HOUR")).select("click_id", "buy_id")

    return timed(spark, d, join)


_SIDE = "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, ts FROM events WHERE event_type = '{0}'"


@query("stream_json_join", f"""
    WITH l AS ({_SIDE.format("click")}), r AS ({_SIDE.format("signup")}),
         m AS (SELECT date_trunc('milliseconds', least((SELECT max(ts) FROM l), (SELECT max(ts) FROM r))) - INTERVAL 1 HOUR AS mark),
         p AS (SELECT l.event_id AS click_id, l.k, r.event_id AS signup_id, l.ts FROM l LEFT JOIN r ON l.k = r.k AND r.ts >= l.ts AND r.ts <= l.ts + INTERVAL 8 HOUR)
    SELECT click_id, k, signup_id FROM p, m WHERE signup_id IS NOT NULL OR ts + INTERVAL 8 HOUR < mark""")
def stream_json_join(spark, d):
    """Clicks with the signups of the same key in the next eight hours; clicks without one come once that is sure."""
    schema = T.StructType.fromDDL("id bigint, k int, t bigint")

    def join(ev):
        body = F.to_json(F.struct(c("event_id").alias("id"), F.get_json_object("props", "$.k").cast("int").alias("k"), F.unix_micros("ts").alias("t")))
        side = lambda kind: JsonSide(ev.where(c("event_type") == kind).select(body.alias("body")), "body", schema, "t")
        j = json_join(side("click"), side("signup"), [("k", "k")], "0 HOURS", "8 HOURS", "left_outer")
        return j.select(c("left.id").alias("click_id"), c("left.k").alias("k"), c("right.id").alias("signup_id"))

    return timed(spark, d, join, delay=None)


@query("stream_static_join", "SELECT e.event_id, c.c_mktsegment FROM events e JOIN customer c ON e.user_id = c.c_custkey WHERE e.event_type = 'purchase'")
def stream_static_join(spark, d):
    ev = stream_table(spark, path(d)).where("event_type = 'purchase'")
    # The static side is broadcast only while its statistics stay below the
    # session's threshold.
    cust = load(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return collect_table(ev.join(cust, c("user_id") == c("c_custkey")).select("event_id", "c_mktsegment"))


@query("stream_dedupe", "SELECT DISTINCT user_id, event_type FROM events")
def stream_dedupe(spark, d):
    # No horizon: a pair counts once, however much later it comes back. State is one row per pair.
    return collect_table(stream_table(spark, path(d)).select("user_id", "event_type").dropDuplicates())


def _slices(spark, d):
    """Three slices of equal time; rows of high value arrive one slice late."""
    ev = load_events(spark, d)
    # Seconds from the first event on, cut into thirds.
    lo, hi = ev.agg(F.unix_seconds(F.min("ts")), F.unix_seconds(F.max("ts"))).first()
    lo, hi = lo or 0, hi or 0
    due = F.least(F.floor((F.unix_seconds("ts") - F.lit(lo)) * 3 / F.lit(max(hi - lo, 1))), F.lit(2))
    ev = ev.withColumn("slice", F.least(due + F.when(c("value") > 75, 1).otherwise(0), F.lit(2)))
    return [ev.where(c("slice") == i).drop("slice") for i in range(3)]


_SLICES = """e AS (SELECT *, CAST(floor(epoch(ts)) AS BIGINT) AS sec FROM events), b AS (SELECT min(sec) AS lo, max(sec) AS hi FROM e),
    s AS (SELECT e.* EXCLUDE (sec), least(floor((sec - lo) * 3 / greatest(hi - lo, 1)), 2) AS due FROM e CROSS JOIN b),
    a AS (SELECT *, least(due + CASE WHEN value > 75 THEN 1 ELSE 0 END, 2) AS slice FROM s),
    w AS (SELECT slice, max(max(ts)) OVER (ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 1 HOUR AS mark FROM a GROUP BY slice)"""


@query("stream_late_split", f"""
    WITH {_SLICES} SELECT coalesce(ts <= mark, FALSE) AS late, count(*) AS n, sum(event_id) AS ids, round(sum(value), 4) AS total FROM a JOIN w USING (slice) GROUP BY 1""")
def stream_late_split(spark, d):
    split = W.LateSplit(spark, "ts", HOUR)
    run_slices(spark, _slices(spark, d), lambda s, ck: each_batch(s, split, checkpoint=ck))
    rows = split.rows(True).select(F.lit(True).alias("late"), "event_id", "value").unionAll(
        split.rows(False).select(F.lit(False).alias("late"), "event_id", "value"))
    return rows.groupBy("late").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"), F.round(F.sum("value"), 4).alias("total"))


@query("stream_late_count", f"""
    WITH {_SLICES} SELECT CAST(slice AS BIGINT) AS batch, count(*) AS n FROM a JOIN w USING (slice) WHERE ts <= mark GROUP BY 1""")
def stream_late_count(spark, d):
    split = W.LateSplit(spark, "ts", HOUR)
    run_slices(spark, _slices(spark, d), lambda s, ck: each_batch(s, split, checkpoint=ck))
    return split.late_counts()


@query("stream_side_outputs", """
    SELECT 'all' AS output, count(*) AS n, sum(event_id) AS ids FROM events
    UNION ALL SELECT 'error', count(*), sum(event_id) FROM events WHERE event_type = 'error'
    UNION ALL SELECT 'high', count(*), sum(event_id) FROM events WHERE value > 90""")
def stream_side_outputs(spark, d):
    """A main output with every row and two side outputs that overlap."""
    sink = W.SideOutputs(spark, {"all": F.lit(True), "error": c("event_type") == "error", "high": c("value") > 90})
    each_batch(stream_table(spark, path(d)).select("event_id", "event_type", "value"), sink)
    parts = [sink.rows(tag).agg(F.lit(tag).alias("output"), F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids")) for tag in sink.outputs]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


@query("stream_retract", f"""
    WITH {_SLICES}, t AS (SELECT user_id, k AS slice, count(*) AS n FROM a JOIN (SELECT unnest([0, 1, 2]) AS k) ON a.slice <= k GROUP BY 1, 2),
         p AS (SELECT *, lag(n) OVER (PARTITION BY user_id ORDER BY slice) AS o FROM t)
    SELECT CASE WHEN o IS NULL THEN '+I' ELSE '+U' END AS op, user_id, n FROM p WHERE o IS NULL OR o <> n
    UNION ALL SELECT '-U', user_id, o FROM p WHERE o <> n""")
def stream_retract(spark, d):
    sink = RetractSink(spark, ["user_id"])
    totals = lambda s: s.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    run_slices(spark, _slices(spark, d), lambda s, ck: each_batch(totals(s), sink, "update", ck))
    return sink.changes().select("op", "user_id", "n")


_MESSY = "CASE WHEN event_type = 'error' THEN substr(props, 2) ELSE props END"


@query("json_dirty_split", """
    SELECT event_type = 'error' AS broken, count(*) AS n, CAST(sum(CASE WHEN event_type <> 'error' THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END) AS BIGINT) AS k FROM events GROUP BY 1""")
def json_dirty_split(spark, d):
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    raw = stream_table(spark, path(d)).select(F.expr(_MESSY).alias("value"))
    parsed = good_and_broken(raw, "value", schema).select("broken", c("data.k").alias("k"))
    out = collect_table(parsed)
    return out.groupBy("broken").agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("k"))


@query("stream_counters", "SELECT count(*) FILTER (WHERE event_type <> 'error') AS \"normalDataNum\", count(*) FILTER (WHERE event_type = 'error') AS \"dirtyDataNum\" FROM events")
def stream_counters(spark, d):
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    from tidewater.functions.json import from_lenient
    raw = stream_table(spark, path(d)).select(F.expr(_MESSY).alias("value"))
    sink = W.QualitySplit(spark, "value", lambda t: from_lenient(t, schema))
    each_batch(raw, sink)
    return sink.counts()


_BUY = begin("a").where("event_type = 'click'").followed_by("b").where("event_type = 'purchase'").within(6 * HOUR)
_BUY_SQL = """SELECT a.user_id, a.event_id AS a_id, b.event_id AS b_id, b.ts FROM (SELECT * FROM events WHERE event_type = 'click') a
    ASOF JOIN (SELECT * FROM events WHERE event_type = 'purchase') b ON a.user_id = b.user_id AND a.ts < b.ts WHERE b.ts - a.ts < INTERVAL 6 HOUR"""


@query("stream_cep_event_time", f"SELECT user_id, a_id, b_id FROM ({_BUY_SQL}) WHERE ts <= {_CLOSED}")
def stream_cep_event_time(spark, d):
    def matched(ev):
        m = stream_match(ev.select("event_id", "user_id", "event_type", "ts"), _BUY, ["user_id"], "ts", ["event_id"], ["event_id"])
        return m.select("user_id", c("a")[0]["event_id"].alias("a_id"), c("b")[0]["event_id"].alias("b_id"))

    # Events at the watermark itself have passed it.
    return timed(spark, d, matched)


@query("stream_cep_microbatch", f"""
    WITH {_SLICES}, events AS (SELECT a.* FROM a JOIN w USING (slice) WHERE mark IS NULL OR ts > mark)
    SELECT user_id, a_id, b_id FROM ({_BUY_SQL}) WHERE ts <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""")
def stream_cep_microbatch(spark, d):
    sink = BatchMatcher(spark, _BUY, ["user_id"], "ts", ["event_id"], ["event_id"], HOUR)
    keep = lambda s: s.select("event_id", "user_id", "event_type", "ts")
    run_slices(spark, _slices(spark, d), lambda s, ck: each_batch(keep(s), sink, checkpoint=ck))
    return sink.matches().select("user_id", c("a")[0]["event_id"].alias("a_id"), c("b")[0]["event_id"].alias("b_id"))


def _skipped(matches: str, after: str) -> str:
    """Recursive SQL: the first match of each user that starts late enough, again and again, among starts the mark has passed by a day."""
    return f"""WITH RECURSIVE {_IN_TIME}, m AS (SELECT * FROM ({matches}) WHERE t0 <= (SELECT max(ts) - INTERVAL 1 HOUR - INTERVAL 1 DAY FROM events)),
      r AS (SELECT user_id, arg_min(a_id, t0) AS a_id FROM m GROUP BY user_id
            UNION ALL SELECT n.user_id, arg_min(n.a_id, n.t0) FROM r JOIN m o ON o.a_id = r.a_id JOIN m n ON n.user_id = o.user_id AND {after} GROUP BY n.user_id)
      SELECT m.user_id, m.a_id, m.b_id FROM r JOIN m USING (a_id)"""


_IN_TIME = f"{_SLICES}, events AS (SELECT a.* FROM a JOIN w USING (slice) WHERE mark IS NULL OR ts > mark)"
_CLICKS, _BUYS = (f"(SELECT * FROM events WHERE event_type = '{k}')" for k in ("click", "purchase"))
_DAY = timedelta(days=1)


def _skip_stream(spark, d, pattern):
    sink = BatchMatcher(spark, pattern.within(_DAY), ["user_id"], "ts", ["event_id"], ["event_id"], HOUR)
    keep = lambda s: s.select("event_id", "user_id", "event_type", "ts")
    run_slices(spark, _slices(spark, d), lambda s, ck: each_batch(keep(s), sink, checkpoint=ck))
    return sink.matches().select("user_id", c("a")[0]["event_id"].alias("a_id"), c("b")[0]["event_id"].alias("b_id"))


@query("stream_cep_skip", _skipped(
    f"SELECT a.user_id, a.event_id AS a_id, a.ts AS t0, b.event_id AS b_id, b.ts AS t1 FROM {_CLICKS} a ASOF JOIN {_BUYS} b ON a.user_id = b.user_id AND a.ts < b.ts WHERE b.ts - a.ts < INTERVAL 1 DAY",
    "n.t0 > o.t1"))
def stream_cep_skip(spark, d):
    """Each match begins after the last event of the one before, across batches."""
    return _skip_stream(spark, d, begin("a", Skip("past_last")).where("event_type = 'click'").followed_by("b").where("event_type = 'purchase'"))


@query("stream_cep_skip_to", _skipped(
    f"""SELECT x.user_id, x.event_id AS a_id, x.ts AS t0, y.ts AS ty, b.event_id AS b_id, b.ts AS t1 FROM {_CLICKS} x ASOF JOIN {_CLICKS} y ON x.user_id = y.user_id AND x.ts < y.ts
    ASOF JOIN {_BUYS} b ON y.user_id = b.user_id AND y.ts < b.ts WHERE b.ts - x.ts < INTERVAL 1 DAY""", "n.t0 >= o.ty"))
def stream_cep_skip_to(spark, d):
    """Each match begins at the last click of the one before, or later."""
    return _skip_stream(spark, d, begin("a", Skip("to_last", "a")).where("event_type = 'click'").times(2).followed_by("b").where("event_type = 'purchase'"))


_LOOK = begin("x").where("event_type = 'view'").next("y").where("event_type = 'click'").within(6 * HOUR)
_NOW = begin("x").where("event_type = 'click'").next("y").where("event_type = 'purchase'").within(6 * HOUR)
_SWITCH = "CASE WHEN event_type = 'signup' AND value < 10 THEN '{0}' WHEN event_type = 'signup' AND value < 20 THEN '{1}' END"


def _rule_matcher(spark, d):
    """The control rows carry the rule itself as text."""
    buy, look = _NOW.to_json(), _LOOK.to_json()
    rule = F.when((c("event_type") == "signup") & (c("value") < 10), buy).when((c("event_type") == "signup") & (c("value") < 20), look)
    sink = RuleMatcher(spark, rule, ["user_id"], "ts", ["event_id"], ["event_id"], HOUR, first_rule=buy)
    keep = lambda s: s.select("event_id", "user_id", "event_type", "value", "ts")
    run_slices(spark, _slices(spark, d), lambda s, ck: each_batch(keep(s), sink, checkpoint=ck))
    return sink, lambda r: F.when(r == buy, "buy").otherwise("look")


@query("stream_dynamic_rules", f"""
    WITH {_IN_TIME}, q AS (SELECT *, {_SWITCH.format("buy", "look")} AS rule FROM events),
         k AS (SELECT *, count(rule) OVER v AS epoch, coalesce(last_value(rule IGNORE NULLS) OVER v, 'buy') AS cur FROM q WINDOW v AS (ORDER BY ts, event_id)),
         l AS (SELECT *, lead(event_id) OVER v AS id1, lead(event_type) OVER v AS t1, lead(ts) OVER v AS ts1 FROM k WHERE rule IS NULL WINDOW v AS (PARTITION BY user_id, epoch ORDER BY ts, event_id))
    SELECT user_id, epoch, cur AS rule_id, event_id AS x_id, id1 AS y_id FROM l
    WHERE ((cur = 'buy' AND event_type = 'click' AND t1 = 'purchase') OR (cur = 'look' AND event_type = 'view' AND t1 = 'click'))
      AND ts1 - ts < INTERVAL 6 HOUR AND ts1 <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""")
def stream_dynamic_rules(spark, d):
    sink, name = _rule_matcher(spark, d)
    return sink.matches().select("user_id", "epoch", name(c("rule_id")).alias("rule_id"), c("events")[0]["event"]["event_id"].alias("x_id"), c("events")[1]["event"]["event_id"].alias("y_id"))


@query("state_rules", f"""
    WITH {_IN_TIME}, q AS (SELECT *, {_SWITCH.format("buy", "look")} AS rule FROM events),
         r AS (SELECT row_number() OVER (ORDER BY ts, event_id) AS epoch, ts AS since, rule FROM q WHERE rule IS NOT NULL),
         m AS (SELECT slice, max(max(ts)) OVER (ORDER BY slice) - INTERVAL 1 HOUR AS mark FROM a GROUP BY slice)
    SELECT CAST(slice AS INTEGER) AS version, epoch, since, rule FROM r JOIN m ON since <= mark WHERE slice > 0""")
def state_rules(spark, d):
    """The rule table as it was after the second and after the third batch."""
    sink, name = _rule_matcher(spark, d)
    at = lambda k: sink.rules_at(k).select(F.lit(k).alias("version"), "epoch", *ntz("since"), name(c("rule")).alias("rule"))
    return at(1).unionAll(at(2))


# State as tables

@query("state_windows", f"""
    SELECT event_type, time_bucket(INTERVAL 6 HOUR, ts) AS window_start, count(*) AS n FROM events
    GROUP BY 1, 2 HAVING time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR > {_CLOSED}""")
def state_windows(spark, d):
    ck = work_dir(spark, "ckpt")
    timed(spark, d, lambda ev: ev.groupBy(F.window("ts", "6 hours"), "event_type").agg(F.count(F.lit(1)).alias("n")), checkpoint=ck)
    s = ST.window_state(spark, ck)
    return s.select("event_type", *ntz("window_start"), c("count").alias("n"))


@query("state_keyed", "SELECT user_id, count(*) AS n FROM events GROUP BY user_id")
def state_keyed(spark, d):
    ev = stream_table(spark, path(d))
    ck = work_dir(spark, "ckpt")
    each_batch(ev.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")), _drop, "update", ck)
    return ST.keyed_state(spark, ck).select("user_id", c("count").alias("n"))


@query("state_metadata", "SELECT 0 AS \"operatorId\", 'stateStoreSave' AS \"operatorName\", count(DISTINCT user_id) > 0 AS has_rows FROM events")
def state_metadata(spark, d):
    ev = stream_table(spark, path(d))
    ck = work_dir(spark, "ckpt")
    each_batch(ev.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")), _drop, "update", ck)
    rows = ST.read_state(spark, ck).agg((F.count(F.lit(1)) > 0).alias("has_rows"))
    ops = ST.operators(spark, ck).select(c("operatorId").cast("int").alias("operatorId"), "operatorName")
    return ops.crossJoin(rows)


@query("state_bootstrap", "SELECT user_id, count(*) AS n FROM events WHERE event_type <> 'error' GROUP BY user_id")
def state_bootstrap(spark, d):
    """State from the rows before a time, then continued with the rest."""
    ev = load(spark, d, "events").where("event_type <> 'error'").select("user_id", "ts")
    build = lambda s: s.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    lo, hi = ev.agg(F.min("ts"), F.max("ts")).first()
    old = F.coalesce(c("ts") < F.lit(lo + (hi - lo) / 2), F.lit(True)) if lo else F.lit(True)
    home = ST.bootstrap(ev.where(old), build, sink=_drop)
    ev.where(~old).write.mode("append").parquet(f"{home}/source")
    ST.feed(spark, home, build, sink=_drop)
    return ST.keyed_state(spark, f"{home}/checkpoint").select("user_id", c("count").alias("n"))


def _drop(batch, batch_id):
    batch.write.format("noop").mode("append").save()


# List, map and value state, timers, windows as elements

_LAST = """SELECT user_id, count(*) AS n, epoch_us(max(ts)) // 1000 + 6 * 3600 * 1000 AS due FROM events GROUP BY user_id"""


def _purse():
    """Per user: purchases as a list, counts and greatest value per event type as a map, all events as a value; a timer six hours after the last event."""
    count = lambda old, row: ((old[0] if old else 0) + 1,)
    best = lambda old, row: ((old[0] if old else 0) + 1, max(old[1], row["value"]) if old else row["value"])
    return K.KeyedProcessor(
        [K.Items("bought", "event_id bigint", lambda row: (row["event_id"],) if row["event_type"] == "purchase" else None),
         K.Entries("types", "event_type string", "n bigint, top double", lambda row: (row["event_type"],), best), K.Value("total", "n bigint", count)],
        timer=lambda row: row["ms"] + 6 * 3600 * 1000, on_timer=lambda key, state, at: [(key[0], at)])


def _kept(spark, d, initial=None, where=None):
    """The checkpoint of the processor over the events, and what its timers emitted."""
    ck = work_dir(spark, "ckpt")
    rows = lambda s: K.process(s.withColumn("ms", F.unix_millis("ts")), ["user_id"], _purse(), "user_id bigint, due bigint", initial)
    ev = load_events(spark, d).select("event_id", "user_id", "event_type", "value", "ts")
    with K.list_state_store(spark):
        fired = replay(ev if where is None else ev.where(where), "ts", lambda s: rows(s.withWatermark("ts", "1 hour")), checkpoint=ck)
    return ck, fired


@query("state_list", "SELECT user_id, event_id FROM events WHERE event_type = 'purchase'")
def state_list(spark, d):
    ck, _ = _kept(spark, d)
    return ST.read_state(spark, ck, variable="bought").select("key.user_id", "list_element.event_id")


@query("state_map", "SELECT user_id, event_type, count(*) AS n, max(value) AS top FROM events GROUP BY 1, 2")
def state_map(spark, d):
    ck, _ = _kept(spark, d)
    return ST.read_state(spark, ck, variable="types").select("key.user_id", "user_map_key.event_type", "user_map_value.*")


@query("state_timers", f"SELECT user_id, due, CASE WHEN due > epoch_ms({_CLOSED}) THEN 'registered' ELSE 'fired' END AS state FROM ({_LAST})")
def state_timers(spark, d):
    """The timer of each user: registered, or the last one that fired."""
    ck, fired = _kept(spark, d)
    waiting = ST.read_state(spark, ck, timers=True).select("key.user_id", c("expiration_timestamp_ms").alias("due"), F.lit("registered").alias("state"))
    done = fired.groupBy("user_id").agg(F.max("due").alias("due")).join(waiting, "user_id", "left_anti")
    return waiting.unionAll(done.select("user_id", "due", F.lit("fired")))


@query("state_bootstrap_timers", f"""
    SELECT l.user_id, l.n, list_count, CASE WHEN due > epoch_ms({_CLOSED}) THEN due END AS due FROM ({_LAST}) l
    JOIN (SELECT user_id, count(*) FILTER (event_type = 'purchase') AS list_count FROM events GROUP BY 1) USING (user_id)""")
def state_bootstrap_timers(spark, d):
    """Value, list, map and timers of the first half as a table; the stream goes on from there."""
    ev = load_events(spark, d)
    lo, hi = ev.agg(F.min("ts"), F.max("ts")).first()
    old = F.coalesce(c("ts") < F.lit(lo + (hi - lo) / 2), F.lit(True)) if lo else F.lit(True)
    types = ev.where(old).groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("top"))
    types = types.groupBy("user_id").agg(F.collect_list(F.struct(F.struct("event_type").alias("k"), F.struct("n", "top").alias("v"))).alias("types"))
    first = ev.where(old).groupBy("user_id").agg(
        F.struct(F.count(F.lit(1)).alias("n")).alias("total"), F.collect_list(F.when(c("event_type") == "purchase", F.struct("event_id"))).alias("bought"),
        (F.unix_millis(F.max("ts")) + 6 * 3600 * 1000).alias("timer"))
    ck, _ = _kept(spark, d, first.join(types, "user_id"), ~old)
    total = ST.read_state(spark, ck, variable="total").select("key.user_id", "value.n")
    bought = ST.read_state(spark, ck, variable="bought").groupBy("key.user_id").agg(F.count(F.lit(1)).alias("list_count"))
    at = ST.read_state(spark, ck, timers=True).select("key.user_id", c("expiration_timestamp_ms").alias("due"))
    return total.join(bought, "user_id", "left").join(at, "user_id", "left").select("user_id", "n", F.coalesce("list_count", F.lit(0)).alias("list_count"), "due")


_PANES = """p AS (SELECT user_id, event_id, time_bucket(INTERVAL 1 DAY, ts) AS window_start, (row_number() OVER (PARTITION BY user_id, time_bucket(INTERVAL 1 DAY, ts) ORDER BY ts, event_id) - 1) // 3 AS pane FROM events),
    q AS (SELECT user_id, window_start, pane, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM p GROUP BY ALL)"""


def _panes(spark, d):
    """Days of a user as elements, fired by every third."""
    ck = work_dir(spark, "ckpt")
    sums = lambda key, pane, rows: [(key[0], key[1], pane, len(rows), sum(r["event_id"] for r in rows))]
    schema = "user_id bigint, window_start timestamp, pane bigint, n bigint, ids bigint"

    def build(s):
        rows, key = K.in_windows(s.withWatermark("ts", "1 hour"), W.tumble("ts", "1 day"), ["user_id"])
        return K.process(rows, key, K.WindowElements(["event_id"], "event_id bigint", ["ts", "event_id"], sums, count=3), schema)

    with K.list_state_store(spark):
        out = replay(load_events(spark, d).select("event_id", "user_id", "ts"), "ts", build, checkpoint=ck)
    return ck, out


@query("stream_trigger_count", f"WITH {_PANES} SELECT * FROM q WHERE n = 3 OR window_start + INTERVAL 1 DAY <= {_CLOSED}")
def stream_trigger_count(spark, d):
    _, out = _panes(spark, d)
    return out.select("user_id", *ntz("window_start"), "pane", "n", "ids")


@query("state_window_elements", f"WITH {_PANES} SELECT user_id, window_start, event_id FROM p JOIN q USING (user_id, window_start, pane) WHERE n < 3 AND window_start + INTERVAL 1 DAY > {_CLOSED}")
def state_window_elements(spark, d):
    """Elements of the windows that are still open."""
    ck, _ = _panes(spark, d)
    s = ST.read_state(spark, ck, variable="elements")
    return s.select("key.user_id", F.timestamp_micros("list_element.window_start").cast("timestamp_ntz").alias("window_start"), "list_element.event_id")


@query("state_changes", f"""
    WITH {_SLICES}, t AS (SELECT user_id, k AS batch, count(*) AS n FROM a JOIN (SELECT unnest([0, 1, 2]) AS k) ON a.slice <= k GROUP BY 1, 2)
    SELECT CAST(batch AS BIGINT) AS batch, user_id, n FROM t WHERE batch > 0 AND EXISTS (SELECT 1 FROM a WHERE a.user_id = t.user_id AND a.slice = t.batch)""")
def state_changes(spark, d):
    """The change feed of the state from the second batch on."""
    counts = lambda s: s.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    ck = run_slices(spark, _slices(spark, d), lambda s, k: each_batch(counts(s), _drop, "update", k))
    return ST.read_state(spark, ck, changes_from=1).select(c("batch_id").alias("batch"), "key.user_id", c("value.count").alias("n"))
