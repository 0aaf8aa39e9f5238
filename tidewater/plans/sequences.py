"""Sequence patterns over ``events``, per user unless noted."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from tidewater.operators import sequence as S
from tidewater.operators.pattern import Running, Skip, begin, match
from tidewater.operators.pattern import recognize as M
from tidewater.operators.pattern.rules import match_rules
from tidewater.operators.pattern.runs import runs
from tidewater.plans.registry import query
from tidewater.session import load

c = F.col
HOUR, DAY = timedelta(hours=1), timedelta(days=1)


def kind(x: str) -> str:
    return f"event_type = '{x}'"


def events(spark, d, *extra):
    return load(spark, d, "events").select("event_id", "user_id", "event_type", "ts", *extra)


def find(df, pattern, payload=("event_id",), **kw):
    return match(df, pattern, ["user_id"], "ts", ["event_id"], list(payload), **kw)


def first_id(step: str):
    return c(step)[0]["event_id"].alias(f"{step}_id")


_LEADS = """SELECT user_id, event_id, event_type, value, ts, lead(event_id) OVER w AS id1, lead(event_type) OVER w AS t1, lead(value) OVER w AS v1, lead(ts) OVER w AS ts1,
    lead(event_id, 2) OVER w AS id2, lead(event_type, 2) OVER w AS t2, lead(value, 2) OVER w AS v2, lead(ts, 2) OVER w AS ts2,
    lead(event_id, 3) OVER w AS id3, lead(event_type, 3) OVER w AS t3 FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"""
_KIND = "(SELECT user_id, ts, event_id FROM events WHERE event_type = '{}')"
CLICK, VIEW, BUY, ERR = (_KIND.format(k) for k in ("click", "view", "purchase", "error"))
_CLICK_VIEW_BUY = f"""SELECT a.user_id, a.event_id AS a_id, b.event_id AS b_id, p.event_id AS c_id, a.ts AS t0, p.ts AS t2
    FROM {CLICK} a ASOF JOIN {VIEW} b ON a.user_id = b.user_id AND a.ts < b.ts ASOF JOIN {BUY} p ON b.user_id = p.user_id AND b.ts < p.ts"""
CVB = begin("a").where(kind("click")).followed_by("b").where(kind("view")).followed_by("c").where(kind("purchase"))


@query("cep_strict", f"""
    SELECT user_id, event_id AS a_id, id1 AS b_id, id2 AS c_id, ts AS start_ts, ts2 AS end_ts FROM ({_LEADS})
    WHERE event_type = 'click' AND t1 = 'click' AND t2 = 'purchase'""")
def cep_strict(spark, d):
    p = begin("a").where(kind("click")).next("b").where(kind("click")).next("c").where(kind("purchase"))
    return find(events(spark, d), p).select("user_id", first_id("a"), first_id("b"), first_id("c"), "start_ts", "end_ts")


@query("cep_followed_by", f"SELECT user_id, a_id, b_id, c_id FROM ({_CLICK_VIEW_BUY})")
def cep_followed_by(spark, d):
    return find(events(spark, d), CVB).select("user_id", first_id("a"), first_id("b"), first_id("c"))


@query("cep_within", f"SELECT user_id, a_id, b_id, c_id FROM ({_CLICK_VIEW_BUY}) WHERE t2 - t0 < INTERVAL 18 HOUR")
def cep_within(spark, d):
    return find(events(spark, d), CVB.within(18 * HOUR)).select("user_id", first_id("a"), first_id("b"), first_id("c"))


@query("cep_followed_by_any", f"""
    SELECT a.user_id, a.event_id AS a_id, b.event_id AS b_id FROM {CLICK} a JOIN {BUY} b ON a.user_id = b.user_id AND b.ts > a.ts AND b.ts - a.ts < INTERVAL 6 HOUR""")
def cep_followed_by_any(spark, d):
    p = begin("a").where(kind("click")).followed_by_any("b").where(kind("purchase")).within(6 * HOUR)
    return find(events(spark, d), p).select("user_id", first_id("a"), first_id("b"))


@query("cep_not_next", f"""
    SELECT a.user_id, a.event_id AS a_id, b.event_id AS b_id FROM (SELECT * FROM ({_LEADS}) WHERE event_type = 'click' AND t1 <> 'error') a
    ASOF JOIN {BUY} b ON a.user_id = b.user_id AND a.ts < b.ts""")
def cep_not_next(spark, d):
    p = begin("a").where(kind("click")).not_next("n").where(kind("error")).followed_by("b").where(kind("purchase"))
    return find(events(spark, d), p).select("user_id", first_id("a"), first_id("b"))


@query("cep_not_followed_by", f"""
    SELECT a.user_id, a.event_id AS a_id, b.event_id AS b_id FROM {CLICK} a ASOF JOIN {BUY} b ON a.user_id = b.user_id AND a.ts < b.ts
    ASOF LEFT JOIN {ERR} e ON a.user_id = e.user_id AND a.ts < e.ts WHERE e.ts IS NULL OR e.ts > b.ts""")
def cep_not_followed_by(spark, d):
    p = begin("a").where(kind("click")).not_followed_by("n").where(kind("error")).followed_by("b").where(kind("purchase"))
    return find(events(spark, d), p).select("user_id", first_id("a"), first_id("b"))


@query("cep_times_consecutive", f"""
    SELECT user_id, event_id AS first_id, 2 AS n, id2 AS b_id FROM ({_LEADS}) WHERE event_type = 'error' AND t1 = 'error' AND t2 = 'purchase'
    UNION ALL SELECT user_id, event_id, 3, id3 FROM ({_LEADS}) WHERE event_type = 'error' AND t1 = 'error' AND t2 = 'error' AND t3 = 'purchase'""")
def cep_times_consecutive(spark, d):
    p = begin("a").where(kind("error")).times(2, 3).consecutive().next("b").where(kind("purchase"))
    return find(events(spark, d), p).select("user_id", c("a")[0]["event_id"].alias("first_id"), F.size("a").alias("n"), first_id("b"))


@query("cep_optional", f"""
    SELECT user_id, event_id AS a_id, id1 AS b_id, id2 AS c_id FROM ({_LEADS}) WHERE event_type = 'click' AND t1 = 'view' AND t2 = 'purchase'
    UNION ALL SELECT user_id, event_id, NULL, id1 FROM ({_LEADS}) WHERE event_type = 'click' AND t1 = 'purchase'""")
def cep_optional(spark, d):
    p = begin("a").where(kind("click")).next("b").where(kind("view")).optional().next("c").where(kind("purchase"))
    return find(events(spark, d), p).select("user_id", first_id("a"), c("b")[0]["event_id"].alias("b_id"), first_id("c"))


@query("cep_subtype_or", f"""
    SELECT user_id, event_id AS a_id, id1 AS b_id FROM ({_LEADS}) WHERE event_type = 'view' AND (t1 = 'click' OR t1 = 'purchase') AND v1 > 50""")
def cep_subtype_or(spark, d):
    p = begin("a").subtype("view", "event_type").next("b").where(kind("click")).or_(kind("purchase")).where("value > 50")
    return find(events(spark, d, "value"), p).select("user_id", first_id("a"), first_id("b"))


@query("cep_one_or_more", f"""
    SELECT x.user_id, x.event_id AS first_id, y.event_id AS last_id, p.event_id AS b_id,
           (SELECT count(*) FROM {CLICK} z WHERE z.user_id = x.user_id AND z.ts BETWEEN x.ts AND y.ts) AS n
    FROM {CLICK} x JOIN {CLICK} y ON x.user_id = y.user_id AND y.ts >= x.ts ASOF JOIN {BUY} p ON y.user_id = p.user_id AND y.ts < p.ts
    WHERE p.ts - x.ts < INTERVAL 12 HOUR""")
def cep_one_or_more(spark, d):
    p = begin("a").where(kind("click")).one_or_more().followed_by("b").where(kind("purchase")).within(12 * HOUR)
    return find(events(spark, d), p).select(
        "user_id", c("a")[0]["event_id"].alias("first_id"), F.element_at("a", -1)["event_id"].alias("last_id"), first_id("b"),
        F.size("a").cast("bigint").alias("n"))


@query("cep_until", f"""
    SELECT x.user_id, x.event_id AS first_id, y.event_id AS last_id, p.event_id AS b_id
    FROM {CLICK} x JOIN {CLICK} y ON x.user_id = y.user_id AND y.ts >= x.ts ASOF JOIN {BUY} p ON y.user_id = p.user_id AND y.ts < p.ts
    WHERE p.ts - x.ts < INTERVAL 12 HOUR AND NOT EXISTS (SELECT 1 FROM {ERR} e WHERE e.user_id = x.user_id AND e.ts > x.ts AND e.ts < y.ts)""")
def cep_until(spark, d):
    p = begin("a").where(kind("click")).one_or_more().until(kind("error")).followed_by("b").where(kind("purchase")).within(12 * HOUR)
    return find(events(spark, d), p).select(
        "user_id", c("a")[0]["event_id"].alias("first_id"), F.element_at("a", -1)["event_id"].alias("last_id"), first_id("b"))


@query("cep_one_or_more_greedy", """
    WITH o AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS g FROM events)
    SELECT user_id, event_type AS label, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts, round(sum(value), 4) AS total
    FROM o GROUP BY user_id, event_type, g HAVING count(*) >= 2""")
def cep_one_or_more_greedy(spark, d):
    ev = events(spark, d, "value")
    r = runs(ev, ["user_id"], "ts", ["event_id"], c("event_type"), [F.round(F.sum("value"), 4).alias("total")])
    return r.where("n >= 2").select("user_id", "label", "n", "first_ts", "last_ts", "total")


@query("cep_run_then_next", """
    WITH o AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS g FROM events),
         q AS (SELECT user_id, event_type, min(r) AS lo, max(r) AS hi, count(*) AS n FROM o GROUP BY user_id, event_type, g)
    SELECT x.user_id, x.n AS views, y.n AS buys, x.lo AS first_pos FROM q x JOIN q y ON x.user_id = y.user_id AND y.lo = x.hi + 1
    WHERE x.event_type = 'view' AND x.n >= 2 AND y.event_type = 'purchase'""")
def cep_run_then_next(spark, d):
    ev = events(spark, d)
    width = S.sequence(ev, ("user_id",), "ts", ("event_id",)).width
    r = runs(ev, ["user_id"], "ts", ["event_id"], c("event_type"), width=width)
    p = begin("v").where("label = 'view' AND n >= 2").next("b").where("label = 'purchase'")
    m = match(r, p, ["user_id"], "first_ts", ["run_id"], ["n", "first_ts"], width=width)
    # Positions of the runs' first events: events before them in earlier runs.
    upto = S.running(r, S.sequence(r, ("user_id",), "first_ts", ("run_id",), width), {"upto": ("sum", c("n"))})
    at = S.unchunked(upto).select("user_id", c("first_ts").alias("start_ts"), (c("upto") - c("n") + 1).alias("first_pos"))
    return m.join(at, ["user_id", "start_ts"]).select(
        "user_id", c("v")[0]["n"].alias("views"), c("b")[0]["n"].alias("buys"), "first_pos")


@query("cep_group", f"""
    WITH cv AS (SELECT user_id, event_id AS c, ts, id1 AS v, ts1 FROM ({_LEADS}) WHERE event_type = 'click' AND t1 = 'view')
    SELECT x.user_id, x.c AS c1, x.v AS v1, y.c AS c2, y.v AS v2, p.event_id AS b_id
    FROM cv x ASOF JOIN {CLICK} k ON x.user_id = k.user_id AND x.ts1 < k.ts JOIN cv y ON y.c = k.event_id ASOF JOIN {BUY} p ON y.user_id = p.user_id AND y.ts1 < p.ts""")
def cep_group(spark, d):
    pair = begin("c").where(kind("click")).next("v").where(kind("view"))
    p = begin(pair).times(2).followed_by("b").where(kind("purchase"))
    e = lambda s, i: c(s)[i]["event_id"]
    return find(events(spark, d), p).select(
        "user_id", e("c", 0).alias("c1"), e("v", 0).alias("v1"), e("c", 1).alias("c2"), e("v", 1).alias("v2"), first_id("b"))


# Skip strategies

def _greedy_chain(matches: str, after: str) -> str:
    """Recursive SQL: repeatedly take the first match that starts late enough."""
    return f"""WITH RECURSIVE m AS ({matches}),
      r AS (SELECT user_id, arg_min(a_id, t0) AS a_id FROM m GROUP BY user_id
            UNION ALL SELECT n.user_id, arg_min(n.a_id, n.t0) FROM r JOIN m o ON o.a_id = r.a_id JOIN m n ON n.user_id = o.user_id AND {after} GROUP BY n.user_id)
      """


_CLICK_BUY_DAY = f"""SELECT a.user_id, a.event_id AS a_id, a.ts AS t0, b.event_id AS b_id, b.ts AS t1 FROM {CLICK} a
    ASOF JOIN {BUY} b ON a.user_id = b.user_id AND a.ts < b.ts WHERE b.ts - a.ts < INTERVAL 1 DAY"""
CLICK_BUY_DAY = begin("a").where(kind("click")).followed_by("b").where(kind("purchase")).within(DAY)
_TWO_CLICKS_BUY = f"""SELECT x.user_id, x.event_id AS a_id, x.ts AS t0, y.event_id AS y_id, y.ts AS ty, b.event_id AS b_id, b.ts AS t1
    FROM {CLICK} x ASOF JOIN {CLICK} y ON x.user_id = y.user_id AND x.ts < y.ts ASOF JOIN {BUY} b ON y.user_id = b.user_id AND y.ts < b.ts
    WHERE b.ts - x.ts < INTERVAL 2 DAY"""
TWO_CLICKS_BUY = begin("a").where(kind("click")).times(2).followed_by("b").where(kind("purchase")).within(2 * DAY)


@query("cep_skip_next", f"""
    SELECT user_id, a_id, b_id FROM (SELECT a.user_id, a.event_id AS a_id, b.event_id AS b_id, row_number() OVER (PARTITION BY a.event_id ORDER BY b.ts) AS rn
      FROM {CLICK} a JOIN {BUY} b ON a.user_id = b.user_id AND b.ts > a.ts AND b.ts - a.ts < INTERVAL 6 HOUR) WHERE rn = 1""")
def cep_skip_next(spark, d):
    p = begin("a", Skip("next")).where(kind("click")).followed_by_any("b").where(kind("purchase")).within(6 * HOUR)
    return find(events(spark, d), p).select("user_id", first_id("a"), first_id("b"))


@query("cep_skip_past_last", _greedy_chain(_CLICK_BUY_DAY, "n.t0 > o.t1") + "SELECT m.user_id, m.a_id, m.b_id FROM r JOIN m USING (a_id)")
def cep_skip_past_last(spark, d):
    return find(events(spark, d), CLICK_BUY_DAY.after_match(Skip("past_last"))).select("user_id", first_id("a"), first_id("b"))


@query("cep_skip_to_first", _greedy_chain(_TWO_CLICKS_BUY, "n.t0 >= o.t1") + "SELECT m.user_id, m.a_id, m.b_id FROM r JOIN m USING (a_id)")
def cep_skip_to_first(spark, d):
    return find(events(spark, d), TWO_CLICKS_BUY.after_match(Skip("to_first", "b"))).select("user_id", first_id("a"), first_id("b"))


@query("cep_skip_to_last", _greedy_chain(_TWO_CLICKS_BUY, "n.t0 >= o.ty") + "SELECT m.user_id, m.a_id, m.y_id, m.b_id FROM r JOIN m USING (a_id)")
def cep_skip_to_last(spark, d):
    m = find(events(spark, d), TWO_CLICKS_BUY.after_match(Skip("to_last", "a")))
    return m.select("user_id", first_id("a"), c("a")[1]["event_id"].alias("y_id"), first_id("b"))


# Iterative conditions, timeouts, rules, global

@query("cep_iterative_sum", _greedy_chain(
    f"SELECT user_id, event_id AS a_id, id1 AS x_id, id2 AS b_id, ts AS t0, ts2 AS t1 FROM ({_LEADS}) WHERE value > 10 AND v1 > 10 AND value + v1 + v2 > 60", "n.t0 > o.t1")
    + "SELECT m.user_id, m.a_id, m.x_id, m.b_id FROM r JOIN m USING (a_id)")
def cep_iterative_sum(spark, d):
    p = begin("a", Skip("past_last")).where("value > 10").times(2).consecutive().next("b").where(Running("a", "value", ">", 60))
    return find(events(spark, d, "value"), p, ("event_id", "value")).select(
        "user_id", first_id("a"), c("a")[1]["event_id"].alias("x_id"), first_id("b"))


@query("cep_timeout", f"""
    SELECT a.user_id, a.event_id AS a_id, CASE WHEN b.ts - a.ts < INTERVAL 4 HOUR THEN 'match' ELSE 'timeout' END AS kind,
           CASE WHEN b.ts - a.ts < INTERVAL 4 HOUR THEN b.event_id END AS b_id, CASE WHEN b.ts - a.ts < INTERVAL 4 HOUR THEN NULL ELSE a.ts + INTERVAL 4 HOUR END AS timeout_ts
    FROM {CLICK} a ASOF LEFT JOIN {BUY} b ON a.user_id = b.user_id AND a.ts < b.ts
    WHERE coalesce(b.ts - a.ts < INTERVAL 4 HOUR, FALSE) OR a.ts + INTERVAL 4 HOUR <= (SELECT max(ts) FROM events)""")
def cep_timeout(spark, d):
    p = begin("a").where(kind("click")).followed_by("b").where(kind("purchase")).within(4 * HOUR)
    return find(events(spark, d), p, timeouts=True).select(
        "user_id", first_id("a"), "kind", c("b")[0]["event_id"].alias("b_id"), c("timeout_ts").cast("timestamp_ntz").alias("timeout_ts"))


_RULE = "CASE WHEN event_type = 'signup' AND value > 90 THEN 'buy' WHEN event_type = 'signup' AND value > 80 THEN 'look' END"
RULES = {
    "buy": begin("x").where(kind("click")).next("y").where(kind("purchase")),
    "look": begin("x").where(kind("view")).next("y").where(kind("click")),
}


@query("cep_dynamic_rules", f"""
    WITH e AS (SELECT *, {_RULE} AS rule FROM events),
         k AS (SELECT *, count(rule) OVER w AS epoch, coalesce(last_value(rule IGNORE NULLS) OVER w, 'buy') AS cur FROM e WINDOW w AS (ORDER BY ts, event_id)),
         l AS (SELECT user_id, epoch, cur, event_id, event_type, lead(event_id) OVER v AS id1, lead(event_type) OVER v AS t1 FROM k WHERE rule IS NULL WINDOW v AS (PARTITION BY user_id, epoch ORDER BY ts, event_id))
    SELECT user_id, epoch, cur AS rule_id, event_id AS x_id, id1 AS y_id FROM l
    WHERE (cur = 'buy' AND event_type = 'click' AND t1 = 'purchase') OR (cur = 'look' AND event_type = 'view' AND t1 = 'click')""")
def cep_dynamic_rules(spark, d):
    rules = {k: p.to_json() for k, p in RULES.items()}
    m = match_rules(events(spark, d, "value"), rules, F.expr(_RULE), ["user_id"], "ts", ["event_id"], ["event_id"], first_rule="buy")
    return m.select("user_id", "epoch", "rule_id", c("events")[0]["event"]["event_id"].alias("x_id"), c("events")[1]["event"]["event_id"].alias("y_id"))


@query("cep_global_chunked", """
    SELECT event_id AS a_id, id1 AS b_id FROM (SELECT event_id, event_type, lead(event_id) OVER w AS id1, lead(event_type) OVER w AS t1, lead(event_type, 2) OVER w AS t2, lead(ts, 2) OVER w - ts AS span
      FROM events WINDOW w AS (ORDER BY ts, event_id)) WHERE event_type = 'click' AND t1 = 'click' AND t2 = 'click' AND span < INTERVAL 30 MINUTE""")
def cep_global_chunked(spark, d):
    p = begin("a").where(kind("click")).next("b").where(kind("click")).next("c").where(kind("click")).within(timedelta(minutes=30))
    m = match(events(spark, d), p, [], "ts", ["event_id"], ["event_id"])
    return m.select(first_id("a"), first_id("b"))


@query("cep_tied_times", """
    WITH h AS (SELECT user_id, event_id, event_type, date_trunc('hour', ts) AS ts FROM events),
         l AS (SELECT *, lead(event_id) OVER w AS id1, lead(event_type) OVER w AS t1, lead(ts) OVER w AS ts1 FROM h WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    SELECT user_id, event_id AS a_id, id1 AS b_id, ts = ts1 AS tied FROM l WHERE event_type = 'click' AND t1 = 'view'""")
def cep_tied_times(spark, d):
    """All events of an hour have one time; the tie column orders them."""
    ev = events(spark, d).withColumn("ts", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    p = begin("a").where(kind("click")).next("b").where(kind("view"))
    return find(ev, p).select("user_id", first_id("a"), first_id("b"), (c("start_ts") == c("end_ts")).alias("tied"))


# MATCH_RECOGNIZE

@query("mr_v_shape", """
    WITH o AS (SELECT user_id, event_id, ts, value, row_number() OVER w AS r, CASE WHEN value < lag(value) OVER w THEN 'D' WHEN value > lag(value) OVER w THEN 'U' ELSE 'N' END AS k FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
         g AS (SELECT *, r - row_number() OVER (PARTITION BY user_id, k ORDER BY r) AS g FROM o),
         q AS (SELECT *, max(r) OVER (PARTITION BY user_id, k, g) AS run_end FROM g),
         s AS (SELECT a.user_id, a.event_id, a.ts, a.r, b.run_end AS e1 FROM q a JOIN q b ON b.user_id = a.user_id AND b.r = a.r + 1 AND b.k = 'D')
    SELECT s.user_id, s.event_id AS strt_id, max(u.r) - s.r + 1 AS n, CAST(s.e1 - s.r AS BIGINT) AS downs, arg_max(u.event_id, u.r) AS last_id
    FROM s JOIN q f ON f.user_id = s.user_id AND f.r = s.e1 + 1 AND f.k = 'U' JOIN q u ON u.user_id = s.user_id AND u.r BETWEEN f.r AND f.run_end AND u.ts < s.ts + INTERVAL 2 DAY
    GROUP BY s.user_id, s.event_id, s.r, s.e1""")
def mr_v_shape(spark, d):
    m = M.match_recognize(
        events(spark, d, "value"), ["user_id"], "ts", M.seq("STRT", M.var("DOWN").plus(), M.var("UP").plus()),
        {"DOWN": "value < prev_value", "UP": "value > prev_value"},
        {"strt_id": M.first_of("STRT", "event_id"), "n": "CAST(size(ALL_ROWS) AS BIGINT)", "downs": "CAST(size(DOWN) AS BIGINT)", "last_id": M.last_of("UP", "event_id")},
        tie=["event_id"], navigate={"prev_value": ("value", 1)}, after_match=Skip("next"), within=2 * DAY,
        subset={"ALL_ROWS": ["STRT", "DOWN", "UP"]}, payload=["event_id"])
    return m.select("user_id", "strt_id", "n", "downs", "last_id")


@query("mr_v_unbounded", """
    WITH o AS (SELECT user_id, event_id, ts, value, row_number() OVER w AS r, CASE WHEN value < lag(value) OVER w THEN 'D' WHEN value > lag(value) OVER w THEN 'U' ELSE 'N' END AS k FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
         g AS (SELECT *, r - row_number() OVER (PARTITION BY user_id, k ORDER BY r) AS g FROM o),
         q AS (SELECT *, max(r) OVER (PARTITION BY user_id, k, g) AS run_end FROM g),
         s AS (SELECT a.user_id, a.event_id, a.r, b.run_end AS e1 FROM q a JOIN q b ON b.user_id = a.user_id AND b.r = a.r + 1 AND b.k = 'D')
    SELECT s.user_id, s.event_id AS strt_id, f.run_end - s.r + 1 AS n, CAST(s.e1 - s.r AS BIGINT) AS downs, u.event_id AS last_id
    FROM s JOIN q f ON f.user_id = s.user_id AND f.r = s.e1 + 1 AND f.k = 'U' JOIN q u ON u.user_id = s.user_id AND u.r = f.run_end""")
def mr_v_unbounded(spark, d):
    """Falls and rises of any length in rows and time."""
    m = M.match_recognize(
        events(spark, d, "value"), ["user_id"], "ts", M.seq("STRT", M.var("DOWN").plus(), M.var("UP").plus()),
        {"DOWN": "value < prev_value", "UP": "value > prev_value"},
        {"strt_id": M.first_of("STRT", "event_id"), "n": "CAST(size(ALL_ROWS) AS BIGINT)", "downs": "CAST(size(DOWN) AS BIGINT)", "last_id": M.last_of("UP", "event_id")},
        tie=["event_id"], navigate={"prev_value": ("value", 1)}, after_match=Skip("next"),
        subset={"ALL_ROWS": ["STRT", "DOWN", "UP"]}, payload=["event_id"])
    return m.select("user_id", "strt_id", "n", "downs", "last_id")


_FIVE = ("click", "view", "purchase", "signup", "error")


@query("mr_permute_five", """
    SELECT user_id, event_id AS first_id FROM (SELECT user_id, event_id, list(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS l FROM events)
    WHERE len(list_distinct(l)) = 5""")
def mr_permute_five(spark, d):
    """Five rows in a row, one of each kind, in any order."""
    first = "element_at(array_sort(concat(" + ", ".join(f"transform(V{i}, x -> struct(x.ts, x.event_id))" for i in range(5)) + ")), 1).event_id"
    m = M.match_recognize(
        events(spark, d), ["user_id"], "ts", M.permute(*[f"V{i}" for i in range(5)]), {f"V{i}": f"event_type = '{k}'" for i, k in enumerate(_FIVE)},
        {"first_id": first}, tie=["event_id"], after_match=Skip("next"), payload=["event_id"])
    return m.select("user_id", "first_id")


@query("mr_all_rows", f"""
    WITH m AS (SELECT user_id, ts, event_id AS i0, CASE WHEN t1 = 'view' THEN id1 END AS i1, CASE WHEN t1 = 'view' THEN id2 ELSE id1 END AS i2 FROM ({_LEADS})
               WHERE event_type = 'click' AND ((t1 = 'view' AND t2 = 'purchase') OR t1 = 'purchase')),
         n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, i0) AS mn FROM m)
    SELECT user_id, mn AS match_number, 'A' AS classifier, i0 AS event_id, 1 AS seen, i2 AS last_id FROM n
    UNION ALL SELECT user_id, mn, 'B', i1, 2, i2 FROM n WHERE i1 IS NOT NULL
    UNION ALL SELECT user_id, mn, 'C', i2, CASE WHEN i1 IS NULL THEN 2 ELSE 3 END, i2 FROM n""")
def mr_all_rows(spark, d):
    m = M.match_recognize(
        events(spark, d), ["user_id"], "ts", M.seq("A", M.var("B").opt(), "C"),
        {"A": kind("click"), "B": kind("view"), "C": kind("purchase")}, {"seen": "size(A) + size(B) + size(C)"},
        tie=["event_id"], rows_per_match="all", after_match=Skip("next"), final={"last_id": M.last_of("C", "event_id")}, payload=["event_id"])
    return m.select("user_id", "match_number", "classifier", "event_id", "seen", "last_id")


@query("mr_alternation", _greedy_chain(
    f"""SELECT user_id, event_id AS a_id, ts AS t0, CASE WHEN t1 = 'view' THEN 'B' ELSE 'C' END AS took, CASE WHEN t1 = 'view' THEN ts1 WHEN t2 = 'click' THEN ts2 END AS t1 FROM ({_LEADS})
        WHERE event_type = 'click' AND (t1 = 'view' OR (t1 = 'error' AND t2 = 'click'))""", "n.t0 > o.t1")
    + "SELECT m.user_id, m.a_id, m.took, m.t1 AS end_ts FROM r JOIN m USING (a_id)")
def mr_alternation(spark, d):
    m = M.match_recognize(
        events(spark, d), ["user_id"], "ts", M.seq("A", M.alt("B", M.seq("C", "D"))),
        {"A": kind("click"), "B": kind("view"), "C": kind("error"), "D": kind("click")},
        {"a_id": M.first_of("A", "event_id"), "took": "CASE WHEN size(B) > 0 THEN 'B' ELSE 'C' END",
         "end_ts": f"coalesce({M.last_of('B', 'ts')}, {M.last_of('D', 'ts')})"},
        tie=["event_id"], after_match=Skip("past_last"), payload=["event_id"])
    return m.select("user_id", "a_id", "took", "end_ts")


@query("mr_permute", f"""
    SELECT user_id, event_id AS first_id, id2 AS last_id FROM ({_LEADS})
    WHERE event_type IN ('click', 'view', 'purchase') AND t1 IN ('click', 'view', 'purchase') AND t2 IN ('click', 'view', 'purchase') AND event_type <> t1 AND t1 <> t2 AND event_type <> t2""")
def mr_permute(spark, d):
    m = M.match_recognize(
        events(spark, d), ["user_id"], "ts", M.permute("A", "B", "C"),
        {"A": kind("click"), "B": kind("view"), "C": kind("purchase")},
        {"first_id": "array_min(array_sort(transform(ANY_ROW, x -> struct(x.ts, x.event_id)))).event_id", "last_id": "array_max(transform(ANY_ROW, x -> struct(x.ts, x.event_id))).event_id"},
        tie=["event_id"], after_match=Skip("next"), subset={"ANY_ROW": ["A", "B", "C"]}, payload=["event_id"])
    return m.select("user_id", "first_id", "last_id")


@query("mr_anchors_exclude", f"""
    WITH o AS (SELECT user_id, event_id, row_number() OVER w AS r, lead(event_id, 2) OVER w AS i2 FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    SELECT user_id, 'A' AS classifier, event_id FROM o WHERE r = 1 AND i2 IS NOT NULL UNION ALL SELECT user_id, 'C', i2 FROM o WHERE r = 1 AND i2 IS NOT NULL""")
def mr_anchors_exclude(spark, d):
    m = M.match_recognize(
        events(spark, d), ["user_id"], "ts", M.seq(M.AT_START, "A", M.exclude("B"), "C"), {}, {},
        tie=["event_id"], rows_per_match="all", payload=["event_id"])
    return m.select("user_id", "classifier", "event_id")


@query("mr_end_anchor", """
    WITH o AS (SELECT user_id, event_id, row_number() OVER w AS r, lead(event_id) OVER w AS before FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts DESC, event_id DESC))
    SELECT user_id, before AS a_id, event_id AS b_id FROM o WHERE r = 1 AND before IS NOT NULL""")
def mr_end_anchor(spark, d):
    m = M.match_recognize(
        events(spark, d), ["user_id"], "ts", M.seq("A", "B", M.AT_END), {}, {"a_id": M.first_of("A", "event_id"), "b_id": M.first_of("B", "event_id")},
        tie=["event_id"], payload=["event_id"])
    return m.select("user_id", "a_id", "b_id")


@query("mr_next_row", """
    SELECT user_id, event_id, round(after - value, 4) AS rise FROM (SELECT *, lead(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS after FROM events) WHERE after > value + 60""")
def mr_next_row(spark, d):
    m = M.match_recognize(
        events(spark, d, "value"), ["user_id"], "ts", M.var("A"), {"A": "after > value + 60"},
        {"event_id": M.first_of("A", "event_id"), "rise": f"round({M.first_of('A', 'after')} - {M.first_of('A', 'value')}, 4)"},
        tie=["event_id"], navigate={"after": ("value", -1)}, payload=["event_id", "value", "after"])
    return m.select("user_id", "event_id", "rise")


_FOUR_CLICKS = f"""SELECT user_id, event_id AS a_id, ts AS t0, ts2 AS t2, id3 AS d_id FROM ({_LEADS})
    WHERE event_type = 'click' AND t1 = 'click' AND t2 = 'click' AND t3 = 'click'"""


def _four_clicks(spark, d, skip):
    m = M.match_recognize(
        events(spark, d), ["user_id"], "ts", M.seq("A", "B", M.var("C").times(2)), dict.fromkeys("ABC", kind("click")),
        {"a_id": M.first_of("A", "event_id"), "d_id": M.last_of("C", "event_id")}, tie=["event_id"], after_match=skip, payload=["event_id"])
    return m.select("user_id", "a_id", "d_id")


@query("mr_skip_to_first", _greedy_chain(_FOUR_CLICKS, "n.t0 >= o.t2") + "SELECT m.user_id, m.a_id, m.d_id FROM r JOIN m USING (a_id)")
def mr_skip_to_first(spark, d):
    return _four_clicks(spark, d, Skip("to_first", "C"))


# The row after the first C is the last C.
@query("mr_skip_to_last", _greedy_chain(_FOUR_CLICKS, "n.t0 > o.t2") + "SELECT m.user_id, m.a_id, m.d_id FROM r JOIN m USING (a_id)")
def mr_skip_to_last(spark, d):
    return _four_clicks(spark, d, Skip("to_last", "C"))
