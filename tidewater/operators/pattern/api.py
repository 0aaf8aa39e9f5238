"""Find the matches of a pattern in a DataFrame of events."""

from __future__ import annotations

from collections.abc import Sequence as Seq
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators import sequence as S
from tidewater.operators.pattern import chain, skip as skips
from tidewater.operators.pattern.graph import END, START, Graph, build
from tidewater.operators.pattern.groups import match_groups
from tidewater.operators.pattern.local import Event, Machine, run_group
from tidewater.operators.pattern.spec import ANY, Pattern, PatternError

def match(
    df: DataFrame, pattern: Pattern, by: Seq[str], ts: str, tie: Seq[str] = (), payload: Seq[str] | None = None,
    width: timedelta | None = None, timeouts: bool = False, engine: str = "auto",
) -> DataFrame:
    """One row per match: the key, ``start_ts``, ``end_ts`` and one array of
    events per step (NULL where the step took none).

    ``tie`` orders events of one time and should make them distinct.
    ``payload`` lists the event columns to keep. With ``timeouts`` the partial
    matches that ran out of time come too: ``kind`` tells them apart and
    ``timeout_ts`` is the time they ran out.

    Patterns without loops and free skips run as window functions. Others run
    event by event in (key, time chunk) groups and need ``within``, which bounds
    the group; a pattern with neither has no bounded plan on a table and raises -
    run it with the stream matcher, which keeps its partial matches as state.
    """
    pattern.check()
    graph = build(pattern)
    result = find(df, pattern, graph, by, ts, tie, payload, width, timeouts, engine)
    return shape(result, graph, pattern, timeouts)


def find(df, pattern, graph, by, ts, tie, payload, width, timeouts, engine="auto") -> DataFrame:
    """Matches as ``items`` (slot, event), after the skip strategy."""
    cols = list(dict.fromkeys([ts, *tie, *(payload if payload is not None else [c for c in df.columns if c not in by])]))
    event = F.struct(*[F.col(c) for c in cols])
    within = S.micros(pattern.within_) if pattern.within_ else None
    if timeouts and within is None:
        raise PatternError("timeouts need within()")
    paths = chain.lowerable(graph)
    if engine == "auto":
        if paths is not None and not (timeouts and len(paths) > 1):
            engine = "chain"
        elif _is_pair(graph) and within is not None and not timeouts:
            engine = "pairs"
        else:
            engine = "chunks"
    now = df.agg(F.max(F.unix_micros(F.col(ts).cast("timestamp")))).scalar() if timeouts else F.lit(None).cast("bigint")
    df = chain.relevant(df, graph)
    if engine == "chain":
        if paths is None:
            raise PatternError("the pattern has loops or free skips; it has no window form")
        seq = S.sequence(df, by, ts, tie, width)
        found = _by_chain(df, seq, graph, paths, event, ts, within, now if timeouts else None)
    else:
        if within is None:
            raise PatternError("a pattern with loops or free skips needs within() to bound its groups")
        # A group reaches ``within`` past its chunk, so narrower chunks gain little.
        seq = S.Sequence(tuple(by), ts, tuple(tie), width or max(pattern.within_ * 4, timedelta(hours=1)))
        if engine == "pairs":
            found = _by_pairs(df, seq, graph, event, pattern.within_)
        else:
            found = _by_chunks(df, seq, graph, event, pattern.within_, timeouts, now)
    tie_fields = [c for c in tie if c != ts]
    ord_of = lambda e: F.struct(
        F.unix_micros(e[ts].cast("timestamp")).alias("t"), *[e[c].alias(f"o{i}") for i, c in enumerate(tie_fields)])
    found = found.withColumns({
        "__so": ord_of(F.element_at("items", 1)["e"]), "__eo": ord_of(F.element_at("items", -1)["e"])})
    done = found.where("kind = 'match'")
    if pattern.skip.kind != "none":
        done = done.withColumn("__po", skips.pivot_ord(pattern.skip, graph, ord_of, F.col("__eo")))
        done = skips.apply_skip(done, pattern.skip)
    keep = [S.KEY, S.CHUNK, "kind", "timeout_ts", "items", "__so", "__eo", "__no"]
    out = done.select(*keep)
    if timeouts:
        out = out.unionByName(found.where("kind = 'timeout'").select(*keep))
    first, last = F.element_at("items", 1)["e"], F.element_at("items", -1)["e"]
    return out.withColumns({"start_ts": first[ts], "end_ts": last[ts]})


def step_array(graph: Graph, name: str) -> Column:
    ids = [i for i, s in enumerate(graph.slots) if s.name == name]
    got = F.transform(F.filter("items", lambda x: x["slot"].isin(ids)), lambda x: x["e"])
    return F.when(F.size(got) > 0, got)


def shape(found: DataFrame, graph: Graph, pattern: Pattern, timeouts: bool = False) -> DataFrame:
    key = found.schema[S.KEY].dataType
    keys = [F.col(S.KEY)[f].alias(f) for f in key.fieldNames() if f != "all"]
    extra = ["kind", "timeout_ts"] if timeouts else []
    steps = [step_array(graph, n).alias(n) for n in dict.fromkeys(pattern.names())]
    return found.select(*keys, *extra, "start_ts", "end_ts", *steps)


# Ways to run

def _by_chain(df, seq, graph, paths, event, ts, within, now=None) -> DataFrame:
    timeouts = now is not None
    out = chain.Lowering(df, seq, graph, paths, event, keep_dead=timeouts).run()
    us = lambda c: F.unix_micros(c.cast("timestamp"))
    out = out.withColumnRenamed("path", "__no")
    none = F.lit(None).cast("timestamp")
    if within is None:
        return out.where(F.col("st") == chain.DONE).select(
            S.KEY, S.CHUNK, "items", F.lit("match").alias("kind"), none.alias("timeout_ts"), "__no")
    start = us(F.element_at("items", 1)["e"][ts])
    last = us(F.element_at("items", -1)["e"][ts])
    in_time = (F.col("st") == chain.DONE) & (last - start < within)
    if not timeouts:
        return out.where(in_time).select(
            S.KEY, S.CHUNK, "items", F.lit("match").alias("kind"), none.alias("timeout_ts"), "__no")
    deadline = start + F.lit(within)
    dead_early = (F.col("st") == chain.DEAD) & (us(F.col("dead")) < deadline)
    out = out.withColumn("kind", F.when(in_time, "match").when(~dead_early & (deadline <= now), "timeout"))
    early = F.filter("items", lambda x: us(x["e"][ts]) < deadline)
    return out.where(F.col("kind").isNotNull()).select(
        S.KEY, S.CHUNK, F.when(F.col("kind") == "match", F.col("items")).otherwise(early).alias("items"), "kind",
        F.when(F.col("kind") == "timeout", F.timestamp_micros(deadline)).alias("timeout_ts"), "__no")


def _is_pair(graph: Graph) -> bool:
    """Two single steps joined by a plain free skip."""
    first, rest = graph.edges.get(START, []), graph.edges.get(0, [])
    plain = len(graph.slots) == 2 and len(first) == 1 and len(rest) == 1 and graph.finals == {1}
    if not plain or any(s.iterative for s in graph.slots):
        return False
    e = rest[0]
    return e.mode == ANY and not (e.kill or e.take_not or e.ignore_not or e.need or e.veto or graph.fresh_kill.get(0))


def _by_pairs(df, seq, graph, event, within) -> DataFrame:
    """Equi join on (key, bucket of the bound) and the exact time condition."""
    step = S.micros(within)
    d = S.chunked(df, seq).withColumns({"__bits": chain.packed(graph), "__t": seq.ticks(df)})
    item = lambda slot: F.struct(F.lit(slot).alias("slot"), event.alias("e"))
    side = lambda slot, p: d.where(chain._k(graph.slots[slot].condition)).select(
        F.col(S.KEY).alias(f"{p}k"), F.col(S.CHUNK).alias(f"{p}c"), F.col(S.ORD).alias(f"{p}o"),
        F.col("__t").alias(f"{p}t"), item(slot).alias(f"{p}i"))
    a, b = side(0, "a"), side(1, "b")
    bucket = F.floor(F.col("at") / step)
    a = a.withColumn("ab", F.explode(F.array(bucket, bucket + 1)))
    b = b.withColumn("bb", F.floor(F.col("bt") / step))
    cond = (F.col("ak") == F.col("bk")) & (F.col("ab") == F.col("bb")) & (F.col("bo") > F.col("ao")) \
        & (F.col("bt") - F.col("at") < step)
    return a.join(b, cond).select(
        F.col("ak").alias(S.KEY), F.col("ac").alias(S.CHUNK), F.array("ai", "bi").alias("items"),
        F.lit("match").alias("kind"), F.lit(None).cast("timestamp").alias("timeout_ts"), F.lit(0).alias("__no"))


def _by_chunks(df, seq, graph, event, within, timeouts, now) -> DataFrame:
    """Each (key, chunk) with the events up to ``within`` after it."""
    us = S.micros(within)
    # Conditions are evaluated before rows are copied.
    d = S.time_halo(df.withColumn("__bits", chain.packed(graph)), seq, after=within).withColumn("__t", seq.ticks(df))
    tie = [t for t in seq.tie if t != seq.ts]
    reads = any(x.iterative for x in graph.slots)
    d = d.select(
        S.KEY, S.CHUNK, "__t", *[F.col(t).alias(f"__o{i}") for i, t in enumerate(tie)], "__bits", "__own",
        event.alias("__ev"), now.alias("__now"), *([event.alias("__fields")] if reads else []))
    machine = Machine(graph, us)
    opens = [graph.slots[e.target].condition for e in graph.edges[START]]

    def handle(cols: dict[str, list]):
        bits_, own = cols["__bits"], cols["__own"]
        # Most groups hold no start at all.
        if not any(o and any(b >> i & 1 for i in opens) for b, o in zip(bits_, own)):
            return []
        fields = cols["__fields"] if reads else [None] * len(bits_)
        events = [Event(*x) for x in zip(cols["__t"], bits_, range(len(bits_)), fields)]
        matches, late = run_group(machine, events, own, cols["__now"][0])
        found = [("match", m) for m in matches] + ([("timeout", p.items) for p in late] if timeouts else [])
        return [(k, [x for x, _ in m], [e.ref for _, e in m]) for k, m in found]

    found = match_groups(
        d, ["__t", *[f"__o{i}" for i in range(len(tie))]], ["__t", "__bits", "__own", "__now", *(["__fields"] if reads else [])], handle)
    start = F.unix_micros(F.element_at("items", 1)["e"][seq.ts].cast("timestamp"))
    return found.withColumn("timeout_ts", F.when(F.col("kind") == "timeout", F.timestamp_micros(start + F.lit(us))))
