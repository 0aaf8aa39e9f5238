"""Sequence patterns on streams.

``stream_match`` keeps per-key state: events wait until the watermark passes
them, then move the partial matches on in time order. It needs no ``within``,
and reports partial matches that ran out of time.

``BatchMatcher`` runs the table matcher on each micro-batch together with the
events that may still take part in a match. It needs ``within``; hot keys are
spread over tasks as on tables.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence as Seq
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidewater.operators import sequence as S
from tidewater.operators.pattern import skip as skips
from tidewater.operators.pattern.api import find, shape
from tidewater.operators.pattern.chain import packed
from tidewater.operators.pattern.graph import END, build
from tidewater.operators.pattern.local import Event, Machine, Partial
from tidewater.operators.pattern.spec import Pattern, PatternError, Skip
from tidewater.session import work_dir


def stream_match(
    df: DataFrame, pattern: Pattern, by: Seq[str], ts: str, tie: Seq[str] = (), payload: Seq[str] | None = None,
    timeouts: bool = False,
) -> DataFrame:
    """Matches of a watermarked stream, as the table matcher shapes them.

    Skip strategies need all matches of a key in order and are left to tables.
    """
    pattern.check()
    if pattern.skip.kind != "none":
        raise PatternError("stream_match reports all matches; apply a skip strategy to the sink table")
    graph = build(pattern)
    within = S.micros(pattern.within_) if pattern.within_ else None
    cols = list(dict.fromkeys([ts, *tie, *(payload if payload is not None else [c for c in df.columns if c not in by])]))
    event_type = T.StructType([df.schema[c] for c in cols])
    # Times travel in micros: JSON text would cut them to milliseconds.
    plain = [F.unix_micros(F.col(c).cast("timestamp")).alias(c) if _is_time(df, c) else F.col(c) for c in cols]
    rows = df.select(
        *by, ts, F.unix_micros(F.col(ts).cast("timestamp")).alias("__t"), F.struct(*plain, F.lit(0).alias("__pad")).alias("__e"), packed(graph).alias("__bits"))
    rows = rows.withColumn("__e", F.to_json("__e", {"ignoreNullFields": "false"}))
    times = [c for c in cols if _is_time(df, c)]
    machine = Machine(graph, within)
    tie_cols = list(tie)
    out_schema = T.StructType([df.schema[k] for k in by] + [
        T.StructField("kind", T.StringType()), T.StructField("at", T.LongType()), T.StructField("slots", T.ArrayType(T.IntegerType())),
        T.StructField("events", T.ArrayType(T.StringType()))])

    def order(ev: Event):
        e = json.loads(ev.ref)
        return (ev.ts, *[e[c] for c in tie_cols])

    def step(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        saved = json.loads(state.get[0]) if state.exists else {"wait": [], "part": []}
        waiting = [Event(*x) for x in saved["wait"]]
        partials = [Partial(p[0], p[1], p[2], tuple((s, Event(*e)) for s, e in p[3])) for p in saved["part"]]
        for pdf in pdfs:
            waiting.extend(Event(int(t), int(b), e) for t, b, e in zip(pdf["__t"], pdf["__bits"], pdf["__e"]))
        mark = state.getCurrentWatermarkMs() * 1000
        ready = sorted((e for e in waiting if e.ts <= mark), key=order)
        waiting = [e for e in waiting if e.ts > mark]
        found, late = [], []
        for ev in ready:
            full = ev._replace(fields=json.loads(ev.ref)) if any(s.iterative for s in graph.slots) else ev
            partials, gone = machine.expire(partials, ev.ts)
            late.extend(gone)
            partials, done = machine.feed(partials, full)
            found.extend(done)
        partials, gone = machine.expire(partials, mark)
        late.extend(gone)
        data = [(*key, "match", m[-1][1].ts, [s for s, _ in m], [e.ref for _, e in m]) for m in found]
        if timeouts:
            data += [(*key, "timeout", p.start + within, [s for s, _ in p.items], [e.ref for _, e in p.items]) for p in late]
        if waiting or partials:
            body = {"wait": [list(e[:3]) for e in waiting],
                    "part": [[p.slot, p.wait, p.start, [[s, list(e)] for s, e in p.items]] for p in partials]}
            state.update((json.dumps(body),))
            due = [e.ts for e in waiting] + ([p.start + within for p in partials] if within else [])
            if due:
                # Fires once the watermark is past it, so that events at the mark itself are taken.
                state.setTimeoutTimestamp(max(-(-min(due) // 1000) - 1, mark // 1000))
        elif state.exists:
            state.remove()
        yield pd.DataFrame(data, columns=[f.name for f in out_schema])

    raw = rows.groupBy(*by).applyInPandasWithState(
        step, out_schema, "state string", "append", GroupStateTimeout.EventTimeTimeout)
    json_type = T.StructType([T.StructField(f.name, T.LongType() if f.name in times else f.dataType) for f in event_type])
    back = lambda e: F.struct(*[
        (F.timestamp_micros(e[f.name]).cast(f.dataType) if f.name in times else e[f.name]).alias(f.name) for f in event_type])
    items = F.zip_with("slots", F.transform("events", lambda t: back(F.from_json(t, json_type))), lambda s, e: F.struct(s.alias("slot"), e.alias("e")))
    shaped = raw.select(F.struct(*by).alias(S.KEY), "kind", "at", items.alias("items"))
    first, last = F.element_at("items", 1)["e"], F.element_at("items", -1)["e"]
    shaped = shaped.withColumns({
        "start_ts": first[ts], "end_ts": last[ts], "timeout_ts": F.when(F.col("kind") == "timeout", F.timestamp_micros("at"))})
    return shape(shaped, graph, pattern, timeouts)


def _is_time(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, (T.TimestampType, T.TimestampNTZType))


class BatchMatcher:
    """foreachBatch sink that writes the matches each micro-batch completes.

    Between batches it keeps the events newer than (watermark - within) in the
    work folder. A match is written by the batch whose watermark passes its end.

    With a skip strategy a match is held until no match that starts earlier, or with it, can
    still be completed, that is until the watermark passes its start by ``within``.
    Matches are then picked in the order of their starts, from the bound that the last one picked
    left for its key. A bound that lies before all events to come is dropped, so the bounds
    kept are those of the keys that matched within ``within``.
    """

    def __init__(
        self, spark, pattern: Pattern, by: Seq[str], ts: str, tie: Seq[str], payload: Seq[str], delay: timedelta,
        path: str | None = None, width: timedelta | None = None,
    ):
        if pattern.within_ is None:
            raise PatternError("BatchMatcher needs within(), which bounds the events it keeps")
        self.skip, pattern = pattern.skip, pattern.check().after_match(Skip())
        self.spark, self.pattern, self.by, self.ts, self.tie = spark, pattern, list(by), ts, list(tie)
        self.payload, self.delay, self.width = list(payload), delay, width
        self.path = path or work_dir(spark, "matcher")
        self.graph = build(pattern)
        if any(e.target == END for es in self.graph.edges.values() for e in es):
            raise PatternError("a trailing not_next is decided by the event after the match; use stream_match")

    def _mark(self, batch_id: int):
        if batch_id < 0:
            return None
        return self.spark.read.parquet(f"{self.path}/marks/batch={batch_id}").first()[0]

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        old = self._mark(batch_id - 1)
        data = batch if old is None else batch.where(F.col(self.ts) > F.lit(old))
        if batch_id > 0:
            data = data.unionByName(self.spark.read.schema(batch.schema).parquet(f"{self.path}/kept/batch={batch_id - 1}"))
        top = data.agg(F.max(self.ts)).first()[0]
        mark = old if top is None else top - self.delay
        if old is not None and mark < old:
            mark = old
        found = find(data, self.pattern, self.graph, self.by, self.ts, self.tie, self.payload, self.width, False)
        if self.skip.kind == "none":
            out = found.where(self._between("end_ts", old, mark))
        else:
            reach = self.pattern.within_
            ready = found.where(self._between("start_ts", old and old - reach, mark and mark - reach))
            out = self._picked(ready, batch_id, mark and mark - reach)
        shape(out, self.graph, self.pattern).write.mode("overwrite").parquet(f"{self.path}/matches/batch={batch_id}")
        kept = data if mark is None else data.where(F.col(self.ts) > F.lit(mark - self.pattern.within_))
        kept.write.mode("overwrite").parquet(f"{self.path}/kept/batch={batch_id}")
        self.spark.createDataFrame([(mark,)], "mark timestamp").write.mode("overwrite").parquet(f"{self.path}/marks/batch={batch_id}")

    @staticmethod
    def _between(at: str, old, mark):
        """Passed by this batch's mark and not by that of the one before; without any time so far nothing is decided."""
        if mark is None:
            return F.lit(False)
        return (F.col(at) <= F.lit(mark)) & (F.col(at) > F.lit(old) if old is not None else F.lit(True))

    def _picked(self, ready: DataFrame, batch_id: int, horizon) -> DataFrame:
        """The matches that the skip strategy leaves, after the bounds of the batch before; writes the bounds of this one."""
        tie = [c for c in self.tie if c != self.ts]
        order = lambda e: F.struct(
            F.unix_micros(e[self.ts].cast("timestamp")).alias("t"), *[e[c].alias(f"o{i}") for i, c in enumerate(tie)])
        if self.skip.kind != "next":
            ready = ready.withColumn("__po", skips.pivot_ord(self.skip, self.graph, order, F.col("__eo")))
        old = None
        if batch_id > 0 and self.skip.kind != "next":
            old = self.spark.read.parquet(f"{self.path}/bounds/batch={batch_id - 1}")
            bound = F.col("__bound")
            beyond = F.col("__so") > bound if self.skip.kind == "past_last" else F.col("__so") >= bound
            ready = ready.join(old.withColumnRenamed("key", S.KEY), S.KEY, "left").where(bound.isNull() | beyond).drop("__bound")
        out = skips.apply_skip(ready, self.skip)
        if self.skip.kind != "next":
            # Picked matches are written once; the bounds are read from them.
            out.write.mode("overwrite").parquet(f"{self.path}/picked/batch={batch_id}")
            out = self.spark.read.schema(out.schema).parquet(f"{self.path}/picked/batch={batch_id}")
            way = F.greatest(F.coalesce("__po", "__so"), F.col("__so"))
            bounds = out.select(F.col(S.KEY).alias("key"), way.alias("__bound"))
            bounds = (bounds.unionByName(old) if old is not None else bounds).groupBy("key").agg(F.max("__bound").alias("__bound"))
            if horizon is not None:
                bounds = bounds.where(F.col("__bound.t") > F.unix_micros(F.lit(horizon)))
            bounds.write.mode("overwrite").parquet(f"{self.path}/bounds/batch={batch_id}")
        return out

    def matches(self) -> DataFrame:
        return self.spark.read.option("basePath", f"{self.path}/matches").parquet(f"{self.path}/matches").drop("batch")
