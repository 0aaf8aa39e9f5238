"""Keyed process functions: list, map and value state, timers, and windows kept as elements.

State variables are declared, updated from the rows of a key, and read back as tables
with ``state.read_state(variable=...)`` and ``state.read_state(timers=True)``. A table with one
row per key gives a new stream the state to start from.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence as Seq
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from itertools import islice
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

#: Rows of a key taken at once.
CHUNK = 10_000
_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
#: Start and end in microseconds.
Window = tuple[int, int]
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def list_state_store(spark: SparkSession):
    """Streams started inside keep their state in the store that knows lists, maps and timers."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


def _fields(x) -> tuple:
    """The fields of a struct, which comes as a row or as a dict."""
    return tuple(x.values()) if isinstance(x, dict) else tuple(x)


@dataclass
class Value:
    """One row per key: ``fold(old, row)`` gives the new one; ``old`` is None at first."""

    name: str
    schema: str
    fold: Callable[[tuple | None, Row], tuple]

    def open(self, handle):
        return handle.getValueState(self.name, self.schema)

    def take(self, state, rows: list[Row], new: bool = False) -> None:
        now = None if new else state.get()
        for row in rows:
            now = self.fold(now, row)
        state.update(tuple(now))

    def restore(self, state, saved) -> None:
        state.update(_fields(saved))


@dataclass
class Items:
    """A list per key: ``pick(row)`` is appended unless it is None."""

    name: str
    schema: str
    pick: Callable[[Row], tuple | None]

    def open(self, handle):
        return handle.getListState(self.name, self.schema)

    def take(self, state, rows: list[Row], new: bool = False) -> None:
        picked = [x for x in map(self.pick, rows) if x is not None]
        if picked:
            state.appendList(picked)

    def restore(self, state, saved) -> None:
        if saved:
            state.put([_fields(x) for x in saved])


@dataclass
class Entries:
    """A map per key: ``fold(old, row)`` gives the new value under ``key(row)``."""

    name: str
    key_schema: str
    schema: str
    key: Callable[[Row], tuple]
    fold: Callable[[tuple | None, Row], tuple]

    def open(self, handle):
        return handle.getMapState(self.name, self.key_schema, self.schema)

    def take(self, state, rows: list[Row], new: bool = False) -> None:
        now: dict[tuple, tuple | None] = {}
        for row in rows:
            k = self.key(row)
            if k not in now:
                now[k] = None if new else state.getValue(k)
            now[k] = self.fold(now[k], row)
        for k, v in now.items():
            state.updateValue(k, tuple(v))

    def restore(self, state, saved) -> None:
        for entry in saved or ():
            k, v = _fields(entry)
            state.updateValue(_fields(k), _fields(v))


def _chunks(rows: Iterator[Row]) -> Iterator[list[Row]]:
    while some := list(islice(rows, CHUNK)):
        yield some


class Emitting(StatefulProcessor):
    """A processor whose output rows get their column names from ``process``."""

    names: list[str] = []
    #: Whether keys may have state that no row of theirs has made.
    started = False

    def close(self) -> None:
        pass


class KeyedProcessor(Emitting):
    """Declared variables, at most one event-time timer per key, and rows that it emits.

    ``timer(row)`` gives milliseconds or None; the greatest so far is the one that stands.
    ``emit(key, state)`` runs after a key's rows of a batch, ``on_timer(key, state, ms)`` when the watermark
    passes the timer; both return tuples of the output. ``state`` holds the variables by name.
    """

    def __init__(self, variables: Seq[Value | Items | Entries], timer: Callable[[Row], int | None] | None = None,
                 emit: Callable[[tuple, dict], list[tuple]] | None = None, on_timer: Callable[[tuple, dict, int], list[tuple]] | None = None) -> None:
        self.variables, self.timer, self.emit, self.on_timer = list(variables), timer, emit, on_timer

    def init(self, handle) -> None:
        self.handle = handle
        self.state: dict[str, Any] = {v.name: v.open(handle) for v in self.variables}

    def _new(self) -> bool:
        """Every row of a key updates its values: without one of them it has no other state, and nothing is looked up."""
        value = next((v for v in self.variables if isinstance(v, Value)), None)
        return not self.started and value is not None and not self.state[value.name].exists()

    def _set(self, at: int | None, new: bool = False) -> None:
        if at is None:
            return
        set_ = [] if new else list(self.handle.listTimers())
        if at > max(set_, default=-1):
            for old in set_:
                self.handle.deleteTimer(old)
            self.handle.registerTimer(at)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        at, unseen = None, self._new()
        new = unseen
        for some in _chunks(rows):
            for v in self.variables:
                v.take(self.state[v.name], some, new)
            new = False
            if self.timer:
                at = max([t for t in map(self.timer, some) if t is not None] + ([at] if at is not None else []), default=None)
        self._set(at, unseen)
        for out in self.emit(key, self.state) if self.emit else ():
            yield Row(**dict(zip(self.names, out, strict=True)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        for out in self.on_timer(key, self.state, expiredTimerInfo.getExpiryTimeInMs()) if self.on_timer else ():
            yield Row(**dict(zip(self.names, out, strict=True)))

    def handleInitialState(self, key, initialState, timerValues) -> None:
        saved = initialState.asDict()
        for v in self.variables:
            if saved.get(v.name) is not None:
                v.restore(self.state[v.name], saved[v.name])
        self._set(saved.get("timer"))


def process(df: DataFrame, by: Seq[str], processor: Emitting, schema: str, initial: DataFrame | None = None) -> DataFrame:
    """Output of a processor over the keys of a stream.

    ``initial`` has the key columns, one column per variable (a struct, an array of
    structs, an array of (key, value) pairs) and optionally ``timer``; one row per key.
    """
    first = initial.groupBy(*by) if initial is not None else None
    processor.names, processor.started = T.StructType.fromDDL(schema).names, initial is not None
    return df.groupBy(*by).transformWithState(processor, schema, "Append", "EventTime", first)


class WindowElements(Emitting):
    """Windows as lists of their elements, fired by number and by time.

    The rows of ``in_windows`` are grouped by their own key alone, and the state holds the elements of all its open windows with
    the bounds of each (microseconds): a call to the state and a timer per key and batch, not per window. Elements are taken in
    the order of ``order``; every ``count``-th fires the window, which is then emptied, and
    what is left fires when the watermark passes its end. ``last`` and ``span`` evict before a window is
    evaluated: all but the last elements, and those older than the newest by more than ``span`` (on
    ``ts``). ``evaluate(key, pane, elements)`` gives the rows that come out; its key ends with the window's start and end (instants).
    The rows that a key has in one batch are held at once.
    """

    def __init__(self, columns: Seq[str], schema: str, order: Seq[str], evaluate: Callable[[tuple, int, list[Row]], list[tuple]],
                 count: int | None = None, last: int | None = None, span: timedelta | None = None, ts: str | None = None) -> None:
        self.columns, self.schema, self.order, self.evaluate = list(columns), schema, list(order), evaluate
        self.count, self.last, self.span, self.ts = count, last, span, ts

    def init(self, handle) -> None:
        self.handle = handle
        self.elements = handle.getListState("elements", f"window_start bigint, window_end bigint, {self.schema}")
        self.panes = handle.getListState("panes", "window_start bigint, window_end bigint, n bigint")

    def _held(self) -> dict[Window, list[tuple]]:
        held: dict[Window, list[tuple]] = {}
        for start, end, *x in self.elements.get():
            held.setdefault((start, end), []).append(tuple(x))
        return held

    def _counted(self) -> dict[Window, int]:
        """Panes that the open windows have fired; without ``count`` none fires before its end."""
        return {(start, end): n for start, end, n in self.panes.get()} if self.count is not None else {}

    def _put(self, held: dict[Window, list[tuple]]) -> None:
        if rows := [(*w, *x) for w, some in held.items() for x in some]:
            self.elements.put(rows)
        else:
            self.elements.clear()

    def _put_counts(self, counted: dict[Window, int]) -> None:
        if counted:
            self.panes.put([(*w, n) for w, n in counted.items()])
        else:
            self.panes.clear()

    def _fire(self, key: tuple, window: Window, pane: int, held: list[tuple]) -> Iterator[Row]:
        rows = [Row(**dict(zip(self.columns, x, strict=True))) for x in held]
        if self.span is not None and rows:
            newest = max(r[self.ts] for r in rows)
            rows = [r for r in rows if r[self.ts] >= newest - self.span]
        if self.last is not None:
            rows = rows[-self.last:]
        for out in self.evaluate((*key, *(_EPOCH + timedelta(microseconds=t) for t in window)), pane, rows):
            yield Row(**dict(zip(self.names, out, strict=True)))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new: dict[Window, list[tuple]] = {}
        for r in rows:
            new.setdefault((r["window_start"], r["window_end"]), []).append(tuple(r[c] for c in (*self.order, *self.columns)))
        new = {w: [x[len(self.order):] for x in sorted(some)] for w, some in sorted(new.items())}
        if self.count is None:
            self.elements.appendList([(*w, *x) for w, some in new.items() for x in some])
        else:
            held, counted = self._held(), self._counted()
            before = dict(counted)
            for w, some in new.items():
                some = held.get(w, []) + some
                while len(some) >= self.count:
                    yield from self._fire(key, w, counted.get(w, 0), some[:self.count])
                    counted[w] = counted.get(w, 0) + 1
                    some = some[self.count:]
                held[w] = some
            self._put(held)
            if counted != before:
                self._put_counts(counted)
        self._wait(min(end for _, end in new), list(self.handle.listTimers()))

    def _wait(self, end: int, waiting: Seq[int] = ()) -> None:
        """One timer per key stands, at the end of the window that closes first."""
        at = end // 1000
        if at < min(waiting, default=at + 1):
            for later in waiting:
                self.handle.deleteTimer(later)
            self.handle.registerTimer(at)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        # A timer expires once the watermark is as late; the key's other windows that are due by then have no timer of their own.
        mark = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        held, counted = self._held(), self._counted()
        due = [w for w in sorted({*held, *counted}) if w[1] // 1000 <= mark]
        for w in due:
            some, pane = held.pop(w, []), counted.pop(w, 0)
            if some:
                yield from self._fire(key, w, pane, some)
        self._put(held)
        if self.count is not None:
            self._put_counts(counted)
        if rest := [end for _, end in {*held, *counted}]:
            self._wait(min(rest))


def in_windows(df: DataFrame, window, by: Seq[str]) -> tuple[DataFrame, list[str]]:
    """Rows with the bounds of their window in microseconds, and the key that ``WindowElements`` expects."""
    bounds = {f"window_{x}": F.unix_micros(f"__w.{x}") for x in ("start", "end")}
    return df.withColumn("__w", window).withColumns(bounds).drop("__w"), [*by]
