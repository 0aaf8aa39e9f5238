"""Event-by-event matching inside one bounded group.

Used where a pattern has loops or free skips. ``Machine.feed`` moves the partial
matches of one key over one event; a group is either a (key, time chunk) with
the events its matches can reach, or a key's released events in a stream.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any, NamedTuple

from tidewater.operators.pattern.graph import END, START, Edge, Graph
from tidewater.operators.pattern.spec import ANY, RELAXED, Running


class Event(NamedTuple):
    ts: int
    bits: int
    ref: Any
    fields: dict | None = None


class Partial(NamedTuple):
    slot: int
    wait: int | None
    start: int
    items: tuple[tuple[int, Event], ...]


def _hits(bits: int, ids) -> bool:
    return any(bits >> i & 1 for i in ids)


class Machine:
    def __init__(self, graph: Graph, within: int | None):
        self.g, self.within = graph, within

    def expire(self, partials: list[Partial], now: int) -> tuple[list[Partial], list[Partial]]:
        """Partial matches still in time, and those that ran out."""
        if self.within is None:
            return partials, []
        live, late = [], []
        for p in partials:
            (live if now - p.start < self.within else late).append(p)
        return live, late

    def feed(self, partials: list[Partial], ev: Event, may_start: bool = True):
        """Partial matches after the event, and the matches it completes."""
        out: list[Partial] = []
        done: list[tuple] = []
        for p in partials:
            self._advance(p, ev, out, done)
        if may_start:
            for e in self.g.edges.get(START, ()):
                if self._open(e, ev.bits) and self._takes(e, ev, ()):
                    self._took(e, ev, ev.ts, (), False, out, done)
        return out, done

    @staticmethod
    def _open(e: Edge, bits: int) -> bool:
        return all(bits >> i & 1 for i in e.need) and not _hits(bits, e.veto)

    def _takes(self, e: Edge, ev: Event, items) -> bool:
        return self._wanted(e, ev, items) and not _hits(ev.bits, e.take_not)

    def _wanted(self, e: Edge, ev: Event, items) -> bool:
        s = self.g.slots[e.target]
        if not ev.bits >> s.condition & 1:
            return False
        return all(self._holds(c, ev, items) for c in s.iterative)

    def _holds(self, cond: Running | Callable, ev: Event, items) -> bool:
        matched = lambda name: [x.fields for slot, x in items if self.g.slots[slot].name == name]
        test = cond.holds if isinstance(cond, Running) else cond
        return bool(test(ev.fields, matched))

    def _took(self, e: Edge, ev: Event, start, items, killed, out, done) -> None:
        items = (*items, (e.target, ev))
        if e.target in self.g.finals:
            done.append(items)
        if not killed and self.g.edges.get(e.target):
            out.append(Partial(e.target, None, start, items))

    def _advance(self, p: Partial, ev: Event, out, done) -> None:
        edges = self.g.edges[p.slot]
        fresh = p.wait is None
        kills = self.g.fresh_kill.get(p.slot, ()) if fresh else edges[p.wait].kill
        killed = _hits(ev.bits, kills)
        for i in range(len(edges)) if fresh else (p.wait,):
            e = edges[i]
            if fresh and not self._open(e, ev.bits):
                continue
            if e.target == END:
                if not killed:
                    done.append(p.items)
                continue
            if self._takes(e, ev, p.items):
                self._took(e, ev, p.start, p.items, killed, out, done)
            skips = e.mode == ANY or (e.mode == RELAXED and not self._wanted(e, ev, p.items))
            if skips and not killed and not _hits(ev.bits, e.ignore_not):
                out.append(p._replace(wait=i))


def run_group(machine: Machine, events: list[Event], own: list[bool], horizon: int | None):
    """Matches and timeouts of one group, in the order they come about.

    Only ``own`` events start matches. Partial matches left at the end have
    timed out if ``horizon`` has passed their bound.
    """
    partials: list[Partial] = []
    matches, timeouts = [], []
    for ev, mine in zip(events, own):
        partials, late = machine.expire(partials, ev.ts)
        timeouts.extend(late)
        if mine or partials:
            partials, done = machine.feed(partials, ev, mine)
            matches.extend(done)
    if horizon is not None:
        timeouts.extend(machine.expire(partials, horizon)[1])
    return matches, timeouts
