"""Pattern steps as positions and edges.

Repetitions are unrolled into positions ("slots"); an edge says which slot may
come next after a slot, what may be skipped while waiting for it, and what ends
the wait. Both ways of running a pattern read this graph: the lowering to window
functions walks its paths, the chunk matcher follows its edges event by event.

Conditions are numbers into ``Graph.conditions`` (SQL texts, NULL counts as
false). An edge waits on events as follows:

* kill   - any of these true ends the whole partial match;
* take   - the slot's condition, and none of ``take_not``;
* ignore - strict: never; relaxed: condition false; any: always; and none of
  ``ignore_not``.

On the first event after the source slot ("fresh") the kills of all edges of
that slot apply, and an edge needs all of ``need`` and none of ``veto``.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from tidewater.operators.pattern.spec import ANY, RELAXED, STRICT, Pattern, Step

START, END = -1, -2


@dataclass(frozen=True)
class Slot:
    name: str
    condition: int
    iterative: tuple = ()


@dataclass(frozen=True)
class Edge:
    target: int
    mode: str
    take_not: tuple[int, ...] = ()
    ignore_not: tuple[int, ...] = ()
    kill: tuple[int, ...] = ()
    need: tuple[int, ...] = ()
    veto: tuple[int, ...] = ()


@dataclass(frozen=True)
class Tail:
    """A place the next step can continue from, with what is armed there."""

    src: int
    kill: tuple[int, ...] = ()
    fresh_kill: tuple[int, ...] = ()
    barred: tuple[int, ...] = ()
    barred_until: int | None = None
    veto: tuple[int, ...] = ()

    def passing(self) -> "Tail":
        """The same place after an optional step was left out."""
        return replace(self, barred=(), barred_until=None, veto=self.veto + self.barred)


@dataclass
class Graph:
    slots: list[Slot] = field(default_factory=list)
    edges: dict[int, list[Edge]] = field(default_factory=dict)
    fresh_kill: dict[int, tuple[int, ...]] = field(default_factory=dict)
    finals: set[int] = field(default_factory=set)
    conditions: list[str] = field(default_factory=list)

    def cond(self, text: str | None) -> int:
        text = "true" if text is None else text
        if text not in self.conditions:
            self.conditions.append(text)
        return self.conditions.index(text)

    def paths(self, limit: int = 64) -> list[list[tuple[int, Edge]]] | None:
        """All edge paths from the start to a final slot, if there are few.

        None when the graph has a loop, an ``any`` edge or too many paths.
        """
        if any(e.mode == ANY for es in self.edges.values() for e in es) or self._cyclic():
            return None
        out: list[list[tuple[int, Edge]]] = []

        def walk(at: int, so_far):
            if len(out) > limit:
                return
            if at in self.finals:
                out.append(so_far)
            for e in self.edges.get(at, ()):
                if e.target == END:
                    out.append([*so_far, (at, e)])
                else:
                    walk(e.target, [*so_far, (at, e)])

        walk(START, [])
        return out if len(out) <= limit else None

    def _cyclic(self) -> bool:
        # Slots are numbered in building order, so only a loop points back.
        return any(e.target != END and e.target <= s for s, es in self.edges.items() for e in es)


def build(pattern: Pattern) -> Graph:
    b = _Builder()
    tails = b.chain(pattern.steps, [Tail(START)])
    g = b.graph
    for t in tails:
        if t.src == START:
            continue
        if t.fresh_kill:
            g.edges.setdefault(t.src, []).append(Edge(END, STRICT, kill=t.fresh_kill))
        else:
            g.finals.add(t.src)
    for s in range(len(g.slots)):
        own = g.fresh_kill.get(s, ())
        armed = [k for e in g.edges.get(s, ()) for k in e.kill]
        g.fresh_kill[s] = tuple(dict.fromkeys([*own, *armed]))
    return g


class _Builder:
    MARK = -9

    def __init__(self):
        self.graph = Graph()
        self.group_until: tuple[int, ...] = ()

    def chain(self, steps: tuple[Step, ...], tails: list[Tail], head: str | None = None, head_inner: str | None = None):
        for i, s in enumerate(steps):
            if s.negated:
                k = (self.graph.cond(s.condition),)
                if s.contiguity == STRICT:
                    tails = [replace(t, fresh_kill=t.fresh_kill + k) for t in tails]
                else:
                    tails = [replace(t, kill=t.kill + k) for t in tails]
                continue
            if i == 0 and head is not None:
                s = replace(s, contiguity=head, inner=head_inner if s.quantified else s.inner)
            after = steps[i + 1] if i + 1 < len(steps) else None
            armed = ()
            if after is not None and after.negated and after.contiguity == RELAXED:
                armed = (self.graph.cond(after.condition),)
            tails = self.step(s, tails, armed, is_head=i == 0)
        return tails

    def step(self, s: Step, tails: list[Tail], armed: tuple[int, ...], is_head: bool) -> list[Tail]:
        out = [t.passing() for t in tails] if s.optional_ else []
        copies = s.low if s.loops else s.high
        cur, entries = tails, []
        for k in range(copies):
            mode = s.contiguity if k == 0 else s.inner
            cur, entries = self.once(s, cur, mode, armed if k else (), first=k == 0, is_head=is_head)
            if not s.loops and k + 1 >= s.low:
                out.extend(cur)
        if s.loops:
            self.loop(s, cur, entries, armed)
            out.extend(cur)
        if s.greedy_ and s.low != s.high:
            c = (self.graph.cond(s.condition),)
            u = self.graph.cond(s.until_) if s.until_ else None
            out = [replace(t, barred=t.barred + c, barred_until=u) for t in out]
        return out

    def _stop(self, s: Step) -> tuple[int, ...]:
        return ((self.graph.cond(s.until_),) if s.until_ else ()) + self.group_until

    def once(self, s: Step, tails, mode, armed, first, is_head):
        """One repetition. Returns where it ends and the edges that enter it."""
        if s.group is None:
            slot = len(self.graph.slots)
            self.graph.slots.append(Slot(s.name, self.graph.cond(s.condition), s.iterative))
            stop = self._stop(s)
            edge = Edge(slot, mode, stop, self.group_until if first else stop, armed)
            self.enter(tails, [(edge, is_head)], None)
            return [Tail(slot)], [(edge, True)]
        outer, self.group_until = self.group_until, self._stop(s)
        self.marks: list[tuple[Edge, bool]]
        saved = getattr(self, "marks", None)
        self.marks = []
        ends = self.chain(s.group, [Tail(self.MARK)], head=mode, head_inner=s.inner)
        entries = self.marks
        self.marks = saved
        self.group_until = outer
        ends = [t for t in ends if t.src != self.MARK]
        self.enter(tails, [(replace(e, kill=e.kill + armed), h) for e, h in entries], None)
        return ends, entries

    def loop(self, s: Step, ends, entries, armed) -> None:
        stop = self._stop(s)
        back = [
            (replace(e, kill=e.kill + armed, ignore_not=tuple(dict.fromkeys(e.ignore_not + stop))), h) for e, h in entries
        ]
        self.enter([replace(t, barred=(), barred_until=None) for t in ends], back, s.inner)

    def enter(self, tails: list[Tail], entries, head_mode: str | None) -> None:
        for t in tails:
            for e, is_head in entries:
                mode = head_mode if head_mode and is_head else e.mode
                e1 = replace(e, mode=mode, kill=e.kill + t.kill, veto=e.veto + t.veto)
                plain = replace(e1, take_not=e1.take_not + t.barred, ignore_not=e1.ignore_not + t.barred)
                made = [plain]
                if t.barred_until is not None:
                    made = [replace(plain, veto=plain.veto + (t.barred_until,)), replace(e1, need=e1.need + (t.barred_until,))]
                for m in made:
                    if t.src == self.MARK:
                        self.marks.append((m, is_head))
                    else:
                        self.graph.edges.setdefault(t.src, []).append(m)
                if t.fresh_kill and t.src >= 0:
                    self.graph.fresh_kill[t.src] = tuple(dict.fromkeys(self.graph.fresh_kill.get(t.src, ()) + t.fresh_kill))
