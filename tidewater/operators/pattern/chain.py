"""Patterns as window functions.

Every path of a loop-free pattern graph is a chain of waits, each decided by one
row: the next row (strict) or the first row that is wanted or forbidden
(relaxed). Going from the last wait back to the first, the outcome of "wait from
here" is a value that the deciding row hands back to the rows before it, that
is ``last(value, ignorenulls)`` over rows sorted descending. All waits share one
partitioning and sort, so the events are shuffled once.

Rows are partitioned by (key, time chunk). A wait that runs off the end of its
chunk stays open, and is closed from a table with one row per chunk, which holds
what each kind of wait meets from the start of the next chunk on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators import sequence as S
from tidewater.operators.pattern.graph import END, START, Edge, Graph
from tidewater.operators.pattern.spec import RELAXED, STRICT, PatternError, Running

DONE, DEAD = 0, -1


def lowerable(graph: Graph):
    """The graph's paths when all of them can run as window functions."""
    paths = graph.paths()
    if paths is None:
        return None
    for path in paths:
        for src, e in path:
            if e.target == END or not graph.slots[e.target].iterative:
                continue
            # A running condition can be tested on the finished chain only
            # where a failure cannot be waited out.
            if e.mode != STRICT or not all(isinstance(i, Running) for i in graph.slots[e.target].iterative):
                return None
    return paths


def packed(graph: Graph) -> Column:
    """All conditions of a row as one number; NULL counts as false. One column
    for all uses keeps the shuffled rows small and the same for each use."""
    if len(graph.conditions) > 62:
        raise PatternError("more than 62 distinct conditions")
    terms = [f"IF(coalesce(CAST({t} AS BOOLEAN), false), {1 << i}L, 0L)" for i, t in enumerate(graph.conditions)]
    return F.expr(" + ".join(terms) or "0L")


def _k(i: int) -> str:
    return f"(__bits & {1 << i}L <> 0)"


def relevant(df: DataFrame, graph: Graph) -> DataFrame:
    """Drop rows no condition wants, where such rows cannot change a match.

    That is so if nothing depends on which row comes next: no strict step, and
    nothing that holds for the next row only. The filter reaches the scan.
    """
    for src, edges in graph.edges.items():
        for e in edges:
            if src != START and (e.mode == STRICT or e.need or e.veto or set(graph.fresh_kill.get(src, ())) != set(e.kill)):
                return df
    return df.where(" OR ".join(f"({t})" for t in graph.conditions))


def _any(ids) -> str:
    return "(" + " OR ".join(_k(i) for i in ids) + ")" if ids else "false"


def _all(ids) -> str:
    return "(" + " AND ".join(_k(i) for i in ids) + ")" if ids else "true"


class Lowering:
    """Expressions are SQL text: a plan has hundreds, and text is built in one call."""

    def __init__(self, df: DataFrame, seq: S.Sequence, graph: Graph, paths, event: Column, keep_dead: bool = False):
        self.seq, self.graph, self.paths, self.keep_dead = seq, graph, paths, keep_dead
        d = S.chunked(df, seq).withColumns({"__bits": packed(graph), "__ev": event, "__ts": F.col(seq.ts).cast("timestamp")})
        self.d = d.select(S.KEY, S.CHUNK, S.ORD, "__ev", "__ts", "__bits")
        item = self.d.select(F.expr(f"array({self._item(0)})").alias("i")).schema["i"].dataType
        self.empty = f"cast(array() AS {item.simpleString()})"
        waits = {tuple(p[i:]) for p in paths for i in range(1, len(p))}
        self.waits = sorted(waits, key=len)
        self.number = {w: n for n, w in enumerate(self.waits, start=1)}

    # Rows of a chunk from the last to the first.
    W = f"PARTITION BY {S.KEY}, {S.CHUNK} ORDER BY {S.ORD} DESC"
    BEFORE = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    UPTO = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    DOWN = f"PARTITION BY {S.KEY} ORDER BY {S.CHUNK} DESC"

    @staticmethod
    def _item(slot: int) -> str:
        return f"named_struct('slot', {slot}, 'e', __ev)"

    def _res(self, st, items: str | None = None, dead: str = "cast(null AS timestamp)") -> str:
        return f"named_struct('st', {st}, 'items', {items or self.empty}, 'dead', {dead})"

    def _dead(self) -> str:
        # The time of death matters to timeouts only; without it both uses of
        # the rows need the same columns and share one exchange.
        return self._res(DEAD, dead="__ts") if self.keep_dead else self._res(DEAD)

    def _prepend(self, slot: int, rest) -> str:
        one = f"array({self._item(slot)})"
        if not rest:
            return self._res(DONE, one)
        r = f"__r{self.number[rest]}"
        return self._res(f"{r}.st", f"concat({one}, {r}.items)", f"{r}.dead")

    def _outcome(self, e: Edge, rest, killed: str) -> str:
        """Outcome if this row decides the wait."""
        dead = self._dead()
        if e.target == END:
            return f"CASE WHEN {killed} THEN {dead} ELSE {self._res(DONE)} END"
        ok = f"{_k(self.graph.slots[e.target].condition)} AND NOT {_any(e.take_not)}"
        if rest:
            # A forbidden row still ends the match as its last event.
            ok += f" AND NOT {killed}"
        return f"CASE WHEN {ok} THEN {self._prepend(e.target, rest)} ELSE {dead} END"

    def run(self) -> DataFrame:
        g = self.graph
        d = self.d.selectExpr("*", f"lag(1) OVER ({self.W}) IS NULL AS __end")
        sums = []
        for wait in self.waits:
            n, (src, e), rest = self.number[wait], wait[0], wait[1:]
            fresh_kill = _any(g.fresh_kill.get(src, ()))
            on_fresh = self._outcome(e, rest, fresh_kill)
            barred = f"WHEN NOT ({_all(e.need)} AND NOT {_any(e.veto)}) THEN {self._dead()}"
            open_ = f"CASE WHEN __end THEN {self._res(2 * n + 1)} ELSE {self._res(2 * n)} END"
            parts = [f"lag(__x{n}) OVER ({self.W})"]
            sums.append(f"min_by(__x{n}, {S.ORD}) AS __bx{n}")
            if e.mode == RELAXED:
                decides = f"({_k(g.slots[e.target].condition)} OR {_any(e.ignore_not)} OR {_any(e.kill)})"
                d = d.selectExpr(
                    "*", f"CASE {barred} WHEN {decides} OR {fresh_kill} THEN {on_fresh} END AS __x{n}",
                    f"CASE WHEN {decides} THEN {self._outcome(e, rest, _any(e.kill))} END AS __d{n}")
                parts.append(f"last(__d{n}, true) OVER ({self.W} {self.BEFORE})")
                sums.append(f"min_by(__d{n}, CASE WHEN __d{n} IS NOT NULL THEN {S.ORD} END) AS __bd{n}")
            else:
                d = d.selectExpr("*", f"CASE {barred} ELSE {on_fresh} END AS __x{n}")
            d = d.selectExpr("*", f"coalesce({', '.join(parts)}, {open_}) AS __r{n}")
        firsts = []
        for i, path in enumerate(self.paths):
            e = path[0][1]
            ok = (f"{_k(g.slots[e.target].condition)} AND NOT {_any(e.take_not)} AND {_all(e.need)} "
                  f"AND NOT {_any(e.veto)}")
            firsts.append(f"CASE WHEN {ok} THEN {self._prepend(e.target, tuple(path[1:]))} END AS __p{i}")
        ps = [f"__p{i}" for i in range(len(firsts))]
        starts = d.selectExpr(S.KEY, S.CHUNK, *firsts).where(" OR ".join(f"{p} IS NOT NULL" for p in ps))
        packed = ", ".join(f"named_struct('path', {i}, 'r', {p})" for i, p in enumerate(ps))
        out = starts.selectExpr(S.KEY, S.CHUNK, f"explode(array({packed})) AS p")
        # Failed starts are dropped before the join, and again after it.
        alive = "p.r IS NOT NULL" + ("" if self.keep_dead else f" AND p.r.st <> {DEAD}")
        out = out.where(alive).selectExpr(S.KEY, S.CHUNK, "p.path AS path", "p.r AS r")
        if self.waits:
            chunks = d.groupBy(S.KEY, S.CHUNK).agg(*[F.expr(x) for x in sums])
            out = S.join_chunks(out, self._next_chunks(chunks))
            out = out.selectExpr(S.KEY, S.CHUNK, "path", "r", "try_element_at(__next, r.st) AS f")
            joined = self._res("f.st", "concat(r.items, f.items)", "f.dead")
            out = out.selectExpr(S.KEY, S.CHUNK, "path", f"CASE WHEN f IS NULL THEN r ELSE {joined} END AS r")
        out = out.selectExpr(S.KEY, S.CHUNK, "path", "r.st AS st", "r.items AS items", "r.dead AS dead")
        return self._iterative(out if self.keep_dead else out.where(f"st <> {DEAD}"))

    def _close(self, v: str, waits) -> str:
        """Continue an open wait with what the next chunks hold for it."""
        if not waits:
            return v
        whens = []
        for m in (self.number[x] for x in waits):
            for code, f in ((2 * m, f"__nn{m}"), (2 * m + 1, f"__nf{m}")):
                joined = self._res(f"{f}.st", f"concat({v}.items, {f}.items)", f"{f}.dead")
                whens.append(f"WHEN {v}.st = {code} AND {f} IS NOT NULL THEN {joined}")
        return f"CASE WHEN {v} IS NULL OR {v}.st <= 0 THEN {v} {' '.join(whens)} ELSE {v} END"

    def _next_chunks(self, chunks: DataFrame) -> DataFrame:
        """Per chunk and wait: the outcome from the start of the next chunk on."""
        c = chunks
        for wait in self.waits:
            n, relaxed = self.number[wait], wait[0][1].mode == RELAXED
            inner = [x for x in self.waits if len(x) < len(wait) and wait[-len(x):] == x]
            first = self._close(f"__bx{n}", inner)
            if relaxed:
                c = c.selectExpr("*", f"{self._close(f'__bd{n}', inner)} AS __g{n}", f"{first} AS __h{n}")
                c = c.selectExpr("*", f"last(__g{n}, true) OVER ({self.DOWN} {self.UPTO}) AS __fn{n}")
                c = c.selectExpr("*", f"coalesce(__h{n}, __fn{n}) AS __ff{n}")
            else:
                c = c.selectExpr("*", f"{first} AS __ff{n}", f"{first} AS __fn{n}")
            c = c.selectExpr(
                "*", f"lag(__fn{n}) OVER ({self.DOWN}) AS __nn{n}", f"lag(__ff{n}) OVER ({self.DOWN}) AS __nf{n}")
        pairs = [f"{2 * n}, __nn{n}, {2 * n + 1}, __nf{n}" for n in (self.number[x] for x in self.waits)]
        return c.selectExpr(S.KEY, S.CHUNK, f"map({', '.join(pairs)}) AS __next")

    def _iterative(self, out: DataFrame) -> DataFrame:
        for i, path in enumerate(self.paths):
            names = [self.graph.slots[e.target].name for _, e in path if e.target != END]
            for at, (_, e) in enumerate(path):
                if e.target == END:
                    continue
                for cond in self.graph.slots[e.target].iterative:
                    want = [j for j in range(at) if names[j] == cond.step] + ([at] if cond.with_current else [])
                    total = _total(cond.agg, [f"items[{j}].e.`{cond.field}`" for j in want])
                    out = out.where(f"path <> {i} OR st <> {DONE} OR coalesce({total} {cond.op} {cond.limit}, false)")
        return out


def _total(agg: str, values: list[str]) -> str:
    if not values:
        return "cast(null AS double)"
    if agg == "count":
        return str(len(values))
    if agg == "sum":
        return "(" + " + ".join(values) + ")"
    pick = "least" if agg == "min" else "greatest"
    return f"{pick}({', '.join(values)})" if len(values) > 1 else values[0]
