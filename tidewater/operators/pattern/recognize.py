"""MATCH_RECOGNIZE as a function.

The row pattern is built from small parts (``var``, ``seq``, ``alt``, ...). A
pattern of bounded length is spelled out into its variants, in order of
preference, which run as window functions; among the variants that match at a
start the most preferred wins. A pattern with ``*`` or ``+``, or of more variants than a plan
can hold, runs as an automaton over chunks of each key, however long its matches. With
``within`` its (key, time chunk) groups are matched as strings of row classes by a regular
expression, whose backtracking has the required preferences.
"""

from __future__ import annotations

from collections.abc import Sequence as Seq
from dataclasses import dataclass
from datetime import timedelta
from itertools import permutations, product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators import sequence as S
from tidewater.operators.pattern import chain, skip as skips
from tidewater.operators.pattern.api import _by_chain
from tidewater.operators.pattern.automaton import by_automaton
from tidewater.operators.pattern.graph import START, Edge, Graph, Slot
from tidewater.operators.pattern.groups import match_groups
from tidewater.operators.pattern.spec import STRICT, PatternError, Skip

MAX_VARIANTS = 64


@dataclass(frozen=True)
class Node:
    """Part of a row pattern: kind in var, seq, alt, repeat, exclude, start, end."""

    kind: str
    parts: tuple = ()
    name: str = ""
    low: int = 1
    high: int | None = 1
    greedy: bool = True

    def times(self, low: int, high: int | None = -1, greedy: bool = True) -> "Node":
        high = low if high == -1 else high
        if low < 0 or (high is not None and high < low):
            raise PatternError("repeat needs 0 <= low <= high")
        return Node("repeat", (self,), low=low, high=high, greedy=greedy)

    def plus(self, greedy: bool = True) -> "Node":
        return self.times(1, None, greedy)

    def star(self, greedy: bool = True) -> "Node":
        return self.times(0, None, greedy)

    def opt(self, greedy: bool = True) -> "Node":
        return self.times(0, 1, greedy)


def var(name: str) -> Node:
    return Node("var", name=name)


def _node(x) -> Node:
    return x if isinstance(x, Node) else var(x)


def seq(*parts) -> Node:
    return Node("seq", tuple(_node(p) for p in parts))


def alt(*parts) -> Node:
    return Node("alt", tuple(_node(p) for p in parts))


def permute(*parts) -> Node:
    """All orders, earlier listed parts preferred first."""
    return Node("alt", tuple(seq(*p) for p in permutations([_node(x) for x in parts])))


def exclude(part) -> Node:
    """``{- part -}``: matched but left out of the rows."""
    return Node("exclude", (_node(part),))


AT_START, AT_END = Node("start"), Node("end")


def variants(node: Node) -> list[tuple] | None:
    """Spelled-out row sequences by preference; None when unbounded or too many.

    Each is a tuple of (variable, excluded, anchor) triples.
    """
    if node.kind == "var":
        return [((node.name, False),)]
    if node.kind in ("start", "end"):
        return [((node.kind, None),)]
    if node.kind == "exclude":
        inner = variants(node.parts[0])
        return inner and [tuple((n, True if x is not None else None) for n, x in v) for v in inner]
    if node.kind == "alt":
        each = [variants(p) for p in node.parts]
        return None if None in each else _few([v for vs in each for v in vs])
    if node.kind == "seq":
        each = [variants(p) for p in node.parts]
        return None if None in each else _few([sum(c, ()) for c in product(*each)])
    if node.high is None:
        return None
    inner = variants(node.parts[0])
    if inner is None:
        return None
    return _few(_repeat(inner, node.low, node.high, node.greedy))


def _repeat(inner, low, high, greedy) -> list[tuple]:
    """Preference order of a bounded repeat: greedy prefers going on."""
    if high == 0:
        return [()]
    go_on = [a + b for a in inner for b in _repeat(inner, max(low - 1, 0), high - 1, greedy)]
    if low > 0:
        return go_on
    return [*go_on, ()] if greedy else [(), *go_on]


def _few(vs):
    return vs if len(vs) <= MAX_VARIANTS else None


def first_of(step: str, field: str, n: int = 0) -> str:
    """FIRST(step.field, n) as a measure."""
    return f"try_element_at({step}, {n + 1}).{field}"


def last_of(step: str, field: str, n: int = 0) -> str:
    """LAST(step.field, n) as a measure."""
    return f"try_element_at({step}, {-n - 1}).{field}"


def match_recognize(
    df: DataFrame, partition_by: Seq[str], order_by: str, pattern: Node, define: dict[str, str], measures: dict[str, str],
    tie: Seq[str] = (), navigate: dict[str, tuple[str, int]] | None = None, rows_per_match: str = "one",
    after_match: Skip = Skip("past_last"), within: timedelta | None = None, subset: dict[str, Seq[str]] | None = None,
    final: dict[str, str] | None = None, payload: Seq[str] | None = None, width: timedelta | None = None,
) -> DataFrame:
    """Rows: partition columns, ``match_number`` and measures; with
    ``rows_per_match="all"`` one row per matched row, with its columns and
    ``classifier``, where ``measures`` run up to the row and ``final`` see the
    whole match.

    ``define`` maps variables to SQL conditions (missing: true). ``navigate``
    names neighbours for conditions and measures: ``{"prev_v": ("v", 1)}`` is
    PREV(v), a negative step is NEXT. Measures are SQL over one array of rows
    per variable (see ``first_of``, ``last_of``).
    """
    names = _variables(pattern)
    vs = variants(pattern)
    # Patterns without a time bound have no reach, so their chunks are measured.
    seq_ = S.sequence(df, partition_by, order_by, tie, width or (within * 4 if vs is None and within else None))
    d = _navigated(df, seq_, navigate or {}, pattern)
    cols = list(dict.fromkeys([order_by, *tie, *(payload or [c for c in d.columns if c not in (*partition_by, "__first", "__last")])]))
    event = F.struct(*[F.col(c) for c in cols])
    us = S.micros(within) if within else None
    if vs is not None:
        found, slots = _spelled(d, seq_, vs, define, event, order_by, us)
    elif within is None:
        found, slots = by_automaton(d, seq_, pattern, names, define, event, after_match.kind == "past_last")
    else:
        found, slots = _by_regex(d, seq_, pattern, names, define, event, within)
    tie_fields = [c for c in tie if c != order_by]
    ord_of = lambda e: F.struct(
        F.unix_micros(e[order_by].cast("timestamp")).alias("t"), *[e[c].alias(f"o{i}") for i, c in enumerate(tie_fields)])
    found = found.withColumns({"__so": ord_of(F.element_at("items", 1)["e"]), "__eo": ord_of(F.element_at("items", -1)["e"])})
    # One match per start: the most preferred.
    found = found.groupBy(S.KEY, S.CHUNK, "__so").agg(F.min_by(F.struct("items", "__eo", "__no"), "__no").alias("m")) \
        .select(S.KEY, S.CHUNK, "__so", "m.*")
    g = Graph(slots=[Slot(n, 0) for n, _ in slots])
    if after_match.kind not in ("none", "next"):
        found = found.withColumn("__po", skips.pivot_ord(after_match, g, ord_of, F.col("__eo")))
        found = skips.apply_skip(found, after_match)
    found = found.select(S.KEY, F.element_at("items", 1)["e"][order_by].alias("__start"), F.col("__so").alias("__tie"), "items")
    numbered = S.positions(
        found.select(F.col(S.KEY).alias("__part"), "__start", "__tie", "items"),
        S.Sequence(("__part",), "__start", ("__tie",), seq_.width), "match_number")
    keys = [F.col("__part")[k].alias(k) for k in partition_by]
    groups = {n: [i for i, (m, _) in enumerate(slots) if m == n] for n in names}
    for u, members in (subset or {}).items():
        groups[u] = [i for m in members for i in groups[m]]
    arrays = lambda items: [
        F.transform(F.filter(items, lambda x: x["slot"].isin(ids)), lambda x: x["e"]).alias(n) for n, ids in groups.items()]
    exprs = lambda ms: [F.expr(text).alias(n) for n, text in ms.items()]
    if rows_per_match == "one":
        out = numbered.select(*keys, "match_number", *arrays(F.col("items")))
        return out.select(*partition_by, "match_number", *exprs({**measures, **(final or {})}))
    out = numbered.select(*keys, "match_number", "items", *arrays(F.col("items")))
    out = out.select("*", *exprs(final or {})).drop(*groups)
    out = out.select("*", F.posexplode("items").alias("__at", "__row"))
    shown = [i for i, (_, hidden) in enumerate(slots) if not hidden]
    labels = F.array(*[F.lit(n) for n, _ in slots])
    out = out.where(F.col("__row.slot").isin(shown)).select(
        *partition_by, "match_number", *(final or {}), F.element_at(labels, F.col("__row.slot") + 1).alias("classifier"),
        F.col("__row.e").alias("__e"), *arrays(F.slice("items", 1, F.col("__at") + 1)))
    return out.select(*partition_by, "match_number", "classifier", *(final or {}), *exprs(measures), "__e.*")


def _variables(node: Node) -> list[str]:
    if node.kind == "var":
        return [node.name]
    return list(dict.fromkeys(n for p in node.parts for n in _variables(p)))


def _has(node: Node, kind: str) -> bool:
    return node.kind == kind or any(_has(p, kind) for p in node.parts)


def _navigated(df, seq_, navigate, pattern) -> DataFrame:
    d = df
    by_step: dict[int, dict] = {}
    for name, (col, k) in navigate.items():
        by_step.setdefault(k, {})[name] = F.col(col)
    if _has(pattern, "start"):
        by_step.setdefault(1, {})["__first"] = F.lit(True)
    if _has(pattern, "end"):
        by_step.setdefault(-1, {})["__last"] = F.lit(True)
    for k, values in by_step.items():
        d = S.shift(d, seq_, values, k)
    for c in ("__first", "__last"):
        if c in d.columns:
            d = d.withColumn(c, F.col(c).isNull())
    return S.unchunked(d)


def _spelled(d, seq_, vs, define, event, ts, us):
    g = Graph()
    memo: dict[tuple, int] = {}
    hidden: list[bool] = []
    paths = []
    for v in vs:
        rows = []
        for i, (n, ex) in enumerate(v):
            if ex is None:
                continue
            cond = f"({define.get(n, 'true')})"
            if i and v[i - 1] == ("start", None):
                cond += " AND __first"
            if i + 1 < len(v) and v[i + 1] == ("end", None):
                cond += " AND __last"
            rows.append((n, ex, cond))
        if not rows:
            continue
        # Equal endings share their slots, and with them their window columns.
        ids = []
        for i in range(len(rows)):
            tail = tuple(rows[i:])
            if tail not in memo:
                memo[tail] = len(g.slots)
                g.slots.append(Slot(rows[i][0], g.cond(rows[i][2])))
                hidden.append(rows[i][1])
            ids.append(memo[tail])
        paths.append([(a, Edge(b, STRICT)) for a, b in zip([START, *ids[:-1]], ids)])
    found = _by_chain(d, seq_, g, paths, event, ts, us)
    return found, [(s.name, h) for s, h in zip(g.slots, hidden)]


def _by_regex(d, seq_, pattern, names, define, event, within):
    import regex

    if len(names) > 8:
        raise PatternError("more than 8 variables in a pattern with loops")
    first_bit, last_bit = len(names), len(names) + 1
    us = S.micros(within)
    tests = [F.coalesce(F.expr(define.get(n, "true")).cast("boolean"), F.lit(False)) for n in names]
    tests += [F.col("__first") if "__first" in d.columns else F.lit(False), F.col("__last") if "__last" in d.columns else F.lit(False)]
    mask = sum((F.when(t, 1 << i).otherwise(0) for i, t in enumerate(tests)), F.lit(0)).cast("int")
    h = S.time_halo(d, seq_, after=within)
    tie = [t for t in seq_.tie if t != seq_.ts]
    h = h.select(S.KEY, S.CHUNK, seq_.ticks(h).alias("__t"), *[F.col(t).alias(f"__o{i}") for i, t in enumerate(tie)],
                 mask.alias("__mask"), "__own", event.alias("__ev"))
    code = lambda m: chr(0x4E00 + m)
    klass = lambda bit: "[" + "".join(code(m) for m in range(1 << (len(names) + 2)) if m >> bit & 1) + "]"
    slots: list[tuple[str, bool]] = []

    def text(node: Node, hide: bool) -> str:
        if node.kind == "var":
            slots.append((node.name, hide))
            return f"(?P<g{len(slots) - 1}>{klass(names.index(node.name))})"
        if node.kind == "start":
            return f"(?={klass(first_bit)})"
        if node.kind == "end":
            return f"(?<={klass(last_bit)})"
        if node.kind == "exclude":
            return text(node.parts[0], True)
        inner = [text(p, hide) for p in node.parts]
        if node.kind == "seq":
            return "".join(inner)
        if node.kind == "alt":
            return "(?:" + "|".join(inner) + ")"
        upper = "" if node.high is None else node.high
        return f"(?:{inner[0]}){{{node.low},{upper}}}" + ("" if node.greedy else "?")

    source = text(pattern, False)
    n_slots = len(slots)
    compiled: list = []

    def handle(cols: dict[str, list]):
        if not compiled:
            compiled.append(regex.compile(source))
        rx, t, own = compiled[0], cols["__t"], cols["__own"]
        s = "".join(code(m) for m in cols["__mask"])
        found, stop = [], 0
        for p in range(len(s)):
            if not own[p]:
                continue
            while stop < len(s) and t[stop] - t[p] < us:
                stop += 1
            m = rx.match(s, p, stop)
            if m is not None and m.end() > p:
                hits = sorted((a, g) for g in range(n_slots) for a, _ in m.spans(f"g{g}"))
                found.append(("match", [g for _, g in hits], [a for a, _ in hits]))
        return found

    order = ["__t", *[f"__o{i}" for i in range(len(tie))]]
    return match_groups(h, order, ["__t", "__mask", "__own"], handle), slots
