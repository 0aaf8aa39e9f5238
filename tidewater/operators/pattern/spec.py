"""How a sequence pattern is written down.

A pattern is an immutable chain of steps. Conditions are SQL text over the
event columns, so a pattern can be kept as data (``to_json`` / ``from_json``)
and its conditions run inside Catalyst.
"""

from __future__ import annotations

import json
import operator
from collections.abc import Callable
from dataclasses import asdict, dataclass, replace
from datetime import timedelta

STRICT, RELAXED, ANY = "strict", "relaxed", "any"


class PatternError(ValueError):
    """The pattern is not well formed, or cannot be run without a bound."""


@dataclass(frozen=True)
class Running:
    """Condition on an aggregate of a field over an already matched step.

    ``sum(step.field) + current.field  op  limit``
    """

    step: str
    field: str
    op: str
    limit: float
    agg: str = "sum"
    with_current: bool = True

    def holds(self, event: dict, matched: Callable[[str], list[dict]]) -> bool:
        values = [e[self.field] for e in matched(self.step)]
        if self.with_current:
            values.append(event[self.field])
        if not values:
            return False
        total = {"sum": sum, "min": min, "max": max, "count": len}[self.agg](values)
        return COMPARE[self.op](total, self.limit)


COMPARE = {">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le, "=": operator.eq}


@dataclass(frozen=True)
class Skip:
    """What to do after a match: none, next, past_last, to_first or to_last."""

    kind: str = "none"
    step: str | None = None
    error_on_miss: bool = False


@dataclass(frozen=True)
class Step:
    name: str
    contiguity: str
    condition: str | None = None
    iterative: tuple = ()
    negated: bool = False
    low: int = 1
    high: int | None = 1
    quantified: bool = False
    optional_: bool = False
    greedy_: bool = False
    inner: str = RELAXED
    until_: str | None = None
    group: tuple["Step", ...] | None = None

    @property
    def loops(self) -> bool:
        return self.high is None

    @property
    def single(self) -> bool:
        return not self.quantified


@dataclass(frozen=True)
class Pattern:
    steps: tuple[Step, ...]
    within_: timedelta | None = None
    skip: Skip = Skip()

    # Chain

    def _add(self, step: Step) -> "Pattern":
        return replace(self, steps=(*self.steps, step))

    def _follow(self, name, contiguity: str) -> "Pattern":
        if isinstance(name, Pattern):
            return self._add(_as_group(name, contiguity, len(self.steps)))._merge_within(name)
        return self._add(Step(name, contiguity))

    def _merge_within(self, other: "Pattern") -> "Pattern":
        bounds = [w for w in (self.within_, other.within_) if w]
        return replace(self, within_=min(bounds) if bounds else None)

    def next(self, name) -> "Pattern":
        return self._follow(name, STRICT)

    def followed_by(self, name) -> "Pattern":
        return self._follow(name, RELAXED)

    def followed_by_any(self, name) -> "Pattern":
        return self._follow(name, ANY)

    def _not(self, name: str, contiguity: str) -> "Pattern":
        if self.last.optional_:
            raise PatternError("a negated step cannot follow an optional one")
        return self._add(Step(name, contiguity, negated=True))

    def not_next(self, name: str) -> "Pattern":
        return self._not(name, STRICT)

    def not_followed_by(self, name: str) -> "Pattern":
        return self._not(name, RELAXED)

    # Conditions of the last step

    @property
    def last(self) -> Step:
        return self.steps[-1]

    def _edit(self, **changes) -> "Pattern":
        return replace(self, steps=(*self.steps[:-1], replace(self.last, **changes)))

    def where(self, *conditions) -> "Pattern":
        self._plain_step("where")
        text, extra = self.last.condition, list(self.last.iterative)
        for c in conditions:
            if isinstance(c, str):
                text = c if text is None else f"({text}) AND ({c})"
            else:
                extra.append(c)
        return self._edit(condition=text, iterative=tuple(extra))

    def or_(self, condition: str) -> "Pattern":
        self._plain_step("or_")
        if self.last.iterative:
            raise PatternError("or_ joins SQL conditions; put the alternative into the iterative condition")
        old = self.last.condition
        return self._edit(condition=condition if old is None else f"({old}) OR ({condition})")

    def subtype(self, value: str, column: str = "type") -> "Pattern":
        quoted = value.replace("'", "''")
        return self.where(f"{column} = '{quoted}'")

    def _plain_step(self, what: str) -> None:
        if self.last.group is not None:
            raise PatternError(f"{what} is not allowed on a group")

    # Quantifiers of the last step

    def _quantify(self, low: int, high: int | None) -> "Pattern":
        if self.last.negated:
            raise PatternError("a negated step takes no quantifier")
        if self.last.quantified:
            raise PatternError("the step has a quantifier already")
        if low == 0:
            return self.optional()._quantify(1, high)
        if low < 0 or (high is not None and high < low):
            raise PatternError("times needs 0 <= from <= to")
        return self._edit(low=low, high=high, quantified=True)

    def times(self, low: int, high: int | None = None) -> "Pattern":
        if low == 0 and high in (None, 0):
            raise PatternError("times needs a positive count")
        return self._quantify(low, low if high is None else high)

    def one_or_more(self) -> "Pattern":
        return self._quantify(1, None)

    def times_or_more(self, low: int) -> "Pattern":
        return self._quantify(low, None)

    def optional(self) -> "Pattern":
        if self.last.negated:
            raise PatternError("a negated step cannot be optional")
        if self.last.optional_:
            raise PatternError("the step is optional already")
        if self.last.greedy_:
            raise PatternError("optional must come before greedy")
        return self._edit(optional_=True)

    def greedy(self) -> "Pattern":
        if self.last.group is not None:
            raise PatternError("greedy is not allowed on a group")
        if self.last.single:
            raise PatternError("greedy needs a loop or times")
        if self.last.inner == ANY:
            raise PatternError("greedy excludes allow_combinations")
        return self._edit(greedy_=True)

    def _inner(self, contiguity: str) -> "Pattern":
        if self.last.single:
            raise PatternError("only a loop or times has inner contiguity")
        if self.last.inner != RELAXED:
            raise PatternError("inner contiguity is set already")
        if contiguity == ANY and self.last.greedy_:
            raise PatternError("greedy excludes allow_combinations")
        return self._edit(inner=contiguity)

    def consecutive(self) -> "Pattern":
        return self._inner(STRICT)

    def allow_combinations(self) -> "Pattern":
        return self._inner(ANY)

    def until(self, condition: str) -> "Pattern":
        if self.last.until_ is not None:
            raise PatternError("the step has a stop condition already")
        if not self.last.loops:
            raise PatternError("until needs a looping step")
        return self._edit(until_=condition)

    # Whole pattern

    def within(self, span: timedelta) -> "Pattern":
        return replace(self, within_=min(span, self.within_) if self.within_ else span)

    def after_match(self, skip: Skip) -> "Pattern":
        return replace(self, skip=skip)

    def names(self) -> list[str]:
        def walk(steps):
            for s in steps:
                if s.group is not None:
                    yield from walk(s.group)
                elif not s.negated:
                    yield s.name

        return list(walk(self.steps))

    def check(self) -> "Pattern":
        def walk(steps):
            for s in steps:
                if s.group is not None:
                    yield from walk(s.group)
                else:
                    yield s

        flat = list(walk(self.steps))
        seen = set()
        for s in flat:
            if s.name in seen:
                raise PatternError(f"step name {s.name} is used twice")
            seen.add(s.name)
        if self.last.negated and self.last.contiguity == RELAXED:
            raise PatternError("not_followed_by cannot be the last step")
        if self.skip.kind in ("to_first", "to_last") and self.skip.step not in self.names():
            raise PatternError(f"skip target {self.skip.step} is not a step")
        return self

    # As data

    def to_json(self) -> str:
        body = asdict(self)
        body["within_"] = self.within_.total_seconds() if self.within_ else None
        return json.dumps(body)

    @staticmethod
    def from_json(text: str) -> "Pattern":
        body = json.loads(text)

        def step(d):
            d = dict(d)
            d["iterative"] = tuple(Running(**r) for r in d.get("iterative", ()))
            if d.get("group") is not None:
                d["group"] = tuple(step(x) for x in d["group"])
            return Step(**d)

        w = body.get("within_")
        return Pattern(
            tuple(step(s) for s in body["steps"]), timedelta(seconds=w) if w else None, Skip(**body.get("skip", {})),
        ).check()


def begin(name, skip: Skip = Skip()) -> Pattern:
    if isinstance(name, Pattern):
        return Pattern((_as_group(name, STRICT, 0),), name.within_, skip)
    return Pattern((Step(name, STRICT),), None, skip)


def _as_group(p: Pattern, contiguity: str, at: int) -> Step:
    return Step(f"__group{at}", contiguity, group=p.steps)
