"""The event-by-event machine against the slow matcher, without Spark."""

import random

import pytest
from brute import matches
from patterns import LOOPS, PATTERNS

from tidewater.operators.pattern.graph import build
from tidewater.operators.pattern.local import Event, Machine, run_group


def holds(text, row):
    label = row["label"]
    if text == "true":
        return True
    if text.startswith("label = "):
        return label == text.split("'")[1]
    if text.startswith("label <> "):
        return label != text.split("'")[1]
    assert text.startswith("label in ")
    return label in text.split("'")[1::2]


def by_machine(pattern, events, within):
    g = build(pattern)
    evs = [Event(t, sum(1 << i for i, c in enumerate(g.conditions) if holds(c, r)), j, r) for j, (t, r) in enumerate(events)]
    found, _ = run_group(Machine(g, within), evs, [True] * len(evs), None)
    return [tuple((g.slots[s].name, e.ref) for s, e in m) for m in found]


@pytest.mark.parametrize("name", list(PATTERNS) + list(LOOPS))
def test_machine_equals_brute_force(name):
    pattern = {**PATTERNS, **LOOPS}[name]
    rnd = random.Random(name)
    seen = 0
    for _ in range(150):
        n = rnd.randint(1, 9)
        events = [(j // 2, {"label": rnd.choice("ABCN")}) for j in range(n)]
        for within in (None, 3):
            want = sorted(matches(pattern.steps, events, holds, within))
            got = sorted(by_machine(pattern, events, within))
            assert got == want, (events, within)
            seen += len(want)
    assert seen > 5 or name == "not_same_mid"  # a forbidden row always comes first there


def labels(text):
    return [(j, {"label": x[0]}) for j, x in enumerate(text.split())]


def test_documented_consecutive_example():
    got = by_machine(LOOPS["plus_consecutive"], labels("C D A1 A2 A3 D A4 B"), None)
    assert sorted("".join(str(j) for _, j in m) for m in got) == ["02347", "0237", "027"]


def test_documented_loop_examples():
    got = by_machine(LOOPS["plus"], labels("A1 A2 B"), None)
    assert sorted(tuple(j for _, j in m) for m in got) == [(0, 1, 2), (0, 2), (1, 2)]
    got = by_machine(LOOPS["plus_combinations"], labels("A1 A2 A3 B"), None)
    assert (0, 2, 3) in [tuple(j for _, j in m) for m in got]
