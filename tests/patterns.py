"""Patterns the differential tests run."""

from datetime import timedelta

from tidewater.operators.pattern.spec import begin

L = lambda x: f"label = '{x}'"


def b(name="a", cond="A"):
    return begin(name).where(L(cond))


PATTERNS = {
    "single": b(),
    "strict": b().next("b").where(L("B")),
    "strict3": b().next("a2").where(L("A")).next("b").where(L("B")),
    "relaxed": b().followed_by("b").where(L("B")),
    "relaxed3": b().followed_by("b").where(L("B")).followed_by("c").where(L("C")),
    "mixed": b().followed_by("b").where(L("B")).next("c").where(L("C")),
    "mixed2": b().next("b").where(L("B")).followed_by("c").where(L("C")),
    "same": b().followed_by("a2").where(L("A")).followed_by("a3").where(L("A")),
    "free": b().next("any"),
    "not_next": b().not_next("n").where(L("N")).followed_by("b").where(L("B")),
    "not_next_strict": b().not_next("n").where(L("N")).next("b").where("label <> 'A'"),
    "not_next_last": b().next("b").where(L("B")).not_next("n").where(L("N")),
    "not_followed": b().not_followed_by("n").where(L("N")).followed_by("b").where(L("B")),
    "not_followed_mid": b().not_followed_by("n").where(L("N")).followed_by("b").where(L("B")).followed_by("c").where(L("C")),
    "not_same_last": b().not_followed_by("n").where("label in ('N', 'B')").followed_by("b").where(L("B")),
    "not_same_mid": b().not_followed_by("n").where("label in ('N', 'B')").followed_by("b").where(L("B")).next("c"),
    "two_nots": b().not_followed_by("n").where(L("N")).not_followed_by("m").where(L("C")).followed_by("b").where(L("B")),
    "optional": b().next("b").where(L("B")).optional().next("c").where(L("C")),
    "optional_relaxed": b().followed_by("b").where(L("B")).optional().followed_by("c").where(L("C")),
    "optional_first": begin("a").where(L("A")).optional().followed_by("b").where(L("B")),
    "optional_last": b().followed_by("b").where(L("B")).optional(),
    "not_optional": b().not_followed_by("n").where(L("N")).followed_by("b").where(L("B")).optional().followed_by("c").where(L("C")),
    "optional_not": b().followed_by("b").where(L("B")).followed_by("c").where(L("C")).optional().followed_by("d").where("label <> 'N'"),
    "times": b().times(2).followed_by("b").where(L("B")),
    "times_strict": b().times(2).consecutive().next("b").where(L("B")),
    "times_range": b().times(1, 3).followed_by("b").where(L("B")),
    "times_range_last": b().next("b").where(L("B")).times(1, 2),
    "times_range_greedy": b().times(1, 2).greedy().followed_by("b").where("label in ('A', 'B')"),
    "times_mid": b().followed_by("b").where(L("B")).times(2).consecutive().followed_by("c").where(L("C")),
    "times_not": b().times(2).not_followed_by("n").where(L("N")).followed_by("b").where(L("B")),
    "zero_times": b().followed_by("b").where(L("B")).times(0, 2).followed_by("c").where(L("C")),
}
LOOPS = {
    "any": b().followed_by_any("b").where(L("B")),
    "any3": b().followed_by_any("b").where(L("B")).followed_by_any("c").where(L("C")),
    "plus": b().one_or_more().followed_by("b").where(L("B")),
    "plus_last": b().followed_by("b").where(L("B")).one_or_more(),
    "plus_consecutive": begin("c").where(L("C")).followed_by("a").where(L("A")).one_or_more().consecutive().followed_by("b").where(L("B")),
    "plus_combinations": b().one_or_more().allow_combinations().followed_by("b").where(L("B")),
    "plus_greedy": b().one_or_more().greedy().followed_by("b").where("label in ('A', 'B')"),
    "plus_greedy_next": b().one_or_more().consecutive().greedy().next("b"),
    "plus_until": b().one_or_more().until(L("C")).followed_by("b").where(L("B")),
    "plus_greedy_until": b().one_or_more().greedy().until(L("C")).followed_by("b").where("label in ('A', 'B')"),
    "star": begin("b").where(L("B")).followed_by("a").where(L("A")).one_or_more().optional().followed_by("c").where(L("C")),
    "two_or_more": b().times_or_more(2).followed_by("b").where(L("B")),
    "plus_not": b().one_or_more().not_followed_by("n").where(L("N")).followed_by("b").where(L("B")),
    "any_not": b().not_followed_by("n").where(L("N")).followed_by_any("b").where(L("B")),
    "plus_not_next": b().one_or_more().not_next("n").where(L("N")).followed_by("b").where(L("B")),
    "times_combinations": b().times(2).allow_combinations().followed_by("b").where(L("B")),
}
SECOND = timedelta(seconds=1)
