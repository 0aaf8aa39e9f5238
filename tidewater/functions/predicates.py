"""Predicates Spark SQL has no keyword for, as plain Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def between_symmetric(x: Column, a: Column, b: Column) -> Column:
    """``x BETWEEN SYMMETRIC a AND b``; a NULL bound gives NULL."""
    return x.between(a, b) | x.between(b, a)


def similar_regex(pattern: str, escape: str | None = None) -> str:
    """Java regex with the meaning of a ``SIMILAR TO`` pattern."""
    out, literal_next, in_class = [], False, False
    for ch in pattern:
        if literal_next:
            out.append("\\" + ch if not ch.isalnum() else ch)
            literal_next = False
        elif escape is not None and ch == escape:
            literal_next = True
        elif in_class:
            out.append("\\\\" if ch == "\\" else ch)
            in_class = ch != "]"
        elif ch == "%":
            out.append(".*")
        elif ch == "_":
            out.append(".")
        elif ch == "[":
            out.append(ch)
            in_class = True
        elif ch in ".^$\\":
            out.append("\\" + ch)
        else:
            out.append(ch)
    if literal_next:
        raise ValueError("pattern ends with its escape character")
    return "(?s)^(?:" + "".join(out) + ")$"


def similar_to(x: Column, pattern: str, escape: str | None = None) -> Column:
    return x.rlike(similar_regex(pattern, escape))


def is_true(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def is_false(c: Column) -> Column:
    return F.coalesce(~c, F.lit(False))


def is_unknown(c: Column) -> Column:
    return c.isNull()


def is_distinct_from(a: Column, b: Column) -> Column:
    return ~a.eqNullSafe(b)


# Period relations. A period is a (start, end) pair in either order.

Period = tuple[Column, Column]


def _ends(p: Period) -> Period:
    a, b = p
    known = a.isNotNull() & b.isNotNull()
    return F.when(known, F.least(a, b)), F.when(known, F.greatest(a, b))


def overlaps(p: Period, q: Period) -> Column:
    (s1, e1), (s2, e2) = _ends(p), _ends(q)
    return (s1 < e2) & (s2 < e1)


def contains(p: Period, q: Period) -> Column:
    (s1, e1), (s2, e2) = _ends(p), _ends(q)
    return (s1 <= s2) & (e2 <= e1)


def precedes(p: Period, q: Period) -> Column:
    return _ends(p)[1] <= _ends(q)[0]


def immediately_precedes(p: Period, q: Period) -> Column:
    return _ends(p)[1] == _ends(q)[0]


def succeeds(p: Period, q: Period) -> Column:
    return precedes(q, p)


def immediately_succeeds(p: Period, q: Period) -> Column:
    return immediately_precedes(q, p)


def period_equals(p: Period, q: Period) -> Column:
    (s1, e1), (s2, e2) = _ends(p), _ends(q)
    return (s1 == s2) & (e1 == e2)
