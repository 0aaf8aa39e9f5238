"""Multiset operators on arrays. Order of the result is unspecified."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _times(bag: Column, x: Column) -> Column:
    """How often ``x`` is in the bag; NULL counts as a value."""
    nulls = F.size(bag) - F.size(F.array_compact(bag))
    return F.when(x.isNull(), nulls).otherwise(F.size(bag) - F.size(F.array_remove(bag, x)))


def _repeated(values: Column, times) -> Column:
    return F.flatten(F.transform(values, lambda x: F.array_repeat(x, times(x))))


def union_all(a: Column, b: Column) -> Column:
    return F.concat(a, b)


def union_distinct(a: Column, b: Column) -> Column:
    return F.array_union(a, b)


def intersect_all(a: Column, b: Column) -> Column:
    return _repeated(F.array_intersect(a, b), lambda x: F.least(_times(a, x), _times(b, x)))


def intersect_distinct(a: Column, b: Column) -> Column:
    return F.array_intersect(a, b)


def except_all(a: Column, b: Column) -> Column:
    """Each element of ``b`` removes one equal element of ``a``."""
    return _repeated(F.array_distinct(a), lambda x: F.greatest(_times(a, x) - _times(b, x), F.lit(0)))


def except_distinct(a: Column, b: Column) -> Column:
    return F.array_except(a, b)


def member_of(x: Column, bag: Column) -> Column:
    return F.array_contains(bag, x)


def submultiset_of(a: Column, b: Column) -> Column:
    return F.size(except_all(a, b)) == 0


def is_a_set(bag: Column) -> Column:
    return F.size(F.array_distinct(bag)) == F.size(bag)


def is_empty(bag: Column) -> Column:
    return F.when(bag.isNotNull(), F.size(bag) == 0)


def item(coll: Column, key) -> Column:
    """``arr[i]`` counting from 1, or ``map[k]``; NULL when absent."""
    return F.try_element_at(coll, key if isinstance(key, Column) else F.lit(key))


def element(bag: Column) -> Column:
    """The only element; an error when there is more than one, NULL when none."""
    return F.when(
        F.size(bag) > 1, F.raise_error(F.lit("ELEMENT: more than one value"))
    ).otherwise(F.try_element_at(bag, F.lit(1)))


def slice_field(rows: Column, field: str) -> Column:
    """One field of every record."""
    return F.transform(rows, lambda r: r[field])
