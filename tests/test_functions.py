"""Functions whose corner cases the tables do not reach."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions import bags as B
from tidewater.functions import json as J
from tidewater.functions import numeric as N
from tidewater.functions import predicates as P
from tidewater.functions import temporal as D
from tidewater.functions import udfs as U
from tidewater.operators import aggregates as A
from tidewater.operators import quantified as Q

c = F.col


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def col(spark, values, ddl):
    return spark.createDataFrame([(v,) for v in values], f"x {ddl}")


def values(df, *exprs):
    return [tuple(r) for r in df.select(*exprs).collect()]


def test_between_symmetric_null_bound(spark):
    i = lambda v: F.lit(v).cast("int")
    got = one(spark, *[P.between_symmetric(i(x), i(a), i(b)).alias(f"c{n}") for n, (x, a, b) in enumerate(
        [(2, 3, 1), (4, 3, 1), (2, None, 1), (2, 3, None), (None, 1, 2)])])
    assert tuple(got) == (True, False, None, None, None)


@pytest.mark.parametrize("text,pattern,escape,want", [
    ("abc", "a%", None, True), ("abc", "a_", None, False), ("abab", "(ab)+", None, True), ("a.c", "a.c", None, True),
    ("axc", "a.c", None, False), ("b", "[a-c]", None, True), ("a%", "a!%", "!", True), ("ab", "a!%", "!", False), ("a\nb", "a%b", None, True)])
def test_similar_to(spark, text, pattern, escape, want):
    assert one(spark, P.similar_to(F.lit(text), pattern, escape).alias("x")).x is want


def test_periods(spark):
    p = lambda a, b: (F.lit(a), F.lit(b))
    got = one(spark, P.overlaps(p(3, 1), p(2, 5)).alias("a"), P.overlaps(p(1, 2), p(2, 3)).alias("b"), P.contains(p(1, 9), p(4, 2)).alias("c"),
              P.immediately_precedes(p(1, 2), p(2, 3)).alias("d"), P.immediately_succeeds(p(2, 3), p(1, 2)).alias("e"),
              P.precedes(p(1, 2), p(3, 4)).alias("f"), P.succeeds(p(1, 2), p(3, 4)).alias("g"), P.period_equals(p(1, 2), p(2, 1)).alias("h"))
    assert tuple(got) == (True, False, True, True, True, True, False, True)


def test_truncate_and_integer_division(spark):
    got = one(spark, N.truncate(F.lit(0.29), 2).cast("double").alias("a"), N.truncate(F.lit(-1.239), 2).cast("double").alias("b"),
              N.truncate(F.lit(7.9)).cast("double").alias("c"), N.divide_integer(F.lit(-7), F.lit(2)).alias("d"))
    assert tuple(got) == (0.29, -1.23, 7.0, -3)


def test_extract_corners(spark):
    t = F.to_timestamp(F.lit("2000-12-31 23:59:59.5"))
    got = one(spark, *[D.extract(u, t).alias(u) for u in ("CENTURY", "MILLENNIUM", "DECADE", "DOW", "ISODOW", "ISOYEAR", "MILLISECOND")])
    assert tuple(got) == (20, 2, 200, 1, 7, 2000, 59500)
    with pytest.raises(ValueError):
        D.extract("FORTNIGHT", t)


def test_ceil_to_keeps_aligned(spark):
    ts = lambda s: F.to_timestamp(F.lit(s))
    got = one(spark, D.ceil_to(ts("2024-01-01 10:00:00"), "hour").alias("a"), D.ceil_to(ts("2024-01-01 10:00:01"), "hour").alias("b"))
    assert (got.a.hour, got.b.hour) == (10, 11)


def test_timestr2long(spark):
    got = values(col(spark, ["1970-01-01 00:00:01", "nope", None], "string"), D.timestr2long(c("x")))
    assert got == [(1000,), (None,), (None,)]


def test_bags(spark):
    a, b = F.array(*map(F.lit, [1, 1, 2, None])), F.array(*map(F.lit, [1, 2, 2, None, None]))
    got = one(spark, B.intersect_all(a, b).alias("i"), B.except_all(b, a).alias("e"), B.submultiset_of(F.array(F.lit(1), F.lit(1)), a).alias("s"),
              B.is_a_set(a).alias("t"), B.is_empty(F.array()).alias("m"), B.is_empty(F.lit(None).cast("array<int>")).alias("n"))
    key = lambda v: (v is None, v or 0)
    assert sorted(got.i, key=key) == [1, 2, None] and sorted(got.e, key=key) == [2, None]
    assert (got.s, got.t, got.m, got.n) == (True, False, True, None)
    with pytest.raises(Exception, match="more than one"):
        one(spark, B.element(F.array(F.lit("a"), F.lit("b"))).alias("x"))


def test_json_shapes(spark):
    df = col(spark, ['{"a":1}', "[1,[2]]", "5", '"{["', "{}", "{a", None, '{"a":{"b":[]}}', "[]"], "string")
    x = c("x")
    assert values(df, J.is_json_value(x), J.is_json_object(x), J.is_json_array(x), J.is_json_scalar(x), J.json_depth(x)) == [
        (True, True, False, False, 2), (True, False, True, False, 3), (True, False, False, True, 1), (True, False, False, True, 1), (True, True, False, False, 1),
        (False, False, False, False, None), (None,) * 5, (True, True, False, False, 3), (True, False, True, False, 1)]


def test_json_value_and_query(spark):
    df = col(spark, ['{"a":7,"b":[1]}', '{"b":2}', "{bad", None], "string")
    e, r = F.lit("empty"), F.lit("error")
    assert values(df, J.json_value(c("x"), "$.a", "string", e, r), J.json_value(c("x"), "$.b", "string", e, r)) == [
        ("7", "error"), ("empty", "2"), ("error", "error"), (None, None)]
    assert values(df, J.json_query(c("x"), "$.b"), J.json_query(c("x"), "$.b", "conditional"), J.json_query(c("x"), "$.b", "unconditional")) == [
        ("[1]", "[1]", "[[1]]"), (None, "[2]", "[2]"), (None, None, None), (None, None, None)]
    with pytest.raises(Exception, match="JSON_VALUE"):
        values(df, J.json_value(c("x"), "$.b", "int", raise_on_error=True))
    assert "\n" in values(df, J.json_pretty(c("x")))[0][0]


def test_lenient_json(spark):
    st = T.StructType.fromDDL("id int, name string")
    df = col(spark, ["{id:1,'name':'x',z:3}", '{"id":2}', '{"id":null,"name":null}', "{bad", None], "string")
    assert [r[0] and tuple(r[0]) for r in values(df, J.from_lenient(c("x"), st))] == [(1, "x"), (2, ""), (None, ""), None, None]
    old = F.struct(F.lit(9).alias("id"), F.lit("old").alias("name"))
    assert [tuple(r[0]) for r in values(df, J.partial_update(old, c("x"), st))] == [(1, "x"), (2, "old"), (None, None), (9, "old"), (9, "old")]


def test_typed_functions(spark):
    assert values(col(spark, ["12", None], "string"), U.text_to_int(c("x"))) == [(12,), (None,)]
    assert values(col(spark, [12, None], "int"), U.int_to_text(c("x"))) == [("12",), (None,)]
    with pytest.raises(Exception):
        values(col(spark, ["x"], "string"), U.text_to_int(c("x")))


def test_map_from_function_text(spark):
    """Text made by a function, then split into a map by name."""
    U.register(spark)
    df = col(spark, ['{"eventType":"play","fromType":"CN","columnType":"1"}'], "string")
    df.createOrReplaceTempView("json_map")
    got = spark.sql("SELECT m['eventType'], m['fromType'], m['columnType'] FROM (SELECT str_to_map(event_fields(x)) AS m FROM json_map)").first()
    assert tuple(got) == ("play", "CN", "1")


@pytest.mark.parametrize("vals", [[1, 5], [1, None], [None], [], [3, 3]])
def test_some_and_all_follow_three_valued_logic(spark, vals):
    sub = spark.createDataFrame([(v,) for v in vals], "v int")
    outer = spark.createDataFrame([(v,) for v in (0, 1, 3, 5, 9, None)], "x int")
    ops = {"<": lambda x, v: x < v, "<=": lambda x, v: x <= v, ">": lambda x, v: x > v, ">=": lambda x, v: x >= v}

    def truth(x, f, over_any):
        got = [None if x is None or v is None else f(x, v) for v in vals]
        if over_any:
            return True if True in got else None if None in got else False
        return False if False in got else None if None in got else True

    tests = [(Q.some(c("x"), op, sub, "v"), f, True) for op, f in {**ops, "<>": lambda x, v: x != v}.items()]
    tests += [(Q.every(c("x"), op, sub, "v"), f, False) for op, f in {**ops, "=": lambda x, v: x == v}.items()]
    rows = outer.select("x", *[t.alias(f"t{i}") for i, (t, _, _) in enumerate(tests)]).collect()
    for r in rows:
        assert list(r)[1:] == [truth(r.x, f, a) for _, f, a in tests]
    kept = {r.x for r in Q.not_in_query(outer, "x", sub, "v").collect()}
    assert kept == {x for x in (0, 1, 3, 5, 9, None) if truth(x, lambda p, q: p != q, False)}


def test_single_value_and_throw(spark):
    df = col(spark, [1, 2], "int")
    with pytest.raises(Exception, match="SINGLE_VALUE"):
        df.agg(A.single_value(c("x"))).collect()
    with pytest.raises(Exception, match="boom"):
        df.select(F.raise_error(F.lit("boom"))).collect()


def test_json_aggregates_null_handling(spark):
    df = spark.createDataFrame([("a", 1), ("b", None)], "k string, v int")
    got = df.agg(A.json_objectagg(c("k"), c("v")).alias("o"), A.json_objectagg(c("k"), c("v"), True).alias("oa"),
                 A.json_arrayagg(c("v")).alias("aa"), A.json_arrayagg(c("v"), False).alias("an")).first()
    assert tuple(got) == ('{"a":1,"b":null}', '{"a":1}', "[1]", "[null,1]")
