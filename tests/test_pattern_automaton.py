"""Row patterns without a time bound, against Python's regular expressions."""

import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewater.operators.pattern import Skip
from tidewater.operators.pattern import recognize as M

START = datetime(2024, 1, 1)
A, B, C, D, E = (M.var(x) for x in "ABCDE")
PATTERNS = {
    "A+B": M.seq(A.plus(), B), "AB*C": M.seq(A, B.star(), C), "A*?B+?C?": M.seq(A.star(False), B.plus(False), C.opt()),
    "(AB|A)+C*": M.seq(M.alt(M.seq(A, B), A).plus(), C.star()), "(A?B?)*C": M.seq(M.seq(A.opt(), B.opt()).star(), C),
    "A(B{2,}|C)+A": M.seq(A, M.alt(B.times(2, None), C).plus(), A), "(A|B|C)+": M.alt(A, B, C).plus(), "^A+B|C+$": M.alt(M.seq(M.AT_START, A.plus(), B), M.seq(C.plus(), M.AT_END)),
    "A{3,70}B": M.seq(A.times(3, 70), B),
}


def expected(text, source, past_last):
    found, p = [], 0
    while p < len(text):
        m = re.compile(source).match(text, p) if "^" not in source or p == 0 else re.compile(source.split("|")[1]).match(text, p)
        if m and m.end() > p:
            found.append(m.span())
            p = m.end() if past_last else p + 1
        else:
            p += 1
    return found


@pytest.fixture(scope="module")
def texts():
    r = random.Random(4)
    out = {k: "".join(r.choices("ABC", k=r.randrange(25))) for k in range(12)}
    return out | {20: "A" * 60 + "B", 21: "A" * 61, 22: "C" + "AB" * 25 + "C", 23: "C" * 50, 24: "A" * 80 + "BC"}


@pytest.mark.parametrize("skip", ["past_last", "next"])
def test_loops_without_a_bound(spark, texts, skip):
    """Chunks of one, seven and all rows give what a regular expression gives."""
    data = [(None if k == 3 else k, i, START + timedelta(minutes=i), ch) for k, t in texts.items() for i, ch in enumerate(t)]
    d = spark.createDataFrame(data, "k int, i int, ts timestamp, ch string").repartition(4).cache()
    names = list(PATTERNS) if skip == "past_last" else ["A+B", "^A+B|C+$"]
    for source in names:
        for minutes in ((7,) if source != "A+B" else (1, 7, 1000)):
            m = M.match_recognize(d, ["k"], "ts", PATTERNS[source], {x: f"ch = '{x}'" for x in "ABC"},
                                  {"lo": "array_min(transform(ALL, x -> x.i))", "hi": "array_max(transform(ALL, x -> x.i))", "n": "size(ALL)"},
                                  tie=["i"], after_match=Skip(skip), width=timedelta(minutes=minutes), subset={"ALL": M._variables(PATTERNS[source])})
            got = sorted((r.k if r.k is not None else 3, r.lo, r.hi + 1) for r in m.collect() if r.n == r.hi - r.lo + 1)
            assert got == sorted((k, *span) for k, t in texts.items() for span in expected(t, source, skip == "past_last")), (source, minutes)


def test_permutation_of_five(spark):
    r = random.Random(8)
    text = "".join("".join(r.sample("ABCDE", r.choice([4, 5, 5]))) for _ in range(30))
    d = spark.createDataFrame([(1, i, START + timedelta(minutes=i), ch) for i, ch in enumerate(text)], "k int, i int, ts timestamp, ch string")
    m = M.match_recognize(d, ["k"], "ts", M.permute(A, B, C, D, E), {x: f"ch = '{x}'" for x in "ABCDE"}, {"lo": "least(A[0].i, B[0].i, C[0].i, D[0].i, E[0].i)"}, tie=["i"], width=timedelta(minutes=11))
    want, p = [], 0
    while p + 5 <= len(text):
        if len(set(text[p:p + 5])) == 5:
            want.append(p)
            p += 5
        else:
            p += 1
    assert sorted(x.lo for x in m.collect()) == want and len(want) > 5
    assert m.where(F.lit(False)).count() == 0


def test_one_loop_over_many_chunks_is_linear(spark):
    """A run of 20,000 rows in 20 chunks: one match, found without walking from every row."""
    d = spark.range(20_001).select(F.lit(1).alias("k"), F.col("id").alias("i"), (F.lit(START) + F.make_interval(secs=F.col("id"))).alias("ts"), F.when(F.col("id") < 20_000, "A").otherwise("B").alias("ch"))
    m = M.match_recognize(d, ["k"], "ts", M.seq(A.plus(), B), {"A": "ch = 'A'", "B": "ch = 'B'"}, {"n": "size(A)", "end": "B[0].i"}, tie=["i"], width=timedelta(seconds=1000), payload=["i"])
    assert [(r.n, r.end) for r in m.collect()] == [(20_000, 20_000)]
