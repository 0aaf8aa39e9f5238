"""Answers that must not depend on the number of files, on NULLs or on repeated keys."""

from datetime import timedelta

import oracle
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as entry
from tidewater.functions import json as J
from tidewater.functions.json import from_lenient
from tidewater.functions.udfs import rule_predicate
from tidewater.operators import changelog as CL
from tidewater.operators import sequence as S
from tidewater.operators.pattern.recognize import match_recognize, var
from tidewater.operators.ranking import ranked
from tidewater.plans import all_queries
from tidewater.streaming import windows as W
from tidewater.streaming.runner import each_batch, stream_table

SF = "/root/testdata/sf0.001"
c = F.col


def many_files(spark, folder, files):
    """Events in shuffled files."""
    spark.read.parquet(f"{SF}/events.parquet").repartition(files, F.hash("event_id")).write.parquet(f"{folder}/events.parquet")
    return str(folder)


@pytest.mark.parametrize("files", [4, 600])
def test_streams_over_many_files(spark, tmp_path, files):
    d = many_files(spark, tmp_path, files)
    con, sql = oracle.connect(SF), all_queries()[1]
    names = ["stream_tumble", "stream_session", "stream_interval_join", "stream_cep_event_time", "stream_dedupe", "stream_counters", "state_windows"]
    for name in names:
        assert oracle.compare(entry.queries()[name](spark, d), con, sql[name]) is None, name


def test_counts_of_all_batches_add_up(spark, tmp_path):
    d = many_files(spark, tmp_path, 6)
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    sink = W.QualitySplit(spark, "props", lambda t: from_lenient(t, schema))
    each_batch(stream_table(spark, f"{d}/events.parquet", max_files=2).select("props"), sink)
    r = sink.counts().first()
    assert r.normalDataNum + r.dirtyDataNum == sink.rows().count() == 1000


@pytest.mark.parametrize("desc", [False, True])
def test_null_order_values_are_ranked_last(spark, desc):
    rows = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 3.0), ("a", None), ("b", None)], "k string, v double")
    got = ranked(rows, S.sequence(rows, ["k"], "v", width=1.0, desc=desc), 2)
    o = "v DESC NULLS LAST" if desc else "v ASC NULLS LAST"
    want = rows.selectExpr("k", "v", f"rank() OVER (PARTITION BY k ORDER BY {o}) r", f"dense_rank() OVER (PARTITION BY k ORDER BY {o}) d",
                           f"cume_dist() OVER (PARTITION BY k ORDER BY {o}) u")
    key = lambda r: repr(tuple(r))
    assert sorted(map(key, got.select("k", "v", c("rank"), "dense_rank", "cume_dist").collect())) == sorted(map(key, want.collect()))
    assert sorted(r.row_number for r in got.where("k = 'a'").collect()) == [1, 2, 3, 4]


def test_merge_refuses_two_rows_for_one(spark):
    t = spark.createDataFrame([(1, 10), (2, 20)], "k int, v int")
    s = lambda rows: spark.createDataFrame(rows, "k int, v int")
    run = lambda src: CL.merge(t, src, ["k"], {"v": c("s.v")}, {})
    assert sorted(tuple(r) for r in run(s([(1, 11), (3, 30), (3, 31)])).collect()) == [(1, 11), (2, 20), (3, 30), (3, 31)]
    with pytest.raises(PySparkException, match="several source rows"):
        run(s([(1, 11), (1, 12)])).collect()


def test_repeated_names_are_json(spark):
    r = spark.createDataFrame([('{"a":1,"a":2}',)], "s string").select(J.is_json_value(c("s")).alias("v"), J.is_json_object(c("s")).alias("o")).first()
    assert (r.v, r.o) == (True, True)


def test_rule_text(spark):
    assert spark.range(20).select(c("id").alias("data")).where(rule_predicate("getValue(data) > 10 AND getValue( data ) < 13")).count() == 2


def test_loops_need_no_bound(spark):
    """One match per user that holds all rows, over many chunks."""
    ev = spark.read.parquet(f"{SF}/events.parquet")
    m = match_recognize(ev, ["user_id"], "ts", var("A").plus(), {}, {"n": "CAST(size(A) AS BIGINT)"}, width=timedelta(days=8), payload=["event_id"])
    assert {(r.user_id, r.n) for r in m.collect()} == {(r.user_id, r["count"]) for r in ev.groupBy("user_id").count().collect()}
