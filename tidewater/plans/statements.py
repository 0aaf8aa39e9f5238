"""Statements over named tables, named windows, session functions, literals, and sources of rows."""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from datetime import timedelta

from pyspark.sql import functions as F

from tidewater.functions import udfs as U
from tidewater.operators.pattern import begin, match
from tidewater.plans.registry import query
from tidewater.plans.streams import _drop
from tidewater.session import load, load_events, work_dir
from tidewater.sources import readers, sinks
from tidewater.streaming import state as ST
from tidewater.streaming import windows as W
from tidewater.streaming.runner import write_all

c = F.col


@contextmanager
def named_table(spark, columns: str):
    """A table of its own name in the shared folder, dropped from the catalog at the end."""
    name = f"t_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{work_dir(spark, 'table')}'")
    try:
        yield name
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


@query("src_collection", """
    SELECT event_type, weight, label, count(*) AS n, round(sum(value * weight), 4) AS total FROM events
    JOIN (VALUES ('click', 1), ('view', 2), ('purchase', 5)) w(event_type, weight) USING (event_type)
    LEFT JOIN (VALUES ('click', 'c'), ('purchase', NULL)) l(event_type, label) USING (event_type) GROUP BY ALL""")
def src_collection(spark, d):
    """A source of literals, and a VALUES table, joined with the events."""
    weights = readers.collection(spark, [("click", 1), ("view", 2), ("purchase", 5)], "event_type string, weight int")
    labels = spark.sql("SELECT * FROM VALUES ('click', 'c'), ('purchase', NULL) AS l(event_type, label)")
    rows = load(spark, d, "events").join(F.broadcast(weights), "event_type").join(F.broadcast(labels), "event_type", "left")
    return rows.groupBy("event_type", "weight", "label").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(c("value") * c("weight")), 4).alias("total"))


@query("insert_columns", """
    SELECT o_orderkey, o_totalprice, NULL AS note, 'first' AS part FROM orders WHERE o_orderkey % 2 = 0
    UNION ALL SELECT o_orderkey, NULL, o_orderpriority, 'second' FROM orders WHERE o_orderkey % 3 = 0""")
def insert_columns(spark, d):
    """INSERT INTO t(columns), twice with other columns, read back with TABLE t."""
    orders = load(spark, d, "orders")
    with named_table(spark, "o_orderkey bigint, o_totalprice double, note string, part string") as t:
        sinks.insert_columns(orders.where("o_orderkey % 2 = 0").select("o_orderkey", c("o_totalprice").cast("double"), F.lit("first")), t, ["o_orderkey", "o_totalprice", "part"])
        sinks.insert_columns(orders.where("o_orderkey % 3 = 0").select("o_orderkey", "o_orderpriority", F.lit("second")), t, ["o_orderkey", "note", "part"])
        out = work_dir(spark, "read-back")
        spark.sql(f"TABLE {t}").write.parquet(out)
    return spark.read.parquet(out)


@query("src_stream_table", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def src_stream_table(spark, d):
    """A table of the catalog as a stream."""
    with named_table(spark, "o_orderkey bigint, o_orderpriority string") as t:
        sinks.insert_columns(load(spark, d, "orders").select("o_orderkey", "o_orderpriority"), t, ["o_orderkey", "o_orderpriority"])
        out, _ = write_all(spark.readStream.table(t))
    return spark.read.parquet(out).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("win_named", """
    SELECT o_orderkey, row_number() OVER w AS rn, sum(o_totalprice) OVER w AS running, max(o_totalprice) OVER v AS top
    FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), v AS (PARTITION BY o_custkey)""")
def win_named(spark, d):
    """Windows named once and used by several columns."""
    return spark.sql("""
        SELECT o_orderkey, row_number() OVER w AS rn, sum(o_totalprice) OVER w AS running, max(o_totalprice) OVER v AS top
        FROM {orders} WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), v AS (PARTITION BY o_custkey)""", orders=load(spark, d, "orders"))


@query("fn_throw", "SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > 0 THEN l_extendedprice / l_quantity ELSE error('no quantity') END AS unit_price FROM lineitem")
def fn_throw(spark, d):
    """An error raised by a row that breaks a rule; none here does."""
    price = F.when(c("l_quantity") > 0, c("l_extendedprice") / c("l_quantity")).otherwise(F.raise_error(F.lit("no quantity")).cast("double"))
    return load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", price.cast("double").alias("unit_price"))


@query("fn_literals", "SELECT o_orderkey, 'ab' AS chained, chr(233) || o_orderpriority AS accented, length(chr(26085) || chr(128512)) AS chars FROM orders")
def fn_literals(spark, d):
    """Adjacent literals are one; escapes name characters of any plane."""
    return load(spark, d, "orders").selectExpr(
        "o_orderkey", "'a' 'b' AS chained", r"concat('é', o_orderpriority) AS accented", r"length('日' '\U0001f600') AS chars")


@query("udf_session", "SELECT event_id, 'k:' || json_extract_string(props, '$.k') AS fields, upper(event_type) AS shout FROM events")
def udf_session(spark, d):
    """A registered function in SQL text beside those of the catalog."""
    U.register(spark)
    return spark.sql("SELECT event_id, event_fields(props) AS fields, upper(event_type) AS shout FROM {e}", e=load(spark, d, "events"))


@query("state_rewrite", "SELECT user_id, count(*) AS n FROM events WHERE user_id % 2 = 0 GROUP BY user_id HAVING count(*) > 5")
def state_rewrite(spark, d):
    """A new checkpoint from selected keys of another."""
    build = lambda s: s.groupBy("user_id").agg(F.sum("n").alias("n"))
    home = ST.bootstrap(load(spark, d, "events").select("user_id", F.lit(1).cast("bigint").alias("n")), build, sink=_drop)
    state = ST.keyed_state(spark, f"{home}/checkpoint").select("user_id", c("sum").alias("n"))
    kept = ST.rewrite(state, (c("user_id") % 2 == 0) & (c("n") > 5), [c("user_id"), c("n")], build)
    return ST.keyed_state(spark, f"{kept}/checkpoint").select("user_id", c("sum").alias("n"))


@query("cep_allow_combinations", """
    SELECT a.user_id, a.event_id AS a_id, b.event_id AS b_id FROM events a JOIN events b ON a.user_id = b.user_id AND (a.ts, a.event_id) < (b.ts, b.event_id)
    WHERE a.event_type = 'click' AND b.event_type = 'click' AND b.ts - a.ts < INTERVAL 12 HOUR""")
def cep_allow_combinations(spark, d):
    """Any two clicks within half a day, others between them or not."""
    p = begin("a").where("event_type = 'click'").times(2).allow_combinations().within(timedelta(hours=12))
    m = match(load(spark, d, "events").select("event_id", "user_id", "event_type", "ts"), p, ["user_id"], "ts", ["event_id"], ["event_id"])
    return m.select("user_id", c("a")[0]["event_id"].alias("a_id"), c("a")[1]["event_id"].alias("b_id"))


@query("win_evict_time", """
    SELECT event_type, w AS window_start, count(*) AS n, round(sum(value), 4) AS total FROM
      (SELECT *, max(ts) OVER (PARTITION BY event_type, w) AS newest FROM (SELECT event_type, value, ts, time_bucket(INTERVAL 6 HOUR, ts) AS w FROM events))
    WHERE ts >= newest - INTERVAL 2 HOUR GROUP BY 1, 2""")
def win_evict_time(spark, d):
    """Of each window the rows of its last two hours."""
    kept = W.evict_time(load_events(spark, d).select("event_type", "value", "ts"), W.tumble("ts", "6 hours"), ["event_type"], "ts", timedelta(hours=2))
    out = kept.groupBy("event_type", "w").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return out.select("event_type", c("w.start").cast("timestamp_ntz").alias("window_start"), "n", "total")
