"""Sources, sinks, user aggregates and window functions over whole tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators import custom
from tidewater.plans.registry import query
from tidewater.plans.streams import _SLICES, _slices, path
from tidewater.session import load, load_events, work_dir
from tidewater.sources import readers, sinks
from tidewater.streaming import state as ST
from tidewater.streaming import windows as W
from tidewater.streaming.runner import each_batch, latest_table, run_slices, stream_table

c = F.col


@query("src_batches", """
    SELECT CAST((rn - 1) // 25 AS BIGINT) AS batch, count(*) AS n, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key
    FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders) GROUP BY 1""")
def src_batches(spark, d):
    b = readers.batches(load(spark, d, "orders").select("o_orderkey"), ["o_orderkey"], 25)
    return b.groupBy("batch").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"))


@query("src_delimited", """
    SELECT event_id, user_id, date_trunc('second', ts) AS ts, value, CASE WHEN event_type = 'click' THEN NULL ELSE 1 END AS control FROM events""")
def src_delimited(spark, d):
    """Events written as text lines to two folders, read back as one source."""
    ev = load_events(spark, d)
    line = F.concat_ws(",", "event_id", "user_id", F.unix_seconds("ts"), "value", F.when(c("event_type") != "click", 1))
    a, b = work_dir(spark, "lines"), work_dir(spark, "lines")
    sinks.write_text(ev.where("event_type <> 'click'").select(line.alias("l")), "l", a, gzip=True)
    sinks.write_text(ev.where("event_type = 'click'").select(line.alias("l")), "l", b)
    schema = T.StructType.fromDDL("event_id bigint, user_id bigint, ts timestamp, value double, control int")
    out = readers.delimited(readers.text_lines(spark, [a, b]), schema, seconds=["ts"])
    return out.withColumn("ts", c("ts").cast("timestamp_ntz"))


@query("sink_buckets", """
    SELECT CAST(strftime(ts, '%Y') AS INTEGER) AS year, CAST(strftime(ts, '%m') AS INTEGER) AS month, CAST(strftime(ts, '%d') AS INTEGER) AS day,
           CAST(strftime(ts, '%H') AS INTEGER) AS hour, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL""")
def sink_buckets(spark, d):
    out = work_dir(spark, "buckets")
    ev = stream_table(spark, path(d)).select("ts", "value")
    sinks.stream_to_buckets(ev, out, "ts")
    return spark.read.parquet(out).groupBy(*sinks.BUCKETS).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("win_evictor", """
    SELECT event_type, w AS window_start, count(*) AS n, round(sum(value), 4) AS total FROM
      (SELECT event_type, value, time_bucket(INTERVAL 6 HOUR, ts) AS w, row_number() OVER (PARTITION BY event_type, time_bucket(INTERVAL 6 HOUR, ts) ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    WHERE rn <= 3 GROUP BY 1, 2""")
def win_evictor(spark, d):
    ev = load_events(spark, d).select("event_id", "event_type", "ts", "value")
    kept = W.evict_count(ev, W.tumble("ts", "6 hours"), ["event_type"], "ts", ["event_id"], 3)
    return kept.groupBy("event_type", "w").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total")) \
        .select("event_type", c("w.start").cast("timestamp_ntz").alias("window_start"), "n", "total")


@query("win_process", """
    SELECT user_id, time_bucket(INTERVAL 1 DAY, ts) AS window_start, count(*) AS n, max(value) - min(value) AS spread FROM events GROUP BY 1, 2""")
def win_process(spark, d):
    ev = load_events(spark, d).select("user_id", "ts", "value")

    def spread(key, batches):
        n, lo, hi = 0, None, None
        for pdf in batches:
            n += len(pdf)
            v = pdf["value"].to_numpy()
            a, b = float(v.min()), float(v.max())
            lo, hi = (a, b) if lo is None else (min(lo, a), max(hi, b))
        yield key[2], key[0], n, hi - lo

    out = custom.process_window(ev, W.tumble("ts", "1 day"), ["user_id"], spread, "user_id bigint, window_start timestamp, n bigint, spread double")
    return out.withColumn("window_start", c("window_start").cast("timestamp_ntz"))


@query("udaf_salted", "SELECT event_type, count(*) AS n, round(sum(value * value), 4) AS squares FROM events GROUP BY event_type")
def udaf_salted(spark, d):
    @F.pandas_udf(T.DoubleType())
    def squares(v: pd.Series) -> float:
        return float((v * v).sum())

    ev = load(spark, d, "events").select("event_id", "event_type", "value")
    return custom.salted_agg(
        ev, ["event_type"], [squares("value").alias("s")], [F.round(F.sum("s"), 4).alias("squares")]).join(
        ev.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")), "event_type").select("event_type", "n", "squares")


@query("stream_word_count", """
    SELECT word, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(lower(text), '[^a-z0-9_]+')) AS word FROM documents) WHERE word <> '' GROUP BY word""")
def stream_word_count(spark, d):
    """Processing-time windows of 5 seconds, added up over the windows."""
    docs = stream_table(spark, f"{d}/documents.parquet").select("text")
    words = W.processing_time(docs).select("pt", F.explode(F.split(F.lower("text"), "[^a-z0-9_]+")).alias("word")).where("word <> ''")
    per = W.window_agg(words, W.tumble("pt", "5 seconds"), ["word"], [F.count(F.lit(1)).alias("n")])
    return latest_table(per, ["word", "window_start", "window_end"]).groupBy("word").agg(F.sum("n").alias("n"))


@query("state_versions", f"WITH {_SLICES} SELECT user_id, count(*) AS n FROM a WHERE slice <= 1 GROUP BY user_id")
def state_versions(spark, d):
    """State as of the second of three batches."""
    counts = lambda s: s.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    drop = lambda batch, i: batch.write.format("noop").mode("append").save()
    ck = run_slices(spark, _slices(spark, d), lambda s, k: each_batch(counts(s), drop, "update", k))
    return ST.read_state(spark, ck, batch_id=1).select("key.user_id", c("value.count").alias("n"))
